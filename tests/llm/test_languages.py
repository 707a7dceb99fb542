"""Operator 3: long texts count like short ones, and decoding against its plain definition."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from footfall.llm import langid


def plain_counts(text):
    raw = [b if b >= 128 or chr(b).isalpha() else 32 for b in f" {text.lower()} ".encode()]
    found = Counter()
    for n in langid.LENGTHS:
        for i in range(len(raw) - n + 1):
            if raw[i + n - 1] == 32 and raw[i + n - 2] == 32:
                continue
            value = 0
            for b in raw[i : i + n]:
                value = (value * 257 + b) % 2**32
            mixed = (value ^ (value >> 15)) * 0x9E3779B1 % 2**32
            found[mixed >> (32 - langid.BUCKETS.bit_length() + 1)] += 1
    return found


@pytest.mark.parametrize("at_once", [1, 2, 5, 64, 1 << 18])
def test_stretches_do_not_change_counts(monkeypatch, at_once):
    monkeypatch.setattr(langid, "_AT_ONCE", at_once)
    own = random.Random(at_once)
    for _ in range(60):
        text = "".join(own.choice("ab é1. \nZ") for _ in range(own.randint(0, 90)))
        got = langid.counted(text)
        assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == plain_counts(text), text


def test_a_text_beyond_the_seam_counts_as_in_one_pass(monkeypatch):
    text = " ".join(random.Random(1).choice(("word", "Übung", "x", "1984,", "niño")) for _ in range(150_000))
    assert len(text) > 2 * langid._AT_ONCE
    got = langid.counted(text)
    monkeypatch.setattr(langid, "_AT_ONCE", 1 << 30)
    assert np.array_equal(got, langid.counted(text))


def test_decoding_equals_its_definition():
    own = np.random.default_rng(3)
    for classes in (2, 4, 7):
        code = langid.codewords(classes)
        model = langid.LanguageModel([str(i) for i in range(classes)], code, np.zeros((1, 1)), own.uniform(0.2, 1, code.shape[1]))
        sums, counts = own.normal(0, 30, (40, code.shape[1])), own.integers(0, 200, 40)
        best, scores, flags = model.decode(sums, counts)
        for i in range(40):
            losses = [
                sum(t * math.log1p(math.exp(-4 * (2 * bit - 1) * sums[i, k] / max(counts[i], 1))) for k, (bit, t) in enumerate(zip(row, model.trust)))
                for row in code
            ]
            scale = math.sqrt(min(counts[i], langid._WEIGHTY)) * len(model.trust)
            shares = [math.exp(-(x - min(losses)) * scale) for x in losses]
            shares = [x / sum(shares) for x in shares]
            order = sorted(shares)
            assert scores[i] == pytest.approx(order[-1])
            assert shares[best[i]] == pytest.approx(order[-1])
            assert flags[i] == (order[-1] - order[-2] < langid.AMBIGUOUS)
