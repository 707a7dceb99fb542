"""Operator 13 against a scan of every period."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from footfall.llm import periodic

SCHEMA = "doc_id long, text string, n_runs string, start long"


def plain_runs(words):
    n, found = len(words), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                least = next(r for r in range(1, q + 1) if all(words[k] == words[k + r] for k in range(i, j + q - r)))
                if least == q:
                    found.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    return (
        doc_id,
        len(runs),
        *(best or (None, None, None)),
        1000 * best[1] // best[2] if best else None,
        hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def made(rng, n):
    words = [rng.randrange(rng.choice((1, 2, 3, 50))) for _ in range(n)]
    for _ in range(rng.randrange(4)):
        start, period = rng.randrange(n), rng.randrange(1, 25)
        for i in range(start + period, min(n, start + rng.randrange(10, 90))):
            words[i] = words[i - period]
        if rng.random() < 0.3:
            words[rng.randrange(n)] = 99
    return words


def test_runs_equal_a_scan_of_every_period():
    rng = random.Random(4)
    for _ in range(1500):
        words = made(rng, rng.choice((24, 30, 60, 120)))
        assert periodic.runs(np.array(words)) == plain_runs(words), words


def test_fibonacci_and_powers():
    a, b = [0], [0, 1]
    while len(b) < 400:
        a, b = b, b + a
    for words in (b[:400], [0] * 300, [0] * 23, [0] * 24, [i % 8 for i in range(24)], [i % 9 for i in range(26)]):
        assert periodic.runs(np.array(words)) == plain_runs(words)


def test_rows(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"w{w}" for w in made(rng, 80))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n\t"), (None, "a " * 40), (None, None), (1, rows[1][1])]
    rows += [(103, "x " * 5000 + " ".join(f"y{i % 700}" for i in range(9000))), (104, "é \x85 " * 30), (1 << 60, "a " * 30)]
    short = [r for r in rows if r[0] != 103]
    table = spark.createDataFrame([(*r, "n", 1) for r in rows], SCHEMA)
    found = [tuple(r) for r in periodic.periodic_runs(table).collect()]
    assert sorted((r for r in found if r[0] != 103), key=str) == sorted((plain_row(*r) for r in short), key=str)
    long = next(r for r in found if r[0] == 103)
    if zlib.crc32(b"103") % 10:
        assert long[1:6] == (2, 0, 5000, 1, 5_000_000)


def test_tables_and_empty(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("length(text) < 3000")
    found = [tuple(r) for r in periodic.periodic_runs(docs).collect()]
    assert sorted(found) == sorted(plain_row(r.doc_id, r.text) for r in docs.collect())
    assert periodic.periodic_runs(docs.limit(0)).count() == 0


@pytest.mark.parametrize("least", range(1, 40))
def test_least_half_fits_every_run(least):
    length = max(24, 3 * least)
    assert length // (2 * least) * least >= periodic.LEAST_HALF
