"""Operator 2: base kinds against the plain patterns, and what the field adds, on variants held out of training."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from footfall.llm import pii

PATTERNS = {
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in reversed(digits)):
        total += sum(divmod(2 * d, 10)) if i % 2 else d
    return total % 10 == 0


def holds(kind, text):
    digits = [c for c in text if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in text.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15


@pytest.mark.parametrize("kind", PATTERNS)
def test_base_kinds_equal_the_plain_patterns(kind):
    own = random.Random(kind)
    pieces = ("1", "25", "255", "256", ".", ".", ".", "+", "-", " ", "(", ")", "x", "\n", "4111", "1111 1111", "0" * 5, "٣")
    if kind == "ip":
        pieces = ("1", "25", "256", "0", ".", ".", ".", ".", ".", " ")
    hits = 0
    for _ in range(6000):
        text = "".join(own.choice(pieces) for _ in range(own.randint(0, 18)))
        want = [(kind, *m.span()) for m in re.finditer(PATTERNS[kind], text) if holds(kind, m.group())]
        assert pii.base_spans(text)[kind] == want, text
        hits += len(want)
    assert hits > 20


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def spans(field, texts):
    places = pii.Places(field)
    own = places.of([pii.classes(t) for t in texts])
    starts = np.cumsum([0, *map(len, own)])[:-1]
    tags = pii.decode(places.field, np.concatenate(own), starts)
    found = []
    for text, start, words in zip(texts, starts, own):
        base = [s for kind in pii.base_spans(text).values() for s in kind]
        found.append(pii.field_spans(text, tags[start : start + len(words)], base))
    return found


def test_held_out_variants(field):
    made, rows = pii.Made("held out"), []
    while len(rows) < 1500:
        kind, text = made.example()
        if kind == "none" or not any(pii.base_spans(text).values()):
            rows.append((kind, text, f"please {made.name()} {made.name()} {text} {made.name()}, and {made.name()}"))
    hit = wanted = alarms = 0
    for (kind, text, whole), found in zip(rows, spans(field, [r[2] for r in rows])):
        start = whole.index(text)
        right = [s for s in found if s[0] == f"crf_{kind}" and abs(s[1] - start) <= 1 and abs(s[2] - start - len(text)) <= 1]
        wanted += kind != "none"
        hit += bool(right)
        alarms += len(found) - len(right)
    assert hit / wanted >= 0.95 and hit / (hit + alarms) >= 0.95


def test_variants_nobody_generated(field):
    texts = {
        "call 555-123-4567 now": "phone",
        "my (555) 123-4567 ok": "phone",
        "dial 020 7946 0958 today": "phone",
        "card 4111.1111.1111.1111 end": "card",
        "4111_1111_1111_1111": "card",
        "bob@localhost writes": "email",
        "j.doe@münchen.de writes": "email",
        "on 2024-03-01 12:30:45 at 10:15": None,
        "pages 120-140 of volume 3.2.1": None,
        "see [12] and (1999)": None,
    }
    for (text, kind), found in zip(texts.items(), spans(field, list(texts))):
        assert [s[0] for s in found] == ([f"crf_{kind}"] if kind else []), text


def test_query_adds_spans_and_keeps_base_ones(spark, field):
    rows = [(1, "call 555-123-4567 or a@b.co", "x"), (2, None, "x"), (3, "", "x"), (None, "10[.]20[.]30[.]40", "x")]
    found = {r.doc_id: r for r in pii.find_personal(spark.createDataFrame(rows, "doc_id long, text string, spans string"), field).collect()}
    assert found[1].spans == "email:21:27,crf_phone:5:17" and found[1].n_email == 1 and found[1].n_phone == 0
    assert found[2].spans == found[3].spans == "" and found[None].spans == "crf_ip:0:17"


def test_a_shape_weighs_what_its_features_weigh(field):
    known = sorted(field.shapes)[:200]
    fresh = pii.Field({}, np.zeros((3, 2, len(pii.TAGS))), field.moves, field.parts, field.shared).knowing(known)
    assert np.allclose(fresh.weights[:, :200], field.weights[:, [field.shapes[s] for s in known]])
    assert field.knowing([]) is field
