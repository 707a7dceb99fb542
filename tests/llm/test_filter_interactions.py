"""Operator 11 against a plain walk through all orders."""

from __future__ import annotations

import itertools

import pytest

from footfall.llm.interactions import COUNTS, FILTERS, filter_interactions

DOCS = "doc_id long, text string, source string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int, source string"


def fails(text):
    words = text.split()
    found = set()
    if len(words) < 50:
        found.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        found.add("B")
    if 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text):
        found.add("C")
    if any(c in "#$%&*|" for c in text):
        found.add("D")
    return found


def plainly(rows, labels):
    texts = [text or "" for _, text, _ in rows]
    masks = []
    for (doc_id, _, _), text in zip(rows, texts):
        smaller = any(d is not None and doc_id is not None and d < doc_id and t == text for (d, _, _), t in zip(rows, texts))
        masks.append(fails(text) | ({"E"} if smaller else set()))
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    found = {}
    for part in {s or "" for _, _, s in rows}:
        own = [(d, m) for (d, _, s), m in zip(rows, masks) if (s or "") == part]
        share = dict.fromkeys(FILTERS, 0)
        for order in itertools.permutations(FILTERS):
            left, gone = list(own), []
            for step, letter in enumerate(order, 1):
                hit = [x for x in left if letter in x[1]]
                left = [x for x in left if letter not in x[1]]
                share[letter] += len(hit)
                found[part, "".join(order), step] = [
                    len(left),
                    len(hit),
                    sum(letter in m for _, m in gone),
                    sum(m == {letter} for _, m in own),
                    sum(d in good for d, _ in hit),
                    sum(d in toxic for d, _ in hit),
                ]
                gone += hit
        for (p, order, step), counts in found.items():
            if p == part:
                counts.append(share[order[step - 1]])
    return found


LONG = " ".join(f"word{i}" for i in range(60))
ROWS = [
    (1, LONG, "a"),
    (2, LONG, "b"),
    (2, LONG, "a"),
    (3, LONG.upper() + " $", None),
    (4, None, "a"),
    (5, "", ""),
    (6, "x " * 80, "a"),
    (7, "É" * 30 + "AB", "b"),
    (None, LONG, "a"),
    (None, "", "b"),
    (8, "tab\tnew\nline # " + LONG, "b"),
    (9, LONG + " " + "X" * 20_000, "a"),
]
LABELLED = [(1, 1, 0), (2, 1, 1), (2, 0, None), (3, 0, 1), (4, 1, 1), (6, None, 1), (77, 1, 1), (None, 1, 1)]


def test_equals_the_plain_walk(spark):
    docs = spark.createDataFrame([(*r, 1, "n") for r in ROWS], DOCS)
    labels = spark.createDataFrame([(*r, "x") for r in LABELLED], LABELS)
    found = filter_interactions(docs, labels).collect()
    want = plainly(ROWS, [x for x in LABELLED if x[0] is not None])
    assert {(r.part, r.filter_order, r.step): [r[c] for c in COUNTS] for r in found} == want
    assert len(found) == 3 * 120 * 5


@pytest.mark.parametrize("with_docs", [True, False])
def test_empty_tables(spark, with_docs):
    docs = spark.createDataFrame([(1, "a b", "s", 1, "n")] if with_docs else [], DOCS)
    found = filter_interactions(docs, spark.createDataFrame([], LABELS)).collect()
    assert len(found) == (600 if with_docs else 0)
    assert all(r.good_lost == r.toxic_lost == 0 for r in found)
