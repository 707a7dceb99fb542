"""Operator 4: the latent search decides candidates, short items, blocks and very long items and texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from footfall.llm import decontaminate

DOCS = "doc_id long, text string, _doc string, _text string, _hash long, _counts int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 1, 2) for i, t in rows], DOCS)


def sentence(seed, n, words=400):
    own = random.Random(seed)
    return " ".join(f"w{own.randrange(words)}" for _ in range(n))


def search_of(texts, rows, latent=True):
    items = decontaminate.prepare(rows)
    frequencies = np.array([sum(t in x.encode().split() for x in texts) for t in items.terms])
    weights = decontaminate.idf(frequencies, len(texts))
    own = decontaminate._matrix(items.chunks, weights)
    if not latent:
        return decontaminate.Search(items, weights, np.eye(len(weights), 2, dtype=np.float32))
    dense = np.zeros((len(items.chunks), len(weights)))
    dense[own[0], own[1]] = own[2]
    basis = np.linalg.svd(dense, full_matrices=False)[2][: decontaminate.rank_for(len(items.chunks))].T
    return decontaminate.Search(items, weights, basis.astype(np.float32))


def test_cosine_search_alone_finds_paraphrases_and_depends_on_the_basis():
    own = random.Random(2)
    rows = [(i, sentence(i, own.randint(10, 60))) for i in range(60)]
    texts, planted = [], set()
    for i in range(40):
        words = rows[i][1].split()
        changed = [w if own.random() > 0.25 else f"w{own.randrange(400)}" for w in words]
        texts.append(sentence(900 + i, 50) + " " + " ".join(changed) + " " + sentence(700 + i, 50))
        planted.add((i, i))
    search = search_of(texts, rows)
    both = {(f[0], f[1]) for f in search.run(texts)}
    counted = {(f[0], f[1]) for f in search.run(texts, ("counted",))}
    near = {(f[0], f[1]) for f in search.run(texts, ("near",))}
    assert both == counted and len(planted & both) >= 38
    assert len(near) >= 0.9 * len(both)
    other = search_of(texts, rows, latent=False)
    assert {(f[0], f[1]) for f in other.run(texts, ("near",))} != near
    assert {(f[0], f[1]) for f in other.run(texts)} == both


def test_short_items_leave_the_corpus_whole(spark):
    rows = [(i, "the answer is not yes, of course " + sentence(i, 40)) for i in range(20)]
    items = [(1, "the"), (2, "Yes, of course."), (3, "not"), (4, None), (5, ""), (6, sentence(3, 8))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = table(spark, rows)
    assert decontaminate.clean(docs, benchmark).count() >= 19
    assert decontaminate.clean(docs, benchmark.filter("item_id < 6")).count() == 20
    skipped = {r.item_id: r.words for r in decontaminate.skipped_items(benchmark).collect()}
    assert skipped == {1: 1, 2: 3, 3: 1, 4: 0, 5: 0}


def test_blocks_and_long_items_and_texts(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 40_000)
    long_item = sentence(5000, 6000, 3000)
    items = [(i, sentence(i, 30, 3000)) for i in range(30)] + [(99, long_item)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    middle = " ".join(long_item.split()[3000:3060])
    far = sentence(1, decontaminate._AT_ONCE + 500, 3000) + " " + items[7][1]
    rows = [(1, sentence(11, 50) + " " + items[3][1]), (2, sentence(12, 50) + " " + middle), (3, far), (4, None), (5, "")]
    rows += [(6, sentence(13, 80)), (None, items[3][1]), (1, sentence(11, 50) + " " + items[3][1])]
    assert decontaminate._pieces(benchmark).count() > 31
    found = decontaminate.contaminated(table(spark, rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} >= {(1, 3), (2, 99), (3, 7), (None, 3)}
    assert {r.doc_id for r in found} == {1, 2, 3, None}
    pairs = [(r.doc_id, r.text_hash, r.item_id) for r in found]
    assert len(pairs) - len(set(pairs)) <= 1  # repeated rows match alike
    left = decontaminate.clean(table(spark, rows), benchmark)
    assert sorted(r.doc_id for r in left.collect()) == [4, 5, 6] and left.columns == [c.split()[0] for c in DOCS.split(", ")]


@pytest.mark.parametrize("rows", [[], [(1, None), (None, "")]])
def test_empty_tables(spark, rows):
    benchmark = spark.createDataFrame([(1, sentence(1, 20))], "item_id long, text string")
    docs = table(spark, rows)
    assert decontaminate.contaminated(docs, benchmark).count() == 0
    assert decontaminate.clean(docs, benchmark).count() == len(rows)
    assert decontaminate.clean(docs, benchmark.limit(0)).count() == len(rows)


def test_singular_vectors_are_fitted_to_the_passages_of_all_documents(spark, monkeypatch):
    fitted = []
    search = decontaminate.Search
    monkeypatch.setattr(decontaminate, "Search", lambda *made: fitted.append(made) or search(*made))
    own = random.Random(4)
    rows = [(i, " ".join(f"w{own.randrange(30) * own.randrange(2)}" for _ in range(own.randint(1, 150)))) for i in range(1300)]
    rows += [(i, f"w{i % 3 + 5} w{i % 3 + 6} other words") for i in range(1300, 1400)] + [(1400, "other words")]
    benchmark = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(30)))], "item_id long, text string")
    decontaminate.contaminated(table(spark, rows), benchmark).count()
    (items, weights, basis), = fitted
    passages = []
    for _, text in rows:
        numbers = decontaminate._numbers(text, items.terms)
        parts = [numbers[at : at + 64] for at in range(0, len(numbers), 64)]
        passages += [part[part >= 0] for part in parts if (part >= 0).any()]

    def gram(of):
        rows, columns, values = decontaminate._matrix(of, weights)
        dense = np.zeros((len(of), len(weights)))
        dense[rows, columns] = values
        return dense.T @ dense

    every = gram(items.chunks) + len(items.chunks) / len(passages) * gram(passages)
    turned = basis.T.astype(float) @ every @ basis
    strength = np.sort(np.linalg.eigvalsh(every))[::-1]
    assert np.diag(turned) == pytest.approx(strength, abs=1e-6)
    assert turned - np.diag(np.diag(turned)) == pytest.approx(0, abs=1e-6)
