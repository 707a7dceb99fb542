"""Operators 6 and 10 where a third of all rows are equal, and the whole K-d tree against a plain one."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from footfall.llm import common, mixing, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, copy long, _first int"


def rows(n=3000, share=3):
    own, found = random.Random(4), []
    for i in range(n):
        if i % share == 0:
            found.append((None, "same words in every copy " * 8, "en", "s1", 200, 1, 1))
        else:
            text = " ".join("word" for _ in range(own.randint(1, 30)))
            found.append((i, text, own.choice(("en", "de")), own.choice(("s0", "s1", "s2", None)), len(text), 1, 1))
    return found


@pytest.fixture
def few_at_once(monkeypatch):
    monkeypatch.setattr(common, "COPIES_AT_ONCE", 64)


def test_shards_stay_near_equal(spark, few_at_once):
    table = rows()
    found = sharding.kd_shards(spark.createDataFrame(table, SCHEMA)).collect()
    sizes, slots = Counter(), {}
    for r in found:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert Counter(r.doc_id for r in found) == Counter(t[0] for t in table)
    assert set(sizes) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t[1] or "").encode()) + 1 for t in table)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_mix_meets_its_targets(spark, few_at_once):
    table = rows()
    docs = spark.createDataFrame(table, SCHEMA)
    found = mixing.mix(docs).collect()
    assert Counter((r.doc_id, r.source) for r in found) == Counter((t[0], t[3]) for t in table)
    taken, targets, largest = Counter(), {}, Counter()
    for r in found:
        taken[r.source] += r.taken
        targets[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 for s in targets)
    mixed = mixing.mixed(docs)
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len(r.text.split())
    assert words == taken and mixed.columns == docs.columns


def test_copies_that_differ_elsewhere_are_taken_one_by_one(spark, few_at_once):
    table = [(1, "a b c", lang, "s0", n, 1, 1) for lang in ("en", "de", None) for n in range(2) for _ in range(40)]
    docs = spark.createDataFrame(table + [(2, "x " * 600, "en", "s1", 3, 1, 1)], SCHEMA)
    found, again = (Counter(map(tuple, mixing.mixed(docs.repartition(p)).collect())) for p in (2, 7))
    per_row = mixing.mix(docs).collect()
    assert found == again and sum(found.values()) == sum(r.repeats for r in per_row)
    assert set(found) <= set(table) | {(2, "x " * 600, "en", "s1", 3, 1, 1)}
    counts = Counter(table)
    assert all(found[t] <= 3 * n for t, n in counts.items())


def test_numbered_copies(spark, few_at_once):
    counted = spark.createDataFrame([("a", 1), ("b", 64), ("c", 65), ("d", 1000)], "k string, n long")
    found = common.numbered_copies(counted).collect()
    by_key = {}
    for r in found:
        by_key.setdefault(r.k, []).append(r.copy)
    assert {k: sorted(v) for k, v in by_key.items()} == {k: list(range(n)) for k, n in (("a", 1), ("b", 64), ("c", 65), ("d", 1000))}


def plain_tree(points, shards):
    """(dims, size, hash) rows → shard of each, by the rule: widest dimension, weighted median, hash among equals."""
    def cut(members, first, count):
        if count == 1 or not members:
            return dict.fromkeys(members, first)
        spread = [max(points[m][0][d] for m in members) - min(points[m][0][d] for m in members) for d in range(len(points[0][0]))]
        d = spread.index(max(spread))
        half = count // 2
        order = sorted(members, key=lambda m: (points[m][0][d], points[m][2] % 2**64 >> 48, points[m][2] % 2**48))
        goal, before, left = sum(points[m][1] for m in members) * half / count, 0, []
        for m in order:
            if 2 * before + points[m][1] > 2 * goal:
                break
            before += points[m][1]
            left.append(m)
        return cut(left, first, half) | cut(order[len(left) :], first + half, count - half)

    return cut(list(range(len(points))), 0, shards)


@pytest.mark.parametrize("shards", [8, 5])
def test_tree_equals_a_plain_one(spark, shards):
    from pyspark.sql import functions as F

    own = random.Random(shards)
    table = [
        (i, "t" * own.randint(0, 80), "en", "s", own.randint(0, 999), own.randint(0, 50), own.randint(0, 5)) for i in range(700)
    ]
    docs = spark.createDataFrame(table, SCHEMA)
    metadata = ("n_chars", "copy", "_first")
    found = {r.doc_id: r.shard for r in sharding.kd_shards(docs, shards, metadata).collect()}
    ranges = [(min(t[c] for t in table), max(t[c] for t in table)) for c in (4, 5, 6)]
    hashes = {r.doc_id: r.h for r in docs.select("doc_id", F.xxhash64("doc_id", "text").alias("h")).collect()}
    points = [
        ([int((t[c] - lo) / (hi - lo) * 65_535) for c, (lo, hi) in zip((4, 5, 6), ranges)], len(t[1]) + 1, hashes[t[0]])
        for t in table
    ]
    want = plain_tree(points, shards)
    assert found == {t[0]: want[i] for i, t in enumerate(table)}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert sharding.kd_shards(empty).count() == mixing.mix(empty).count() == mixing.mixed(empty).count() == 0
