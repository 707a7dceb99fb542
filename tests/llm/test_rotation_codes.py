"""Operator 12 against all pairs computed exactly."""

from __future__ import annotations

import numpy as np
import pytest

from footfall.llm import rotation

SCHEMA = "vec_id long, embedding array<float>, label int, unit string, code long"
ODD = [
    (9999, None, 1),
    (9998, [0.0] * 64, 1),
    (9997, [float("nan")] * 64, 1),
    (9996, [float("inf"), 1.0], 1),
    (9995, [1.0, None], 2),
    (9994, [1.0, 2.0], 2),
    (9993, [2.0, 4.1], 2),
    (9993, [2.0, 4.1], 2),
    (9992, [], 0),
    (9991, [1.0, 2.0], None),
    (None, [4.0, 8.0], 2),
    (None, [-1.0, 0.5], 2),
]


def plainly(rows, threshold=rotation.THRESHOLD):
    units, groups = {}, {}
    for i, (_, values, label) in enumerate(rows):
        x = np.array([np.nan if v is None else v for v in values or []], dtype=float)
        if label is not None and len(x) and np.isfinite(x).all() and x.any():
            units[i] = x / np.linalg.norm(x)
            groups.setdefault((label, len(x)), []).append(i)
    links = {i: set() for i in range(len(rows))}
    for members in groups.values():
        stacked = np.stack([units[i] for i in members])
        for a, near in zip(members, stacked @ stacked.T >= threshold):
            links[a] = {members[b] for b in np.flatnonzero(near)} - {a}
    root = {}
    for i in links:
        pending, reached = [i], {i}
        if i in root:
            continue
        while pending:
            for j in links[pending.pop()] - reached:
                reached.add(j)
                pending.append(j)
        ids = [rows[j][0] for j in reached if rows[j][0] is not None]
        root |= dict.fromkeys(reached, min(ids, default=None))
    return [(r[0], len(links[i]), root[i], r[0] is not None and r[0] == root[i]) for i, r in enumerate(rows)]


def made(seed, plain, clusters, copies):
    rng = np.random.default_rng(seed)
    rows = []
    for label in range(2):
        parts = [rng.standard_normal((plain, 64))]
        for size, noise in clusters:
            centre = rng.standard_normal(64)
            parts.append(centre / np.linalg.norm(centre) + noise * rng.standard_normal((size, 64)) / 8)
        x = np.vstack([*parts, parts[0][:copies], np.repeat(parts[-1][-1:], copies, 0)])
        rows += [(v.astype(np.float32).tolist(), label) for v in x]
    return [(i, *rows[j]) for i, j in enumerate(rng.permutation(len(rows)))] + ODD


def found(spark, rows, **settings):
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return [tuple(r) for r in rotation.near_vectors(table, **settings).collect()]


def test_plain_pairs_and_odd_rows(spark):
    rows = made(1, 200, [(20, 0.15), (15, 0.2)], 4)
    assert sorted(found(spark, rows), key=str) == sorted(plainly(rows), key=str)


def test_crowded_keys_lose_next_to_nothing(spark):
    rows = made(2, 100, [(250, 0.1), (150, 0.25), (120, 0.28)], 10)
    got, want = found(spark, rows, bucket=16), plainly(rows)
    links = {(r[0], r[2]): r[1] for r in got if r[0] is not None}
    wanted = {(r[0], r[2]): r[1] for r in want if r[0] is not None}
    assert set(links) == set(wanted)
    assert all(links[k] <= n for k, n in wanted.items())
    assert sum(links.values()) >= 0.999 * sum(wanted.values())


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in rng.standard_normal((2, 2000, 64)))
    b = 0.95 * a + 0.3 * b
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    codes, factors = rotation.encode(a, 256)
    guess, bound = rotation.estimate(codes, factors, b)
    true = (a * b).sum(axis=1)
    assert abs((guess - true).mean()) < 0.005
    assert (np.abs(guess - true) <= bound).mean() > 0.999
    assert bound.max() < 0.5


def test_bands_reach_the_threshold():
    for rows in (0, 10, 5_000, 10_000_000):
        width, bands = rotation.bands_for(rows)
        agree = (1 - np.arccos(rotation.THRESHOLD) / np.pi) ** width
        assert (1 - agree) ** bands <= rotation.MISS


@pytest.mark.parametrize("rows", [[], ODD[:5]])
def test_empty_and_linkless(spark, rows):
    assert sorted(found(spark, rows)) == sorted(plainly(rows))
