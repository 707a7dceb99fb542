"""Sketches that add up, and JSON records with broken lines."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from footfall.operators import sketches
from footfall.sources import json_lines

KEYS = ["k"]


def test_a_new_week_adds_to_the_old_ones(spark):
    rows = spark.range(40_000).select(
        (F.col("id") % 2).alias("k"),
        F.floor(F.col("id") / 4000).cast("string").alias("week"),
        (F.col("id") * 7919 % 10_007).alias("gap"),
    )
    weekly = sketches.week_sketches(rows, KEYS, "week", "gap")
    assert weekly.count() == 20
    old = sketches.merged_sketches(weekly.filter("week < '9'"), KEYS)
    both = old.unionByName(weekly.filter("week = '9'").select("k", "sketch", "n_values"))
    found = sketches.merged_sketches(both, KEYS).withColumns(sketches.quantile_columns())
    for r in found.collect():
        values = sorted(x.gap for x in rows.filter(F.col("k") == r.k).collect())
        assert r.n_values == len(values) == 20_000
        for name, share in sketches.QUARTILES.items():
            place = sum(v <= r[name] for v in values) / len(values)
            assert abs(place - share) < 3 * sketches.rank_error()


def test_few_values_are_exact_and_nulls_left_out(spark):
    table = [(1, "a", v) for v in (3, 9, 1)] + [(1, "b", 4), (1, "b", None), (2, "a", None), (3, "a", 7)]
    rows = spark.createDataFrame(table, "k int, week string, gap int")
    merged = sketches.merged_sketches(sketches.week_sketches(rows, KEYS, "week", "gap"), KEYS)
    found = {r.k: (r.p25, r.p50, r.p75, r.n_values) for r in merged.withColumns(sketches.quantile_columns()).collect()}
    assert found == {1: (1, 3, 4, 4), 3: (7, 7, 7, 1)}


def test_broken_records_are_kept_apart(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text('{"a": 1, "b": "x", "more": [1]}\n{"a": "no number"}\n{"a": 2\n{"b": "y"}\n')
    read = json_lines.read_json(spark, str(path), "a int, b string").cache()
    assert [tuple(r) for r in json_lines.whole_records(read).collect()] == [(1, "x"), (None, "y")]
    assert sorted(r[0] for r in read.filter(F.col(json_lines.BROKEN).isNotNull()).select(json_lines.BROKEN).collect()) == [
        '{"a": "no number"}',
        '{"a": 2',
    ]


def test_segments_of_a_map(spark, tmp_path):
    lines = []
    for name in ("b", "a"):
        vectors, ids = str(tmp_path / f"v_{name}"), str(tmp_path / f"i_{name}")
        spark.range(2).select(F.lit(name).alias("from"), "id").write.parquet(vectors)
        spark.range(3).write.parquet(ids)
        lines.append(json.dumps({"segment": name, "embeddings": vectors, "id_mapping": ids}))
    path = tmp_path / "segments.json"
    path.write_text("\n".join(lines))
    found = json_lines.read_segments(spark, str(path))
    assert [(v.first()["from"], m.count()) for v, m in found] == [("a", 3), ("b", 3)]
    path.write_text(lines[0] + '\n{"segment": "c"}\n')
    with pytest.raises(ValueError, match="incomplete segments"):
        json_lines.read_segments(spark, str(path))
