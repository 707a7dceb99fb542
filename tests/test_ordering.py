"""Ranks, running totals, medians, splits and samples against plain definitions."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import Window, functions as F

from footfall.operators import sampling
from footfall.operators.impute import median_fill
from footfall.operators.ordering import cut_points, exact_medians, hash_rank, running_totals, with_piece
from footfall.operators.shape import attach_one_row, as_one_row, flag_matrix, keep_one


def numbers(spark, rows=5000, partitions=4):
    """Values of which a third are the same."""
    value = F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 1009) / 10)
    return spark.range(0, rows, 1, partitions).select("id", value.alias("v"), (F.col("id") % 4).alias("g"))


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("pieces", [1, 3, 50])
def test_running_totals(spark, descending, pieces):
    rows = numbers(spark)
    collapsed = rows.groupBy("g", "v").agg(F.count("*").alias("n"))
    cuts = cut_points(rows, ["v"], pieces)["v"]
    found = running_totals(with_piece(collapsed, "v", cuts), "v", ["n"], ["g"], descending)
    order = F.col("v").desc() if descending else F.col("v")
    window = Window.partitionBy("g").orderBy(order)
    plain = collapsed.select(
        "g", "v", "n", F.sum("n").over(window).alias("n_through"), F.sum("n").over(Window.partitionBy("g")).alias("n_all")
    )
    assert found.count() == plain.count()
    assert found.exceptAll(plain).count() == 0


def test_hash_rank_is_a_dense_ranking_free_of_partitioning(spark):
    results = []
    for partitions in (1, 2, 4):
        ranked = hash_rank(numbers(spark, 500, partitions), "id", ["g"], 1)
        results.append(sorted((r.id, r["rank"], r.group_rows) for r in ranked.collect()))
    assert results[0] == results[1] == results[2]
    by_group: dict[int, list[int]] = {}
    for i, rank, _ in results[0]:
        by_group.setdefault(i % 4, []).append(rank)
    assert all(sorted(ranks) == list(range(1, len(ranks) + 1)) for ranks in by_group.values())


def test_rows_of_a_null_group_stay(spark):
    rows = numbers(spark, 400).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    ranked = hash_rank(rows, "id", ["g"])
    assert ranked.count() == 400
    assert ranked.filter("g IS NULL").agg(F.max("rank")).first()[0] == 100
    totals = running_totals(
        with_piece(rows.groupBy("g", "v").agg(F.count("*").alias("n")), "v", [3.0, 9.0]), "v", ["n"], ["g"]
    )
    assert totals.groupBy("g").agg(F.max("n_through").alias("n")).filter("n <> 100").count() == 0


def test_exact_medians(spark):
    rows = numbers(spark, 4001).withColumn("w", F.when(F.col("id") % 5 != 0, F.col("v") * 2))
    collected = rows.collect()
    found = exact_medians(rows, ["v", "w"]).first()
    assert found.v == statistics.median(r.v for r in collected)
    assert found.w == pytest.approx(statistics.median(r.w for r in collected if r.w is not None))


def test_median_fill_of_an_empty_column_stays_null(spark):
    rows = spark.createDataFrame([(1, None, 1.0), (2, None, None), (3, None, 4.0)], "id int, a double, b double")
    found = {r.id: (r.a, r.b) for r in median_fill(rows, ["a", "b"]).collect()}
    assert found == {1: (None, 1.0), 2: (None, 2.5), 3: (None, 4.0)}


def test_split_shares_are_exact_per_stratum(spark):
    split = sampling.stratified_split(numbers(spark, 1000), "id", "g")
    counts = {(r.g, r.split): r["count"] for r in split.groupBy("g", "split").count().collect()}
    for g in range(4):
        assert [counts[g, s] for s in ("train", "validation", "test")] == [150, 50, 50]


def test_sample_sizes_and_independence_of_the_split(spark):
    split = sampling.stratified_split(numbers(spark, 4000), "id", "g")
    sample = sampling.stratified_sample(split, "id", "g", 0.1)
    assert sample.groupBy("g").count().filter("count <> 100").count() == 0
    assert {r.split for r in sample.select("split").distinct().collect()} == {"train", "validation", "test"}
    assert sampling.sample_up_to(split, "id", 123).count() == 123
    assert sampling.sample_up_to(split, "id", 9999).count() == 4000


def test_groups_and_folds_do_not_depend_on_partitions(spark):
    seen = set()
    for partitions in (1, 2, 4):
        rows = sampling.fold_number(sampling.group_flag(numbers(spark, 1000, partitions), "id"), "id")
        seen.add(tuple(sorted((r.id, r.group_flag, r.fold) for r in rows.collect())))
    assert len(seen) == 1
    flags = [flag for _, flag, _ in seen.pop()]
    assert 60 < flags.count("T") < 140


def test_copies_even_out_the_classes(spark):
    rows = numbers(spark, 2000).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    copies = sampling.balanced_by_copies(rows, "label", "id", 3.5)
    negatives, positives = (copies.filter(F.col("label") == k).count() for k in (0, 1))
    assert negatives == 1600
    assert abs(positives - 400 * 3.5) < 60
    assert copies.select("id").distinct().count() == 2000


def test_keep_one_takes_the_smallest(spark):
    rows = spark.createDataFrame([(1, 5, "b"), (1, 3, "a"), (2, 9, None), (1, 3, "z")], "k int, o int, v string")
    for partitions in (1, 2, 4):
        found = keep_one(rows.repartition(partitions), ["k"], ["o", "v"])
        assert sorted((r.k, r.o, r.v) for r in found.collect()) == [(1, 3, "a"), (2, 9, None)]


def test_pivots_have_declared_columns(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 3), ("b", 9)], "k string, p int")
    matrix = flag_matrix(rows, "k", [("p", [1, 2, 3], "{}_back")])
    assert [r.asDict() for r in matrix.collect()] == [{"k": "a", "1_back": 1, "2_back": 0, "3_back": 1}]
    both = flag_matrix(rows, "k", [("p", [1, 2], "{}_back"), ("p", [9], "{}_far")]).orderBy("k").collect()
    assert [tuple(r) for r in both] == [("a", 1, 0, 0), ("b", 0, 0, 1)]
    one = as_one_row(rows.withColumn("f", F.lit(1)), "p", "f", [1, 2], "{}_f")
    assert attach_one_row(rows.select("k"), one).first().asDict() == {"k": "a", "1_f": 1, "2_f": 0}
