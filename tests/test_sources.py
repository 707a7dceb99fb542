"""Readers and writers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.functions.names import affix
from footfall.operators.audit import null_audit, require_columns
from footfall.plans.embeddings import embedding_table
from footfall.plans.features import as_float
from footfall.sources import offers, tables


def test_replacing_one_week_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(3), path, "2001_327")
    tables.write_snapshot(spark.range(5), path, "2001_329")
    tables.write_snapshot(spark.range(2), path, "2001_327")
    assert tables.read_snapshot(spark, path, "2001_327").count() == 2
    assert tables.read_snapshot(spark, path, "2001_329").count() == 5
    both = spark.range(7).withColumn(tables.SNAPSHOT, F.lit("2001_329"))
    tables.write_snapshots(both, path)
    assert tables.read_table(spark, path).groupBy(tables.SNAPSHOT).count().count() == 2
    assert tables.read_snapshot(spark, path, "2001_329").count() == 7


def test_snapshot_read_opens_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(3), path, "2001_327")
    tables.write_snapshot(spark.range(5), path, "2001_329")
    assert len(tables.read_snapshot(spark, path, "2001_327").inputFiles()) >= 1
    plan = tables.read_snapshot(spark, path, "2001_327")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(snapshot_week" in plan


def test_an_empty_week_replaces_a_full_one(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(3), path, "2001_327")
    tables.write_snapshot(spark.range(3), path, "2001_329")
    tables.write_snapshot(spark.range(0), path, "2001_327")
    assert tables.read_snapshot(spark, path, "2001_327").count() == 0


def test_parts_have_a_bounded_size(spark, tmp_path):
    path = str(tmp_path / "p")
    tables.write_parts(spark.range(0, 1000, 1, 1), path, rows_per_file=300)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 300 and len(sizes) == 4


def test_log_appends_and_table_replaces(spark, tmp_path):
    log, table = str(tmp_path / "log"), str(tmp_path / "table")
    for _ in range(2):
        tables.append_record(spark.range(1), log)
        tables.replace_table(spark.range(4), table)
    assert tables.read_table(spark, log).count() == 2
    assert tables.read_table(spark, table).count() == 4


def test_csv_sample_has_a_header(spark, tmp_path):
    rows = spark.range(500).withColumn("purchase_flag", (F.col("id") % 10 == 0).cast("int"))
    path = str(tmp_path / "csv")
    tables.export_sample_csv(rows, path, "id", "purchase_flag", 0.02)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["id", "purchase_flag"]
    assert back.groupBy("purchase_flag").count().orderBy("purchase_flag").collect() == [("0", 9), ("1", 1)]


def test_feature_export(spark, tmp_path):
    rows = spark.range(5).select("id", F.lit(1.5).alias("x"), F.lit("t").alias("noise"), F.lit(1).alias("label"))
    path = str(tmp_path / "f")
    tables.export_features(rows, path, ["id"], ["x"], "label")
    assert spark.read.parquet(path).columns == ["id", "x", "label"]


def test_query_over_frames(spark):
    found = tables.read_query(
        spark, "SELECT max(id) AS top FROM {rows} WHERE id < :limit", {"rows": spark.range(10)}, {"limit": 7}
    )
    assert found.first().top == 6


def test_offer_files(spark, tmp_path):
    header = "Offer Description,Start Date,End Date,Bonus Code,NPP,Funding,Notes,Other\n"
    (tmp_path / "2024.csv").write_text(header + '"Ring, gold",2024-01-05,2024-01-09,B1,Y,MG,,x\nNone,,,,,,,\n')
    (tmp_path / "2025.csv").write_text(header + "Bolt,2025-02-01,2025-02-03,B2,N,MG,note,x\n")
    found = offers.read_offer_years(spark, str(tmp_path), [2024, 2025])
    rows = {r.offer_description: r for r in found.collect()}
    assert set(rows) == {"Ring, gold", "Bolt"}
    assert rows["Ring, gold"].start_date == dt.date(2024, 1, 5)
    assert found.columns == ["offer_description", "start_date", "end_date", "bonus_code", "npp", "funding", "notes"]


def test_embedding_table_stacks_segments(spark):
    vectors = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "lightfm_id long, embedding array<float>")
    ids = spark.createDataFrame([(1, 7, "e7")], "lightfm_id long, user_id long, epsilon_id string")
    found = embedding_table([(vectors, ids), (vectors, ids)], 2).collect()
    assert [(r.latent_0, r.latent_1, r.epsilon_id) for r in found] == [(3.0, 4.0, "e7")] * 2


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="latent_1"):
        require_columns(spark.range(1).withColumn("latent_0", F.lit(0)), ["latent_0", "latent_1"])


def test_null_audit_lists_only_columns_with_nulls(spark):
    rows = spark.createDataFrame([(1, None, "a"), (2, 3.0, None), (3, None, "c")], "a int, b double, c string")
    assert {r.column_name: r.null_count for r in null_audit(rows).collect()} == {"b": 2, "c": 1}


def test_affix_and_float_columns(spark):
    rows = spark.createDataFrame([("a", 1.5, 2)], "k string, x double, y int")
    assert affix(rows, "p_", "_s", keep=["k"]).columns == ["k", "p_x_s", "p_y_s"]
    assert dict(as_float(rows, ["x", "y"]).dtypes) == {"k": "string", "x": "float", "y": "float"}


def test_weeks_with_different_columns(spark, tmp_path):
    path = str(tmp_path / "weekly")
    tables.write_snapshot(spark.createDataFrame([(1, 2)], "a int, b int"), path, "2001_327")
    tables.write_snapshot(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"), path, "2001_329")
    assert tables.read_snapshot(spark, path, "2001_327").columns == ["a", "b"]
    assert tables.read_snapshot(spark, path, "2001_329").columns == ["a", "b", "c"]


def test_vectors_of_another_length_raise(spark):
    from footfall.plans.embeddings import widen

    vectors = spark.createDataFrame([(1, [0.5, 0.25]), (2, None)], "lightfm_id long, embedding array<float>")
    assert [tuple(r) for r in widen(vectors, 2).orderBy("lightfm_id").collect()] == [(1, 0.5, 0.25), (2, None, None)]
    with pytest.raises(Exception, match="vector of 1 numbers expected, found 2"):
        widen(vectors, 1).collect()


def test_no_threshold_raises(spark):
    from footfall.plans import likelihood

    log = spark.createDataFrame(
        [("b", None, "2024-01-02"), ("b", 0.4, "2024-01-01"), ("c", 0.9, "2024-01-03")],
        "banner string, optimal_threshold double, train_timestamp string",
    )
    assert [r[0] for r in likelihood.newest_threshold(log, "b").collect()] == [0.4]
    scores = spark.createDataFrame([("x", 0.99)], "epsilon_id string, predicted_purchase_prob double")
    views = spark.createDataFrame([("x", 1, 2, 0.5)], "epsilon_id string, weeks_views long, shop_view_weeks long, lambda_views double")
    with pytest.raises(Exception, match="no threshold is known"):
        likelihood.likelihood_labels(scores, views, likelihood.newest_threshold(log, "none")).collect()
