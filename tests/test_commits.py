"""Writes that die, collide or come twice."""

from __future__ import annotations

import pathlib

import pytest
from pyspark.sql import functions as F

from footfall.sources import tables
from footfall.sources.commits import COMMITS, WHOLE, CommitConflict, CommitLog


def dying(df, after):
    """Rows that raise once ``after`` of them are written."""
    return df.withColumn("id", F.when(F.col("id") < after, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")))


def values(df):
    return sorted(r.id for r in df.collect())


def test_a_dying_write_leaves_the_old_rows(spark, tmp_path):
    table, weekly = str(tmp_path / "table"), str(tmp_path / "weekly")
    tables.replace_table(spark.range(4), table)
    tables.write_snapshot(spark.range(3), weekly, "2001_327")
    both = spark.range(0, 100, 1, 4).withColumn(tables.SNAPSHOT, F.lit("2001_327"))
    for write in (
        lambda: tables.replace_table(dying(spark.range(0, 100, 1, 4), 60), table),
        lambda: tables.write_snapshot(dying(spark.range(0, 100, 1, 4), 60), weekly, "2001_327"),
        lambda: tables.write_snapshots(dying(both, 60), weekly),
    ):
        with pytest.raises(Exception, match="lost"):
            write()
    assert values(tables.read_table(spark, table)) == [0, 1, 2, 3]
    assert values(tables.read_snapshot(spark, weekly, "2001_327")) == [0, 1, 2]
    assert values(tables.read_table(spark, weekly)) == [0, 1, 2]


def test_a_table_can_be_replaced_by_rows_read_from_it(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(4), path)
    tables.replace_table(tables.read_table(spark, path).filter("id % 2 = 1"), path)
    assert values(tables.read_table(spark, path)) == [1, 3]


def test_an_open_reader_keeps_its_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(4), path, "2001_327")
    before = tables.read_snapshot(spark, path, "2001_327")
    tables.write_snapshot(spark.range(2), path, "2001_327")
    assert values(before) == [0, 1, 2, 3]
    assert values(tables.read_snapshot(spark, path, "2001_327")) == [0, 1]


def test_a_torn_commit_is_passed_over(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(4), path)
    torn = pathlib.Path(path, COMMITS, f"{2:020d}")
    torn.write_text('{"live": {"": "u')
    assert values(tables.read_table(spark, path)) == [0, 1, 2, 3]
    tables.replace_table(spark.range(1), path)
    assert values(tables.read_table(spark, path)) == [0]
    assert CommitLog(spark, path).numbers() == [1, 2, 3]


def test_writers_that_collide_both_keep_their_weeks(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_snapshot(spark.range(1), path, "2001_327")
    log, calls = CommitLog(spark, path), []

    def change(live):
        if not calls:
            calls.append(1)
            tables.write_snapshot(spark.range(2), path, "2001_328")
        return {**live, "2001_329": live["2001_327"]}

    commit = log.commit(change)
    assert set(commit.live) == {"2001_327", "2001_328", "2001_329"} and commit.number == 3
    with pytest.raises(CommitConflict, match="expected 2"):
        log.commit(lambda live: live, base=2)


def test_a_log_row_per_key_the_last_one_stays(spark, tmp_path):
    path = str(tmp_path / "log")
    keys = ["banner", "week"]

    def put(*rows):
        record = spark.createDataFrame(rows, "banner string, week string, at string, auc double")
        tables.upsert_record(record, path, keys, "at")

    put(("b", "1", "2024-01-01", 0.5))
    put(("b", "1", "2024-01-01", 0.6))
    put(("b", "2", "2024-01-02", 0.7), (None, "2", "2024-01-02", 0.8))
    put((None, "2", "2024-01-01", 0.1), ("b", "1", "2024-01-03", 0.9))
    found = sorted(map(tuple, tables.read_table(spark, path).collect()), key=str)
    assert found == [("b", "1", "2024-01-03", 0.9), ("b", "2", "2024-01-02", 0.7), (None, "2", "2024-01-02", 0.8)]


def test_a_log_takes_new_columns(spark, tmp_path):
    path = str(tmp_path / "log")
    tables.upsert_record(spark.createDataFrame([("a", "1")], "k string, at string"), path, ["k"], "at")
    tables.upsert_record(spark.createDataFrame([("b", "2", 3)], "k string, at string, more int"), path, ["k"], "at")
    assert sorted(map(tuple, tables.read_table(spark, path).collect())) == [("a", "1", None), ("b", "2", 3)]


def test_vacuum_removes_what_no_kept_commit_names(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        tables.write_snapshot(spark.range(n), path, "2001_327")
    tables.write_snapshot(spark.range(9), path, "2001_329")
    with pytest.raises(Exception, match="lost"):
        tables.write_snapshot(dying(spark.range(0, 9, 1, 2), 3), path, "2001_330")
    assert tables.vacuum(spark, path, keep=2) == 3
    assert tables.vacuum(spark, path, keep=2) == 0
    assert values(tables.read_snapshot(spark, path, "2001_327")) == [0, 1, 2, 3]
    assert len(values(tables.read_table(spark, path))) == 13
    tables.vacuum(spark, path, keep=1, orphan_seconds=-1.0)
    folders = {p.parent.name for p in pathlib.Path(path).rglob("*.parquet")}
    assert len(folders) == 2 and len(values(tables.read_table(spark, path))) == 13


def test_missing_weeks_are_named_and_plain_folders_read(spark, tmp_path):
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    tables.write_snapshot(spark.range(1), path, "2001_327")
    with pytest.raises(ValueError, match="2001_328"):
        tables.read_snapshot(spark, path, "2001_328")
    spark.range(3).write.parquet(f"{plain}/{tables.SNAPSHOT}=2001_327")
    assert values(tables.read_snapshot(spark, plain, "2001_327")) == [0, 1, 2]
    assert values(tables.read_table(spark, plain)) == [0, 1, 2]
    assert CommitLog(spark, path).newest().live.keys() == {"2001_327"} and WHOLE == ""
