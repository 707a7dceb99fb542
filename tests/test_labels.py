"""Affinity statistics, likelihood labels, test/control groups and the overlay."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from footfall.context import Week
from footfall.functions.ids import hashed_id
from footfall.plans import affinity, experiment, likelihood
from footfall.plans.calendar import regular_calendar
from footfall.session import cut_lineage

WEEK = Week("2024_305", dt.date(2024, 1, 27), dt.date(2024, 2, 2))


def test_hashed_id_normalises_text(spark):
    row = spark.range(1).select(
        hashed_id(F.lit(" ab1 ")).alias("a"), hashed_id(F.lit("AB1")).alias("b"), hashed_id(F.lit(7)).alias("c")
    )
    found = row.first()
    assert found.a == found.b and found.c == "8f14e45fceea167a5a36dedd4bea2543"


def views(spark, rows):
    empty = {c: F.lit(None).cast("date") for c in affinity.VIEW_CHANNELS}
    frame = spark.createDataFrame(rows, "customerid long, p_banner string, p_trans_dateid date, seen boolean")
    return frame.withColumns(empty).withColumn("email_view_date", F.when(F.col("seen"), F.col("p_trans_dateid")))


def test_statistics_equal_the_sums_over_the_weekly_base(spark):
    calendar = regular_calendar(spark, dt.date(1994, 12, 31), 1518)
    active = spark.createDataFrame([(1,), (2,), (3,), (4,)], "customer_id long")
    mapping = active.select(
        F.col("customer_id").alias("epcl_id"), hashed_id("customer_id").alias("customer_id_hashed")
    )
    days = [dt.date(2024, 1, 26) - dt.timedelta(days=9 * i) for i in range(60)]
    seen = [(1 + i % 3, "B1", d, i % 4 != 0) for i, d in enumerate(days)]
    seen += [(1, "B1", WEEK.start, True), (1, "B9", days[0], True), (8, "B1", days[0], True)]
    first, end = WEEK.days_before(1095), WEEK.start
    looked = affinity.offer_views(views(spark, seen), mapping, active, ["B1"], first, end)
    by_week = affinity.offer_views_by_week(looked, calendar, first, end)
    bought = spark.createDataFrame(
        [(1 + i % 2, f"A{1 + i % 2}", d, 5.0, i) for i, d in enumerate(days)],
        "customerid long, cardnumber string, tx_date date, sales double, lms_transaction_id long",
    ).withColumns(
        {
            "banner": F.lit("B1"),
            "p_trans_dateid": F.date_format("tx_date", "yyyyMMdd"),
            "tx_epoch": F.lit(0),
        }
    )
    owners = spark.createDataFrame([("A1", 1), ("A2", 2)], "cardnumber string, customerid long")
    shops = affinity.transaction_base(
        bought.drop("customerid"), owners, calendar, first, end - dt.timedelta(days=1)
    )
    daily = bought.select("cardnumber", "banner", "tx_date").distinct()
    by_day = affinity.shopping_days(daily, owners, calendar, first, end - dt.timedelta(days=1))
    base = affinity.customer_base(active, calendar, WEEK, "B1")
    weekly = affinity.weekly_shop_view(base, shops, by_week, WEEK)
    want = {
        r.customerid: (r.v, r.sv)
        for r in weekly.groupBy("customerid")
        .agg(F.sum("weekly_view_ind").alias("v"), F.sum("weekly_shop_view_ind").alias("sv"))
        .collect()
    }
    found = affinity.statistic_features(active, shops, by_week, calendar, WEEK).collect()
    assert found == affinity.statistic_features(active, by_day, by_week, calendar, WEEK).collect()
    assert weekly.exceptAll(affinity.weekly_shop_view(base, by_day, by_week, WEEK)).count() == 0
    assert {r.customer_id for r in found} == {1, 2}
    assert {r.customer_id: (r.weeks_views, r.shop_view_weeks) for r in found} == {k: want[k] for k in (1, 2)}
    assert all(r.lambda_views == pytest.approx(r.weeks_views / 52) for r in found)
    assert all(r.start_date == WEEK.start and r.deal_wk == 5 for r in found)


def labelled(spark, predictions, statistics, threshold=0.5):
    return likelihood.likelihood_labels(
        spark.createDataFrame(predictions, "epsilon_id string, predicted_purchase_prob double"),
        spark.createDataFrame(
            statistics,
            "customer_id long, epsilon_id string, weeks_views long, shop_view_weeks long, lambda_views double",
        ),
        spark.createDataFrame([(threshold,)], "optimal_threshold double"),
    )


def test_no_views_and_no_statistics_give_low_lift(spark):
    found = {
        r.epsilon_id: r
        for r in labelled(spark, [("a", 0.5), ("b", 0.4)], [(1, "a", 0, 0, 0.0)]).collect()
    }
    assert found["a"].prob_shop_n_view_exp_01w == 0 and found["a"].aided_prob is None
    assert (found["a"].shop_prob_label, found["a"].lift_label) == ("H", "L")
    assert found["b"].customer_id is None
    assert (found["b"].shop_prob_label, found["b"].lift_label) == ("L", "L")


def test_lift_equal_to_the_threshold_is_high(spark):
    aided = (1 - math.exp(-1 / 52)) / (1 - math.exp(-2 / 52))
    score = aided / 1.07
    row = labelled(spark, [("a", score)], [(1, "a", 2, 1, 2 / 52)]).first()
    assert row.aided_prob == pytest.approx(aided)
    assert row.lift_label == ("H" if row.lift_ratio >= 1.07 else "L")
    above = labelled(spark, [("a", score * 0.999999)], [(1, "a", 2, 1, 2 / 52)]).first()
    assert above.lift_label == "H"


def test_newest_threshold(spark):
    runs = spark.createDataFrame(
        [("B1", "2024-01-01 00:00:00", 0.4), ("B1", "2024-01-03 00:00:00", 0.6), ("B2", "2024-01-09 00:00:00", 0.9)],
        "banner string, train_timestamp string, optimal_threshold double",
    )
    assert likelihood.newest_threshold(runs, "B1").first().optimal_threshold == 0.6


def test_overlay_replaces_only_test_customers_of_the_banner(spark):
    new = spark.createDataFrame(
        [(i, f"e{i}", "H", "H") for i in range(200)] + [(999, "e999", "H", "H")],
        "customer_id long, epsilon_id string, shop_prob_label string, lift_label string",
    )
    previous = spark.createDataFrame(
        [(i, b, "L", "L") for i in range(250) for b in ("B1", "B2")],
        "customer_id long, banner string, shop_prob_label string, lift_label string",
    )
    assigned = experiment.assigned(new, previous)
    groups = {r.customer_id: r.group_flag for r in assigned.collect()}
    assert set(groups) == set(range(200))
    final = experiment.final_labels(previous, assigned, "B1").collect()
    assert len(final) == 500
    for row in final:
        changed = row.banner == "B1" and groups.get(row.customerid) == "T"
        assert (row.shop_prob_label, row.lift_label) == (("H", "H") if changed else ("L", "L"))


def test_customer_with_several_rows_has_one_group(spark):
    new = spark.createDataFrame(
        [(i % 20, f"e{i}", "H", "L") for i in range(100)],
        "customer_id long, epsilon_id string, shop_prob_label string, lift_label string",
    )
    previous = spark.createDataFrame(
        [(i, "B1", "L", "L") for i in range(20)],
        "customer_id long, banner string, shop_prob_label string, lift_label string",
    )
    assigned = experiment.assigned(new, previous)
    assert assigned.groupBy("customer_id").agg(F.count_distinct("group_flag").alias("n")).filter("n > 1").count() == 0
    assert experiment.final_labels(previous, assigned, "B1").count() == 20


def test_a_very_active_card_is_split_in_the_account_join(spark):
    """The plan of the one row-level join lets adaptive execution cut a hot partition."""
    calendar = regular_calendar(spark, dt.date(1994, 12, 31), 1518)
    first, last = dt.date(2023, 1, 1), dt.date(2024, 1, 26)
    rows = spark.range(0, 60000, 1, 8).select(
        F.when(F.col("id") % 3 > 0, "hot")
        .otherwise(F.concat(F.lit("A"), F.col("id").cast("string")))
        .alias("cardnumber"),
        F.lit("B1").alias("banner"),
        F.col("id").alias("lms_transaction_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("id") % 380).cast("int")).alias("tx_date"),
        F.lit("20230101").alias("p_trans_dateid"),
        F.lit(1.0).alias("sales"),
        F.lit(0).cast("bigint").alias("tx_epoch"),
    )
    owners = cut_lineage(rows.select("cardnumber").distinct().withColumn("customerid", F.xxhash64("cardnumber")))
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    try:
        for k, v in lowered.items():
            spark.conf.set(k, v)
        base = affinity.transaction_base(rows, owners, calendar, first, last)
        assert len(base.collect()) == 60000
        assert "skew=true" in base._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
