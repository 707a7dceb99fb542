"""Week joins and interval overlap against their plain comparison forms."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from footfall.operators.calendar_join import (
    every_week,
    join_ranges,
    join_weeks,
    weeks_by_day,
    weeks_overlapping,
)
from footfall.plans.calendar import regular_calendar
from footfall.plans.promo import promo_history, qualifying

FIRST, LAST = dt.date(2000, 1, 1), dt.date(2001, 12, 28)


@pytest.fixture(scope="module")
def calendar(spark):
    return regular_calendar(spark, dt.date(1994, 12, 31), 1518)


def dated(spark, rows=2000):
    return spark.range(rows).select(
        "id", F.date_add(F.lit("1999-06-01").cast("date"), (F.col("id") * 37 % 1300).cast("int")).alias("at")
    )


def test_both_joins_equal_the_comparison(spark, calendar):
    rows = dated(spark)
    rows.createOrReplaceTempView("dated_rows")
    calendar.createOrReplaceTempView("weeks_table")
    plain = spark.sql(
        f"SELECT r.*, w.* FROM dated_rows r JOIN weeks_table w ON r.at BETWEEN w.start_date AND w.end_date "
        f"WHERE r.at BETWEEN DATE '{FIRST}' AND DATE '{LAST}'"
    )
    for join in (join_weeks, join_ranges):
        found = join(rows, "at", calendar, FIRST, LAST)
        assert found.count() == plain.count()
        assert found.select(*plain.columns).exceptAll(plain).count() == 0


def test_no_nested_loop(spark, calendar):
    for join in (join_weeks, join_ranges):
        plan = join(dated(spark), "at", calendar, FIRST, LAST)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("seed", range(4))
def test_overlap_forms_agree_with_brute_force(spark, calendar, seed):
    import random

    chance = random.Random(seed)
    intervals = []
    for _ in range(25):
        start = dt.date(1999, 11, 1) + dt.timedelta(days=chance.randrange(900))
        intervals.append((start, start + dt.timedelta(days=chance.randrange(-5, 30))))
    intervals += [(None, dt.date(2000, 5, 5)), (dt.date(2000, 5, 5), None)]
    frame = spark.createDataFrame(intervals, "start_date date, end_date date")
    days = set()
    for start, end in intervals:
        if start and end:
            days |= {start + dt.timedelta(days=i) for i in range((end - start).days + 1)}
    days = {d for d in days if FIRST <= d <= LAST}
    want = {w.week_identifier for w in calendar.collect() if any(w.start_date <= d <= w.end_date for d in days)}
    for find in (weeks_overlapping, weeks_by_day):
        assert {r.week_identifier for r in find(frame, calendar, FIRST, LAST).collect()} == want


def test_offer_across_a_week_edge_flags_both_weeks(spark, calendar):
    offers = spark.createDataFrame(
        [
            ("ring sale", dt.date(2001, 6, 29), dt.date(2001, 6, 30), "Y", "Brand#1"),
            ("ring sale", dt.date(2001, 3, 9), dt.date(2001, 3, 1), "Y", "Brand#1"),
            (None, dt.date(2001, 1, 9), dt.date(2001, 1, 9), "Y", "Brand#1"),
            ("ring", dt.date(2001, 2, 9), dt.date(2001, 2, 9), None, "Brand#1"),
            ("PROMO ring", dt.date(2001, 2, 19), dt.date(2001, 2, 19), "Y", "Brand#1"),
        ],
        "offer_description string, start_date date, end_date date, npp string, funding string",
    )
    chosen = qualifying(offers, "Brand#1", "RING", ["PROMO"])
    for by_day in (False, True):
        found = promo_history(chosen, calendar, 2001, 2001, by_day)
        assert found.count() == calendar.filter("deal_yr = 2001").count()
        assert {r.week_identifier for r in found.filter("npp_flag = 1").collect()} == {"2001_326", "2001_327"}


def test_every_week_lists_the_weeks_of_the_window(spark, calendar):
    base = every_week(spark.range(3), calendar, dt.date(2001, 1, 6), dt.date(2001, 2, 3))
    assert base.count() == 3 * 5
    assert "NestedLoop" not in base._jdf.queryExecution().toString()
