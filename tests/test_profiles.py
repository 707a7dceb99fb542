"""Hand-worked rows for transactions, profiles, history and labels."""

from __future__ import annotations

import datetime as dt
import math
import statistics

import pytest
from pyspark.sql import functions as F

from footfall.context import Week, resolve_week
from footfall.plans import history, labels, profiles, transactions
from footfall.plans.calendar import regular_calendar

WEEK = Week("2001_327", dt.date(2001, 6, 30), dt.date(2001, 7, 6))
DETAIL = (
    "loyalty_card_num string, p_trans_dateid string, transactiontype string, banner string, "
    "p_banner string, sales double, lms_transaction_id long"
)


def detail(spark, rows):
    filled = [
        (card, day, kind, banner, banner, sales, tid) for card, day, kind, banner, sales, tid in rows
    ]
    return spark.createDataFrame(filled, DETAIL)


def purchase(card, day, tid, sales=10.0):
    return (card, day, "Purchase", "B1", sales, tid)


def clean(spark, rows):
    return transactions.clean_transactions(
        detail(spark, rows), "B1", dt.date(1998, 7, 1), dt.date(2001, 6, 29)
    )


def accounts(spark, rows):
    return transactions.accounts(
        spark.createDataFrame(rows, "cardnumber string, customerid long, epcl_profileid string")
    )


def card_profile(spark, rows):
    daily = profiles.daily_purchases(clean(spark, rows))
    return {r.cardnumber: r for r in profiles.purchase_profile(daily, WEEK.start, profiles.BY_CARD).collect()}


def test_single_transaction_has_no_gaps(spark):
    row = card_profile(spark, [purchase("A1", "20010601", 1)])["A1"]
    assert row.total_purchases == 1
    assert [row[c] for c in profiles.GAP_COLUMNS] == [None] * 5


def test_two_transactions_on_one_day_have_gap_zero(spark):
    rows = [purchase("A1", "20010601", 1), purchase("A1", "20010601", 2)]
    row = card_profile(spark, rows)["A1"]
    assert row.total_purchases == 2
    assert [row[c] for c in profiles.GAP_COLUMNS] == [0, 0, 0, 0.0, None]
    gaps = transactions.purchase_gaps(clean(spark, rows)).orderBy("lms_transaction_id").collect()
    assert [g.gap_days for g in gaps] == [None, 0]


def test_lines_of_a_transaction_are_summed(spark):
    rows = [purchase("A1", "20010601", 1, 3.0), purchase("A1", "20010601", 1, 4.5)]
    found = clean(spark, rows).collect()
    assert [(r.lms_transaction_id, r.sales) for r in found] == [(1, 7.5)]


def test_transaction_id_on_two_dates_keeps_both_with_the_whole_total(spark):
    rows = [purchase("A1", "20010601", 1, 3.0), purchase("A1", "20010602", 1, 4.5)]
    found = clean(spark, rows).orderBy("p_trans_dateid").collect()
    assert [(r.p_trans_dateid, r.sales) for r in found] == [("20010601", 7.5), ("20010602", 7.5)]


def test_unknown_cards_returns_and_other_banners_are_dropped(spark):
    rows = [
        purchase(None, "20010601", 1),
        ("A1", "20010601", "Return", "B1", 1.0, 2),
        ("A1", "20010601", "Purchase", "B2", 1.0, 3),
        purchase("A1", "20010630", 4),
    ]
    assert clean(spark, rows).count() == 0


def test_window_edges(spark):
    at = {n: (WEEK.start - dt.timedelta(days=n)).strftime("%Y%m%d") for n in (30, 31)}
    row = card_profile(spark, [purchase("A1", at[30], 1), purchase("A1", at[31], 2)])["A1"]
    assert row.num_of_purchases_last_30_days == 1
    assert row.num_of_purchases_last_60_days == 2
    assert row.days_since_last_purchase == 30
    assert row.days_since_first_purchase == 31


def test_gap_statistics_match_the_definition(spark):
    days = [1, 1, 3, 3, 3, 10, 11, 19, 28, 28, 28]
    rows = [purchase("A1", f"200105{d:02d}", i) for i, d in enumerate(days)]
    row = card_profile(spark, rows)["A1"]
    gaps = sorted(b - a for a, b in zip(days, days[1:]))
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        assert row[f"days_since_last_purchase_{name}"] == gaps[math.ceil(p * len(gaps)) - 1]
    assert row.avg_days_since_last_purchase == pytest.approx(statistics.mean(gaps))
    assert row.stddev_days_since_last_purchase == pytest.approx(statistics.stdev(gaps))


def test_two_cards_become_one_customer(spark):
    rows = [purchase("A1", "20010601", 1), purchase("B1", "20010605", 2)]
    daily = profiles.of_customers(
        profiles.daily_purchases(clean(spark, rows)), accounts(spark, [("A1", 1, "P1"), ("B1", 1, "P1")])
    )
    found = profiles.purchase_profile(daily, WEEK.start).collect()
    assert len(found) == 1
    assert (found[0].total_purchases, found[0].days_since_last_purchase_p50) == (2, 4)


def summary(spark, rows):
    raw = spark.createDataFrame(
        [("A1", "B1", "B1", day, tid, 1.0, 2.0, 3.0, 4.0, 5.0, cents) for day, tid, cents in rows],
        "cardnumber string, banner string, p_banner string, p_trans_dateid string, lms_transaction_id long, "
        "loyalty_base_points_dol double, loyalty_credit_points_dol double, loyalty_bonus_points_dol double, "
        "loyalty_redemption_points_dol double, loyalty_total_points_dol double, dollarbalance long",
    ).withColumns(
        {"enrolldate": F.lit("1990-01-01").cast("date"), "registerdate": F.lit("1990-02-01").cast("date")}
    )
    return transactions.point_summary(raw, "B1", dt.date(1998, 7, 1), dt.date(2001, 6, 29))


def test_greater_id_wins_among_equal_dates(spark):
    found = summary(spark, [("20010601", 7, 100), ("20010601", 9, 300), ("20010501", 99, 500)])
    assert transactions.recent_balance(found).first().dollarbalance == 3.0
    cards = profiles.card_points(found, WEEK.start)
    row = profiles.point_profile(cards, accounts(spark, [("A1", 1, "P1")])).first()
    assert (row.dollarbalance, row.base_points_last_30_days, row.base_points_last_60_days) == (3.0, 2.0, 3.0)


def test_newest_orders_by_date_then_id_for_any_id_type(spark):
    rows = [("2001-01-01", 9), ("2001-01-02", -5), ("2001-01-02", 2**62), ("1960-01-01", 2**63 - 1)]
    frame = spark.createDataFrame(rows, "d string, i long").withColumn("d", F.col("d").cast("date"))
    as_text = frame.withColumn("i", F.col("i").cast("string"))
    for source in (frame, as_text):
        best = source.agg(F.max_by("i", transactions.newest(source, "d", "i")).alias("i")).first().i
        assert int(best) == 2**62
    ordered = frame.orderBy(transactions.newest(frame, "d", "i")).collect()
    assert [(str(r.d), r.i) for r in ordered] == sorted(rows)


def test_history_matrix_positions(spark):
    calendar = regular_calendar(spark, dt.date(1994, 12, 31), 1518)
    rows = [purchase("A1", "20010629", 1), purchase("A1", "20010622", 2), purchase("A1", "19990703", 3)]
    daily = profiles.of_customers(profiles.daily_purchases(clean(spark, rows)), accounts(spark, [("A1", 1, "P1")]))
    weeks = history.purchase_history(daily, calendar, WEEK)
    matrix = history.purchase_matrix(weeks, calendar, WEEK).first().asDict()
    assert len(matrix) == 105
    assert {c for c, v in matrix.items() if v == 1} == {
        "1_weeks_back_purchase",
        "2_weeks_back_purchase",
        "104_weeks_back_purchase",
    }
    seasons = history.season_matrix(weeks, calendar, WEEK).first()
    assert [seasons[f"deal_season_num_{n}"] for n in (1, 2, 3, 4)] == [0, 1, 1, 0]


def test_calendar_numbers_weeks_by_their_last_day(spark):
    calendar = regular_calendar(spark, dt.date(1994, 12, 31), 1518)
    numbered = calendar.groupBy("deal_yr").agg(
        F.count("*").alias("n"), F.min("deal_wk").alias("first"), F.max("deal_wk").alias("last")
    )
    assert all(r.n == r.last and r["first"] == 1 for r in numbered.collect())
    assert numbered.agg(F.max("last")).first()[0] == 53
    late = calendar.filter("deal_wk = 53").first()
    assert late.deal_season_num == 4 and late.week_identifier.endswith("_353")
    first = calendar.filter("deal_wk = 1").first()
    assert first.week_identifier.endswith("_301")


def test_resolve_week(spark):
    calendar = regular_calendar(spark, dt.date(1994, 12, 31), 1518)
    assert resolve_week(calendar, "2001_327") == WEEK
    with pytest.raises(ValueError):
        resolve_week(calendar, "2001_399")


def test_labels_cover_the_whole_target_week(spark):
    week = Week("2001_329", dt.date(2001, 7, 14), dt.date(2001, 7, 20))
    rows = [
        purchase("A1", "20010714", 1),
        purchase("B1", "20010720", 2),
        purchase("A2", "20010721", 3),
        purchase("A3", "20010713", 4),
    ]
    owners = accounts(spark, [("A1", 1, "P1"), ("B1", 1, "P1"), ("A2", 2, "P2"), ("A3", 3, "P3")])
    found = labels.purchase_labels(detail(spark, rows), owners, "B1", week).collect()
    assert [(r.epcl_profileid, r.purchase_flag) for r in found] == [("P1", "Y")]


def test_one_card_with_most_rows(spark):
    """A card holding nine tenths of the rows gives the same previous dates as a plain window."""
    rows = (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 10 == 0, F.concat(F.lit("A"), F.col("id").cast("string")))
            .otherwise("hot")
            .alias("cardnumber"),
            F.lit("B1").alias("banner"),
            F.col("id").alias("lms_transaction_id"),
            F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 7919 % 400).cast("int")).alias("tx_date"),
        )
    )
    rows.createOrReplaceTempView("busy")
    plain = spark.sql(
        "SELECT *, lag(tx_date) OVER (PARTITION BY cardnumber, banner ORDER BY tx_date, lms_transaction_id) "
        "AS prev_tx_date FROM busy"
    )
    found = transactions.with_previous_date(rows)
    assert found.count() == 3000
    assert found.exceptAll(plain.select(*found.columns)).count() == 0


def test_customer_with_two_profile_ids_has_one_row(spark):
    rows = [purchase("A1", "20010601", 1), purchase("B1", "20010611", 2), purchase("A2", "20010601", 3)]
    owners = accounts(spark, [("A1", 1, "P9"), ("B1", 1, "P1"), ("A2", 2, "P2")])
    daily = profiles.of_customers(profiles.daily_purchases(clean(spark, rows)), owners)
    found = {r.epcl_profileid: r for r in profiles.purchase_profile(daily, WEEK.start).collect()}
    assert set(found) == {"P1", "P2"}
    assert (found["P1"].total_purchases, found["P1"].avg_days_since_last_purchase) == (2, 10.0)
