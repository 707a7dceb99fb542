"""Card transactions and point summaries, cleaned, with the previous transaction date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.dates import date_from_id, epoch_seconds, text_id
from footfall.functions.ids import hashed_id

CARD = ("cardnumber", "banner")
LANES = 64


def accounts(loyalty_account: DataFrame) -> DataFrame:
    """Card to customer, with the hashed customer id."""
    return loyalty_account.select(
        "cardnumber", "customerid", "epcl_profileid", hashed_id("customerid").alias("epsilon_id")
    )


def _purchases(detail: DataFrame, banner: str, first: dt.date, last: dt.date) -> DataFrame:
    """Purchase lines of known cards dated ``first`` to ``last`` inclusive; every filter is pushable."""
    return detail.filter(
        F.col("p_trans_dateid").between(text_id(first), text_id(last))
        & (F.col("transactiontype") == "Purchase")
        & (F.col("p_banner") == banner)
        & F.col("loyalty_card_num").isNotNull()
    )


def clean_transactions(detail: DataFrame, banner: str, first: dt.date, last: dt.date) -> DataFrame:
    """One row per card, banner, transaction and date, with the transaction's total sales.

    The total runs over the whole transaction; an id seen on several dates gives one row per date,
    each with that total. Lines are summed before the shuffle and the dates of one id travel as a
    set no longer than the window, so a single shuffle does both.
    """
    return (
        _purchases(detail, banner, first, last)
        .groupBy(F.col("loyalty_card_num").alias("cardnumber"), "banner", "lms_transaction_id")
        .agg(F.sum("sales").alias("sales"), F.collect_set("p_trans_dateid").alias("_dates"))
        .select("cardnumber", "banner", "lms_transaction_id", "sales", F.explode("_dates").alias("p_trans_dateid"))
        .withColumn("tx_date", date_from_id("p_trans_dateid"))
        .withColumns({"tx_epoch": epoch_seconds("tx_date"), "purchase_flag": F.lit(1)})
    )


def buying_cards(detail: DataFrame, banner: str, first: dt.date, last: dt.date) -> DataFrame:
    """Distinct (card, banner) with a purchase in the window."""
    return (
        _purchases(detail, banner, first, last)
        .select(F.col("loyalty_card_num").alias("cardnumber"), "banner")
        .distinct()
    )


def point_summary(summary: DataFrame, banner: str, first: dt.date, last: dt.date) -> DataFrame:
    """Points and dollar balance (from cents) per transaction in the window."""
    return (
        summary.filter(
            F.col("p_trans_dateid").between(text_id(first), text_id(last)) & (F.col("p_banner") == banner)
        )
        .select(
            "cardnumber",
            "banner",
            "lms_transaction_id",
            "p_trans_dateid",
            "loyalty_base_points_dol",
            "loyalty_credit_points_dol",
            "loyalty_bonus_points_dol",
            "loyalty_redemption_points_dol",
            "loyalty_total_points_dol",
            (F.col("dollarbalance") * 0.01).alias("dollarbalance"),
            "enrolldate",
            "registerdate",
        )
        .withColumn("tx_date", date_from_id("p_trans_dateid"))
        .withColumn("tx_epoch", epoch_seconds("tx_date"))
    )


def with_previous_date(
    rows: DataFrame,
    keys: Sequence[str] = CARD,
    at: str = "tx_date",
    row_id: str = "lms_transaction_id",
    lanes: int = LANES,
) -> DataFrame:
    """Add ``prev_tx_date``: the date of the preceding row of the key, ordered by date and id.

    Dates carry no time, so only the first row of a day looks back to an earlier day; the others
    follow a row of their own day. Rows are hashed into lanes by id, and only the first row of each
    lane and day can be the first of its day. Those leaders, at most ``lanes`` per key and day, are
    put in date order together; every other row has its answer in its own date and stays alone. So
    the rows ordered together are those of a key, day and lane, then at most ``lanes`` times the days of
    the look-back, and the input is read once.
    """
    lane = F.pmod(F.xxhash64(row_id), F.lit(lanes)).cast("int")
    same_day = Window.partitionBy(*keys, at, "_lane").orderBy(row_id)
    in_order = Window.partitionBy(*keys, "_group").orderBy(at, row_id)
    leaders, alone = F.lit(0).cast("long"), F.xxhash64(row_id, at).bitwiseOR(F.lit(1))
    return (
        rows.withColumn("_lane", lane)
        .withColumn("_group", F.when(F.row_number().over(same_day) == 1, leaders).otherwise(alone))
        .withColumn("prev_tx_date", F.lag(at).over(in_order))
        .withColumn("prev_tx_date", F.when(F.col("_group") == 0, F.col("prev_tx_date")).otherwise(F.col(at)))
        .drop("_lane", "_group")
    )


def purchase_gaps(transactions: DataFrame) -> DataFrame:
    """Add ``gap_days`` to the previous purchase of the same card; NULL for the first."""
    return with_previous_date(transactions).withColumn("gap_days", F.datediff("tx_date", "prev_tx_date"))


def newest(rows: DataFrame, at: str = "tx_date", row_id: str = "lms_transaction_id") -> Column:
    """Sort key: by date, and by id within a date.

    Whole-number ids are packed behind the day into one decimal, whose fixed width keeps the
    aggregation a hash aggregation; for other ids it is a struct.
    """
    if dict(rows.dtypes)[row_id] not in ("tinyint", "smallint", "int", "bigint"):
        return F.struct(at, row_id)
    apart = F.lit(str(2 * 10**19)).cast("decimal(20,0)")
    return F.unix_date(at).cast("decimal(10,0)") * apart + F.col(row_id).cast("decimal(20,0)")


def recent_balance(summary: DataFrame, keys: Sequence[str] = CARD) -> DataFrame:
    """Balance after the latest transaction of each key; the greater id wins within a day."""
    return summary.groupBy(*keys).agg(
        F.max_by("dollarbalance", newest(summary)).alias("dollarbalance")
    )
