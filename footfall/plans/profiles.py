"""Purchase and point profiles as of a date.

Both exist per card and banner (``BY_CARD``) and per customer and banner (``BY_CUSTOMER``). The
customer form is the one models use: it merges a customer's cards before measuring gaps and windows,
instead of keeping one card's row. A customer with several profile ids carries the smallest.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.dates import date_id, day
from footfall.plans.transactions import newest

WINDOWS = (30, 60, 90, 120, 365)
BY_CARD = ("cardnumber", "banner")
BY_CUSTOMER = ("epsilon_id", "banner")
GAP_COLUMNS = (
    "days_since_last_purchase_p25",
    "days_since_last_purchase_p50",
    "days_since_last_purchase_p75",
    "avg_days_since_last_purchase",
    "stddev_days_since_last_purchase",
)
POINT_MEASURES = {
    "base_points": "loyalty_base_points_dol",
    "credit_points": "loyalty_credit_points_dol",
    "bonus_points": "loyalty_bonus_points_dol",
    "redemption_points": "loyalty_redemption_points_dol",
    "total_loyalty_point_balance": "loyalty_total_points_dol",
}


def daily_purchases(transactions: DataFrame) -> DataFrame:
    """Purchases and sales per card, banner and day."""
    return transactions.groupBy(*BY_CARD, "tx_date").agg(
        F.count("*").alias("purchases"), F.sum("sales").alias("sales")
    )


def of_customers(by_card: DataFrame, accounts: DataFrame) -> DataFrame:
    """Replace the card by its customer; cards without an account fall out."""
    return by_card.join(accounts.select("cardnumber", "epcl_profileid", "epsilon_id"), "cardnumber").drop(
        "cardnumber"
    )


def smallest_profile_id(rows: DataFrame, keys: Sequence[str]) -> list[Column]:
    """The profile id as an attribute of the key, where rows have one that is not part of it."""
    name = "epcl_profileid"
    return [F.min(name).alias(name)] if name in rows.columns and name not in keys else []


def _within(days: int, age: Column, measure: Column) -> Column:
    return F.sum(F.when(age <= days, measure).otherwise(F.lit(0)))


def _gap_statistics(purchases: Column, days: Column) -> dict[str, Column]:
    """Quartiles, mean and sample deviation of the day gaps between successive purchases.

    ``days`` is the sorted array of distinct purchase days. Purchases beyond the first of a day have
    gap 0, so the sorted gaps are that many zeros followed by the sorted gaps between days. Quartile
    ``p`` is the gap at position ``ceil(p * n)``.
    """
    gaps = F.transform(F.slice(days, 2, F.size(days)), lambda d, i: F.datediff(d, F.get(days, i)))
    n = purchases - 1
    zeros = purchases - F.size(days)

    def quartile(p: float) -> Column:
        position = F.ceil(n * F.lit(p)).cast("int")
        between_days = F.get(F.array_sort(gaps), (position - zeros).cast("int") - 1)
        return F.when(n >= 1, F.when(position <= zeros, 0).otherwise(between_days))

    total = F.datediff(F.array_max(days), F.array_min(days)).cast("double")
    squares = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, g: s + g * g)
    variance = F.try_divide(squares - F.try_divide(total * total, n), n - 1)
    values = (
        quartile(0.25),
        quartile(0.5),
        quartile(0.75),
        F.try_divide(total, n),
        F.sqrt(F.greatest(variance, F.when(n >= 2, 0.0))),
    )
    return dict(zip(GAP_COLUMNS, values))


def purchase_profile(
    daily: DataFrame, as_of: dt.date, keys: Sequence[str] = BY_CUSTOMER, windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Purchase counts, gap statistics, sales per look-back window and recency, per key.

    One aggregation: counts and sums combine before the shuffle, and the only collection is the set
    of purchase days, never longer than the look-back.
    """
    age = F.datediff(day(as_of), F.col("tx_date"))
    per_window = [
        column
        for d in windows
        for column in (
            _within(d, age, F.col("purchases")).alias(f"num_of_purchases_last_{d}_days"),
            _within(d, age, F.col("sales")).alias(f"sales_last_{d}_days"),
        )
    ]
    profile = daily.groupBy(*keys).agg(
        F.sum("purchases").alias("total_purchases"),
        F.array_sort(F.collect_set("tx_date")).alias("_days"),
        *smallest_profile_id(daily, keys),
        *per_window,
    )
    first, last = F.array_min("_days"), F.array_max("_days")
    return profile.withColumns(
        {
            "first_purchase_date": date_id(first),
            "last_purchase_date": date_id(last),
            "days_since_first_purchase": F.datediff(day(as_of), first),
            "days_since_last_purchase": F.datediff(day(as_of), last),
            **_gap_statistics(F.col("total_purchases"), F.col("_days")),
        }
    ).drop("_days")


def card_points(summary: DataFrame, as_of: dt.date, windows: Sequence[int] = WINDOWS) -> DataFrame:
    """Point sums per look-back window, dates and newest balance per card and banner."""
    age = F.datediff(day(as_of), F.col("tx_date"))
    order = newest(summary)
    sums = [
        _within(d, age, F.col(column)).alias(f"{name}_last_{d}_days")
        for d in windows
        for name, column in POINT_MEASURES.items()
    ]
    return summary.groupBy(*BY_CARD).agg(
        F.max("registerdate").alias("register_date"),
        F.max("enrolldate").alias("enroll_date"),
        F.max_by("dollarbalance", order).alias("dollarbalance"),
        F.max(order).alias("_newest"),
        *sums,
    )


def point_profile(
    card_level: DataFrame, accounts: DataFrame, keys: Sequence[str] = BY_CUSTOMER
) -> DataFrame:
    """Point profile per key from :func:`card_points`.

    Cards are reduced before the account join, so the join sees one row per card whatever the
    activity of a card; a customer's cards are then added up.
    """
    joined = card_level.join(
        accounts.select("cardnumber", "epcl_profileid", "epsilon_id"), "cardnumber"
    )
    if list(keys) == list(BY_CARD):
        return joined.drop("_newest")
    sums = [c for c in card_level.columns if c.endswith("_days")]
    return joined.groupBy(*keys).agg(
        F.max("register_date").alias("register_date"),
        F.max("enroll_date").alias("enroll_date"),
        F.max_by("dollarbalance", "_newest").alias("dollarbalance"),
        *smallest_profile_id(joined, keys),
        *[F.sum(c).alias(c) for c in sums],
    )
