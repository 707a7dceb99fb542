"""How often customers view offers, shop, and do both in one week."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from footfall.context import Week
from footfall.functions.dates import day
from footfall.functions.ids import hashed_id
from footfall.operators.calendar_join import every_week, join_weeks
from footfall.operators.shape import attach_one_row
from footfall.plans.transactions import with_previous_date

VIEW_CHANNELS = (
    "program_website_view_date",
    "program_app_view_date",
    "email_view_date",
    "banner_website_view_date",
    "banner_page_view_date",
    "banner_app_view_date",
)
WEEK_KEYS = ("customerid", "deal_yr", "deal_wk", "p_banner")
BASE_DAYS = 372
STATISTIC_DAYS = 365
WEEKS_PER_YEAR = 52


def active_ids(active_customers: DataFrame) -> DataFrame:
    return active_customers.select(F.col("customer_id").alias("customerid")).withColumn(
        "epsilon_id", hashed_id("customerid")
    )


def offer_views(
    views: DataFrame,
    mapping: DataFrame,
    active_customers: DataFrame,
    banners: Sequence[str],
    first: dt.date,
    end: dt.date,
    channels: Sequence[str] = VIEW_CHANNELS,
) -> DataFrame:
    """Days in ``[first, end)`` on which an active customer saw an offer on any channel.

    Impressions shrink to one row per customer, banner and day before they meet the customers, and
    the two customer tables are joined to each other first, so views are joined once.
    """
    seen = (
        views.filter(
            (F.col("p_trans_dateid") >= day(first))
            & (F.col("p_trans_dateid") < day(end))
            & F.col("p_banner").isin(list(banners))
            & F.coalesce(*channels).isNotNull()
        )
        .select(F.col("customerid").alias("epcl_id"), "p_banner", F.col("p_trans_dateid").alias("view_date"))
        .distinct()
    )
    viewers = (
        mapping.select("epcl_id", F.col("customer_id_hashed").alias("epsilon_id"))
        .join(active_ids(active_customers), "epsilon_id")
        .select("epcl_id", "customerid")
    )
    return (
        seen.join(viewers, "epcl_id")
        .select("customerid", "p_banner", "view_date")
        .distinct()
        .withColumn("view_ind", F.lit(1))
    )


def offer_views_by_week(offer_views: DataFrame, calendar: DataFrame, first: dt.date, end: dt.date) -> DataFrame:
    return join_weeks(offer_views, "view_date", calendar, first, end - dt.timedelta(days=1))


def transaction_base(
    transactions: DataFrame, accounts: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """Every transaction with its customer, previous date and week.

    The account join is the last shuffle and nothing after it asks for its partitioning, so adaptive
    execution is free to split the partition of a very active card, given accounts straight from a
    table (not from an aggregate by card).
    """
    rows = (
        with_previous_date(transactions)
        .join(accounts.select("cardnumber", "customerid"), "cardnumber")
        .select(
            "customerid",
            "p_trans_dateid",
            F.col("tx_date").alias("transaction_date"),
            F.col("banner").alias("p_banner"),
            "lms_transaction_id",
            F.lit(1).alias("purchase_flag"),
            "sales",
            "tx_epoch",
            "prev_tx_date",
        )
    )
    return join_weeks(rows, "transaction_date", calendar, first, last)


def shopping_days(
    daily: DataFrame, accounts: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date
) -> DataFrame:
    """The transaction base at day grain, all the statistics need: one row per card and shopping day.

    ``daily`` has one row per card, banner and day, so no card is large in the account join.
    """
    rows = daily.join(accounts.select("cardnumber", "customerid"), "cardnumber").select(
        "customerid",
        F.col("tx_date").alias("transaction_date"),
        F.col("banner").alias("p_banner"),
        F.lit(1).alias("purchase_flag"),
    )
    return join_weeks(rows, "transaction_date", calendar, first, last)


def customer_base(
    active_customers: DataFrame, calendar: DataFrame, week: Week, banner: str, days: int = BASE_DAYS
) -> DataFrame:
    """Active customers times the weeks ending in the last ``days`` days, up to ``week`` itself."""
    customers = active_customers.select(F.col("customer_id").alias("customerid"))
    first = week.days_before(days - 1)
    return every_week(customers, calendar, first, week.start).withColumn("p_banner", F.lit(banner))


def _weekly_shops(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(*WEEK_KEYS).agg(
        F.max("transaction_date").alias("last_shop_date"),
        F.max("purchase_flag").alias("shop_ind"),
        F.count_distinct("transaction_date").alias("weekly_trips"),
    )


def weekly_shop_view(
    base: DataFrame, transactions: DataFrame, views: DataFrame, week: Week, days: int = STATISTIC_DAYS
) -> DataFrame:
    """Per customer and week: shopped, viewed, both, number of shopping days, last one.

    ``transactions`` is a :func:`transaction_base` or :func:`shopping_days`. Transactions and views
    shrink to one row per customer and week before the joins.
    """
    shop, view = F.coalesce("shop_ind", F.lit(0)), F.coalesce("view_ind", F.lit(0))
    weekly_views = views.groupBy(*WEEK_KEYS).agg(F.max("view_ind").alias("view_ind"))
    return (
        base.filter(F.col("start_date").between(day(week.days_before(days)), day(week.start)))
        .join(_weekly_shops(transactions), list(WEEK_KEYS), "left")
        .join(weekly_views, list(WEEK_KEYS), "left")
        .select(
            *WEEK_KEYS,
            "start_date",
            "end_date",
            "last_shop_date",
            shop.alias("weekly_shop_ind"),
            view.alias("weekly_view_ind"),
            F.coalesce("weekly_trips", F.lit(0)).alias("weekly_trips"),
            F.when((shop == 1) & (view == 1), 1).otherwise(0).alias("weekly_shop_view_ind"),
        )
    )


def statistic_features(
    active_customers: DataFrame,
    transactions: DataFrame,
    views: DataFrame,
    calendar: DataFrame,
    week: Week,
    days: int = STATISTIC_DAYS,
    weeks_per_year: int = WEEKS_PER_YEAR,
) -> DataFrame:
    """Weeks with a view, weeks with a view and a purchase, and the weekly view rate.

    ``transactions`` is a :func:`transaction_base` or :func:`shopping_days`. Only active customers
    with a purchase up to the start of ``week`` are listed. A week without activity adds nothing to
    any sum, so the customers x weeks base is never built: views and transactions are stacked, reduced
    to customer and week, then to customer. The window holds the starts of 53 weeks, but views end
    before the last of them, so the rate over 52 stays within 1.
    """
    stacked = views.select(
        "customerid",
        "p_banner",
        "start_date",
        F.col("view_ind").alias("viewed"),
        F.lit(0).alias("shopped"),
        F.lit(None).cast("date").alias("transaction_date"),
    ).unionByName(
        transactions.select(
            "customerid",
            "p_banner",
            "start_date",
            F.lit(0).alias("viewed"),
            F.col("purchase_flag").alias("shopped"),
            "transaction_date",
        )
    )
    weekly = stacked.groupBy("customerid", "p_banner", "start_date").agg(
        F.max("viewed").alias("viewed"),
        F.max("shopped").alias("shopped"),
        F.min("transaction_date").alias("earliest"),
    )
    recent = F.col("start_date").between(day(week.days_before(days)), day(week.start))
    per_customer = (
        weekly.groupBy("customerid", "p_banner")
        .agg(
            F.sum(F.when(recent, F.col("viewed")).otherwise(0)).alias("weeks_views"),
            F.sum(F.when(recent, F.col("viewed") * F.col("shopped")).otherwise(0)).alias("shop_view_weeks"),
            F.min("earliest").alias("earliest"),
        )
        .filter(F.col("earliest") <= day(week.start))
        .withColumn("lambda_views", F.col("weeks_views") / weeks_per_year)
    )
    this_week = calendar.filter(F.col("week_identifier") == week.identifier).select(
        "start_date", "end_date", "deal_yr", "deal_wk"
    )
    listed = per_customer.join(active_ids(active_customers), "customerid")
    return attach_one_row(listed, this_week).select(
        F.col("customerid").alias("customer_id"),
        "epsilon_id",
        "p_banner",
        "start_date",
        "end_date",
        "deal_yr",
        "deal_wk",
        "weeks_views",
        "shop_view_weeks",
        "lambda_views",
    )
