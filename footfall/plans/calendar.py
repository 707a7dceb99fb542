"""The deal-week calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.functions.dates import day
from footfall.functions.weeks import week_id

SEASON_WEEKS = 13
SEASONS = (1, 2, 3, 4)


def week_reference(calendar: DataFrame) -> DataFrame:
    """Add ``week_identifier`` to a calendar table of (start_date, end_date, deal_yr, deal_wk, ...)."""
    return calendar.withColumn("week_identifier", week_id("deal_yr", "deal_wk"))


def regular_calendar(spark: SparkSession, first_start: dt.date, weeks: int) -> DataFrame:
    """Consecutive seven-day weeks, numbered in the year they end in, in quarters of 13 weeks.

    The n-th week to end in a year ends on a day of year in ``7(n-1)+1 .. 7n``, so the number needs
    no window over the weeks.
    """
    start = F.date_add(day(first_start), (F.col("id") * 7).cast("int"))
    bounds = spark.range(weeks).select(start.alias("start_date"), F.date_add(start, 6).alias("end_date"))
    numbered = bounds.select(
        "start_date",
        "end_date",
        F.year("end_date").alias("deal_yr"),
        (F.floor((F.dayofyear("end_date") - 1) / 7) + 1).cast("int").alias("deal_wk"),
    )
    season = F.least(F.lit(len(SEASONS)), F.floor((F.col("deal_wk") - 1) / SEASON_WEEKS) + 1).cast("int")
    return week_reference(numbered).withColumn("deal_season_num", season)
