"""National promotion periods: which weeks had a qualifying offer."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.context import Week
from footfall.functions.dates import day
from footfall.functions.weeks import weeks_between
from footfall.operators.calendar_join import weeks_by_day, weeks_overlapping
from footfall.operators.shape import as_one_row


def qualifying(
    offers: DataFrame, funding: str, described_as: str, not_described_as: Sequence[str] = ()
) -> DataFrame:
    """Offers flagged ``npp`` = Y whose funding and description contain the given texts.

    Matching the description ignores case. NULL text never matches, nor does a description that
    merely contains an excluded text.
    """
    description = F.upper("offer_description")
    excluded: list[Column] = [~description.like(f"%{text}%") for text in not_described_as]
    return offers.filter(
        reduce(
            lambda a, b: a & b,
            excluded,
            (F.col("npp") == "Y")
            & F.col("funding").like(f"%{funding}%")
            & description.like(f"%{described_as}%"),
        )
    )


def promo_history(
    offers: DataFrame, calendar: DataFrame, first_year: int, last_year: int, by_day: bool = False
) -> DataFrame:
    """One row per week of the deal years with ``npp_flag``: 1 if an offer overlaps it, else 0.

    ``offers`` are already :func:`qualifying`. Year and number come from the calendar.
    """
    weeks = calendar.filter(F.col("deal_yr").between(first_year, last_year))
    # A deal year may start or end up to a year away from the calendar year of its number.
    first, last = dt.date(first_year - 1, 1, 1), dt.date(last_year + 1, 12, 31)
    find = weeks_by_day if by_day else weeks_overlapping
    flagged = find(offers, weeks, first, last).withColumn("npp_flag", F.lit(1))
    return (
        weeks.select("week_identifier", "deal_yr", "deal_wk")
        .distinct()
        .join(flagged, "week_identifier", "left")
        .withColumn("npp_flag", F.coalesce("npp_flag", F.lit(0)))
    )


def without_oldest_weeks(promo: DataFrame, up_to: str, weeks: int = 2) -> DataFrame:
    """Rows up to a week, less the ``weeks`` smallest distinct week ids.

    The ranked ids are distinct weeks of the calendar, a few thousand at most.
    """
    kept = promo.filter(F.col("week_identifier") <= up_to)
    place = F.row_number().over(Window.orderBy("week_identifier"))
    oldest = (
        kept.select("week_identifier").distinct().withColumn("place", place).filter(F.col("place") <= weeks)
    )
    return kept.join(F.broadcast(oldest.select("week_identifier")), "week_identifier", "left_anti")


def promo_matrix(promo: DataFrame, calendar: DataFrame, week: Week, weeks: int) -> DataFrame:
    """One row with ``{n}_weeks_back_NPP_npp_flag`` for n = 1..weeks; weeks without data are 0."""
    back = weeks_between(day(week.start), F.col("start_date"))
    starts = calendar.filter(
        F.col("start_date").between(day(week.weeks_before(weeks)), day(week.start))
    ).select("week_identifier", "start_date")
    rows = (
        promo.filter(F.col("week_identifier") <= week.identifier)
        .join(F.broadcast(starts), "week_identifier")
        .withColumn("weeks_back", back)
    )
    return as_one_row(rows, "weeks_back", "npp_flag", range(1, weeks + 1), "{}_weeks_back_NPP_npp_flag")
