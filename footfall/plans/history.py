"""Which weeks and seasons a customer bought in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from footfall.context import Week
from footfall.functions.dates import day
from footfall.functions.weeks import weeks_between
from footfall.operators.calendar_join import join_ranges, join_weeks
from footfall.operators.shape import flag_matrix
from footfall.plans.calendar import SEASONS
from footfall.plans.profiles import BY_CUSTOMER, smallest_profile_id

WEEKS = 104


def purchase_history(
    daily: DataFrame,
    calendar: DataFrame,
    week: Week,
    weeks: int = WEEKS,
    keys: Sequence[str] = BY_CUSTOMER,
    by_range: bool = False,
) -> DataFrame:
    """One row per key and week with a purchase, from ``weeks`` weeks back to ``week``.

    ``by_range`` matches days to weeks by bins instead of a day list; the rows are the same.
    """
    first, last = week.weeks_before(weeks), week.end
    recent = daily.filter(F.col("tx_date").between(day(first), day(last)))
    join = join_ranges if by_range else join_weeks
    weeks_only = calendar.select("week_identifier", "start_date", "end_date")
    return (
        join(recent, "tx_date", weeks_only, first, last)
        .groupBy(*keys, "week_identifier")
        .agg(F.lit(1).alias("made_purchase"), *smallest_profile_id(recent, keys))
    )


def week_and_season_matrix(
    history: DataFrame, calendar: DataFrame, week: Week, weeks: int = WEEKS, seasons: Sequence[int] = SEASONS
) -> DataFrame:
    """0/1 columns ``{n}_weeks_back_purchase`` (n = 1..weeks) and ``deal_season_num_{n}`` per customer.

    The columns come from the look-back, not from the data, so every run has the same ones. Both
    kinds cover the weeks before ``week``; the running week (n = 0) is left out. The date window
    bounds the calendar rows that are broadcast.
    """
    first, last = week.weeks_before(weeks), week.days_before(1)
    looked_up = calendar.filter(F.col("start_date").between(day(first), day(last))).select(
        "week_identifier",
        weeks_between(day(week.start), F.col("start_date")).alias("weeks_back"),
        "deal_season_num",
    )
    return flag_matrix(
        history.join(F.broadcast(looked_up), "week_identifier"),
        "epsilon_id",
        [
            ("weeks_back", range(1, weeks + 1), "{}_weeks_back_purchase"),
            ("deal_season_num", seasons, "deal_season_num_{}"),
        ],
    )


def purchase_matrix(history: DataFrame, calendar: DataFrame, week: Week, weeks: int = WEEKS) -> DataFrame:
    """The week columns alone."""
    both = week_and_season_matrix(history, calendar, week, weeks)
    return both.select("epsilon_id", *[c for c in both.columns if c.endswith("_weeks_back_purchase")])


def season_matrix(
    history: DataFrame, calendar: DataFrame, week: Week, weeks: int = WEEKS, seasons: Sequence[int] = SEASONS
) -> DataFrame:
    """The season columns alone."""
    both = week_and_season_matrix(history, calendar, week, weeks, seasons)
    return both.select("epsilon_id", *[c for c in both.columns if c.startswith("deal_season_num_")])
