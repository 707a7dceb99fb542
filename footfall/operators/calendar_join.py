"""Attaching weeks to dated rows and to date intervals.

A comparison join (``day BETWEEN start AND end``) has no equality for Spark to hash on and turns
into a nested loop over rows x weeks. Both forms here are equi-joins instead: one on the day, one
on a fixed-width bin with the comparison left as a residual filter.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.dates import day


def _within(calendar: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    return calendar.filter((F.col("end_date") >= day(first)) & (F.col("start_date") <= day(last)))


def days_of(calendar: DataFrame, first: dt.date, last: dt.date, at: str = "calendar_day") -> DataFrame:
    """One row per calendar day in ``[first, last]`` with the columns of its week."""
    start = F.greatest(F.col("start_date"), day(first))
    end = F.least(F.col("end_date"), day(last))
    return _within(calendar, first, last).withColumn(at, F.explode(F.sequence(start, end)))


def join_weeks(df: DataFrame, at: str, calendar: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Inner join on the day: rows dated inside ``[first, last]`` gain their week's columns.

    Deal weeks do not overlap, so the day-grain side has at most ``last - first + 1`` short rows and is broadcast.
    """
    return df.join(F.broadcast(days_of(calendar, first, last, at)), at)


def join_ranges(
    df: DataFrame,
    at: str,
    calendar: DataFrame,
    first: dt.date,
    last: dt.date,
    bin_days: int = 7,
) -> DataFrame:
    """Same result as :func:`join_weeks` for weeks of any length, by day bins.

    Each week is listed once per bin it touches (two for a week and seven-day bins), each row has
    one bin, and the exact bounds are checked after the hash match. The date window bounds the weeks: broadcast.
    """

    def bin_of(column: Column) -> Column:
        return F.floor(F.unix_date(column) / bin_days)

    weeks = _within(calendar, first, last).withColumn(
        "_bin", F.explode(F.sequence(bin_of(F.col("start_date")), bin_of(F.col("end_date"))))
    )
    rows = df.filter(F.col(at).between(day(first), day(last))).withColumn("_bin", bin_of(F.col(at)))
    return (
        rows.join(F.broadcast(weeks), "_bin")
        .filter(F.col(at).between(F.col("start_date"), F.col("end_date")))
        .drop("_bin")
    )


def _clipped(intervals: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Well-formed intervals cut to ``[first, last]``; reversed or open ones touch no day."""
    return intervals.filter(
        (F.col("start_date") <= F.col("end_date"))
        & (F.col("start_date") <= day(last))
        & (F.col("end_date") >= day(first))
    ).select(
        F.greatest("start_date", day(first)).alias("start_date"),
        F.least("end_date", day(last)).alias("end_date"),
    )


def weeks_overlapping(intervals: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Week ids that at least one interval overlaps, without expanding the intervals.

    Each interval adds one at its first day and takes it back after its last; the running sum over
    days is the number of open intervals. After the sums per day there are at most as many rows as
    days in the window, which is why the ordered window may run in one partition. Days without a
    week still count, since an interval may open on one.
    """
    steps = (
        _clipped(intervals, first, last)
        .select(
            F.inline(
                F.array(
                    F.struct(F.col("start_date").alias("calendar_day"), F.lit(1).alias("step")),
                    F.struct(F.date_add("end_date", 1).alias("calendar_day"), F.lit(-1).alias("step")),
                )
            )
        )
        .groupBy("calendar_day")
        .agg(F.sum("step").alias("step"))
    )
    open_count = F.sum(F.coalesce("step", F.lit(0))).over(
        Window.orderBy("calendar_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        days_of(calendar, first, last)
        .join(steps, "calendar_day", "full")
        .select("week_identifier", open_count.alias("open_count"))
        .filter("open_count > 0 AND week_identifier IS NOT NULL")
        .select("week_identifier")
        .distinct()
    )


def weeks_by_day(intervals: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Same week ids, by listing every day of every interval and matching days."""
    covered = (
        _clipped(intervals, first, last)
        .select(F.explode(F.sequence("start_date", "end_date")).alias("calendar_day"))
        .distinct()
    )
    return join_weeks(covered, "calendar_day", calendar, first, last).select("week_identifier").distinct()


def every_week(df: DataFrame, calendar: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Repeat each row once per week that starts or ends inside ``[first, last]``.

    The weeks arrive as one array, whose length the date window bounds, and are unrolled per row;
    rows keep their partitions.
    """
    weeks = _within(calendar, first, last).agg(
        F.sort_array(
            F.collect_list(F.struct("start_date", "end_date", "deal_yr", "deal_wk", "week_identifier"))
        ).alias("weeks")
    )
    return df.select("*", F.explode(weeks.scalar()).alias("_week")).select(*df.columns, "_week.*")
