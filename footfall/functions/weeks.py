"""Week identifiers: four-digit year, ``_3``, two-digit deal week."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def week_id(year: Column | str, week: Column | str) -> Column:
    year = F.col(year) if isinstance(year, str) else year
    week = F.col(week) if isinstance(week, str) else week
    return F.concat(year.cast("string"), F.lit("_3"), F.lpad(week.cast("string"), 2, "0"))


def week_year(identifier: Column | str) -> Column:
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.substring(identifier, 1, 4).cast("int")


def week_number(identifier: Column | str) -> Column:
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.substring(identifier, 7, 2).cast("int")


def previous_year_week(identifier: Column | str) -> Column:
    identifier = F.col(identifier) if isinstance(identifier, str) else identifier
    return F.concat((week_year(identifier) - 1).cast("string"), F.substring(identifier, 5, 4))


def weeks_between(later: Column, earlier: Column) -> Column:
    """Whole weeks from ``earlier`` to ``later``, cut towards zero."""
    return (F.datediff(later, earlier) / 7).cast("int")
