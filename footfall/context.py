"""The week a job runs for. Nothing in the library reads the clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class Week:
    """Bounds of one deal week.

    Profiles use days before ``start`` (half open), so no day of the week itself reaches them.
    """

    identifier: str
    start: dt.date
    end: dt.date

    def days_before(self, days: int) -> dt.date:
        return self.start - dt.timedelta(days=days)

    def weeks_before(self, weeks: int) -> dt.date:
        return self.start - dt.timedelta(weeks=weeks)


def resolve_week(calendar: DataFrame, identifier: str) -> Week:
    """Read the bounds of one week from the calendar: a single row reaches the driver."""
    rows = (
        calendar.filter(F.col("week_identifier") == identifier)
        .select("start_date", "end_date")
        .distinct()
        .take(2)
    )
    if len(rows) != 1:
        raise ValueError(f"week {identifier!r} has {len(rows)} calendar rows, expected one")
    return Week(identifier, rows[0].start_date, rows[0].end_date)
