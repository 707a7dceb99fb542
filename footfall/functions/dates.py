"""Date ids are ``yyyyMMdd`` text; everything else is a date or epoch seconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

DATE_ID = "yyyyMMdd"


def date_id(column: Column | str) -> Column:
    return F.date_format(column, DATE_ID)


def date_from_id(column: Column | str) -> Column:
    """NULL for text that is no date, also under ANSI mode."""
    return F.try_to_timestamp(column, F.lit(DATE_ID)).cast("date")


def epoch_seconds(day: Column | str) -> Column:
    """Seconds from 1970-01-01 to the start of a date, free of the session time zone."""
    return F.unix_date(day).cast("bigint") * 86400


def day(value: dt.date | str) -> Column:
    return F.lit(str(value)).cast("date")


def text_id(value: dt.date) -> str:
    return value.strftime("%Y%m%d")
