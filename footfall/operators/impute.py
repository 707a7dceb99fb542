"""Filling missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from footfall.operators.ordering import exact_medians


def zero_fill(df: DataFrame) -> DataFrame:
    return df.na.fill(0)


def median_fill(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the column's exact median over ``df``."""
    columns = list(columns)
    medians = exact_medians(df, columns).select(F.struct("*")).scalar()
    filled = {c: F.coalesce(F.col(c).cast("double"), F.col("_median").getField(c)) for c in columns}
    return df.withColumn("_median", medians).withColumns(filled).drop("_median")


def default_label(df: DataFrame, column: str, value: str = "N") -> DataFrame:
    return df.na.fill(value, [column])
