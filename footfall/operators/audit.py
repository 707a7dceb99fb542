"""Table checks, each a single aggregation over all columns at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _per_column(df: DataFrame, measures: dict[str, Column], name: str) -> DataFrame:
    """Aggregate one measure per column and list the results as (column_name, measure) rows."""
    return df.agg(*[m.alias(c) for c, m in measures.items()]).unpivot([], list(measures), "column_name", name)


def null_audit(df: DataFrame) -> DataFrame:
    """Columns holding NULLs and how many."""
    counts = {c: F.count_if(F.col(c).isNull()) for c in df.columns}
    return _per_column(df, counts, "null_count").filter("null_count > 0")


def named_binary(columns: Sequence[str], markers: Sequence[str] = ("weeks_back", "deal_season")) -> list[str]:
    """Columns that are 0/1 by construction, told by their names."""
    return [c for c in columns if any(m in c for m in markers)]


def binary_by_value(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, is_binary): 1 where every non-null value is 0 or 1."""
    outside = {c: F.count_if(~F.col(c).isin(0, 1)) for c in columns}
    return _per_column(df, outside, "outside").select(
        "column_name", (F.col("outside") == 0).cast("int").alias("is_binary")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Class sizes and the weight that evens out the positive class."""
    positives = F.count_if(F.col(label) == 1)
    negatives = F.count_if(F.col(label) == 0)
    return df.agg(
        F.count("*").alias("rows"),
        positives.alias("positives"),
        negatives.alias("negatives"),
        (negatives / F.greatest(positives, F.lit(1))).alias("scale_pos_weight"),
    )


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    return df
