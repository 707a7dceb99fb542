"""Column naming."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def snake_case(name: str) -> str:
    return name.strip().lower().replace(" ", "_")


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake_case(name) for name in df.columns])


def affix(df: DataFrame, prefix: str = "", suffix: str = "", keep: Iterable[str] = ()) -> DataFrame:
    keep = set(keep)
    return df.withColumnsRenamed({c: f"{prefix}{c}{suffix}" for c in df.columns if c not in keep})
