"""Quantiles that add up: a sketch per key and week, merged over the weeks of a look-back.

A new week is sketched alone and merged with the stored ones, instead of gathering years of values again. Sketches are
Spark's KLL sketches over whole numbers: up to ``SIZE`` values a key they are exact, beyond that a rank is off by
about ``rank_error`` of the values with 99 % confidence, however the weeks are merged.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

SIZE = 200
QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def rank_error(size: int = SIZE) -> float:
    """Normalised rank error of one quantile of a KLL sketch of this size, at 99 % confidence."""
    return 2.296 / size**0.9723


def week_sketches(
    values: DataFrame, keys: Sequence[str], week: str, value: str, size: int = SIZE
) -> DataFrame:
    """One sketch and the number of values per key and week; nulls are left out, keys without values too."""
    known = values.filter(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_bigint(F.col(value).cast("long"), size)
    return known.groupBy(*keys, week).agg(sketch.alias("sketch"), F.count("*").alias("n_values"))


def merged_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """The sketch of all rows of a key."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_bigint("sketch", size).alias("sketch"), F.sum("n_values").alias("n_values")
    )


def quantile_columns(shares: Mapping[str, float] = QUARTILES) -> dict[str, Column]:
    """The value at position ``ceil(share * n)`` of a sketch, per name."""
    return {name: F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)) for name, share in shares.items()}
