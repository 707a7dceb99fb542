"""Splits and samples that are functions of the row's key and a seed, not of its partition.

Each purpose hashes under its own prefix, so a sample drawn from one split, or folds made inside it,
are independent of how the split was made.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from footfall.functions.ids import id_digest, unit_fraction
from footfall.operators.ordering import hash_rank


def stratified_split(
    df: DataFrame,
    key: str,
    stratum: str,
    train: float = 0.6,
    validation: float = 0.2,
    seed: int | str = 42,
) -> DataFrame:
    """Add ``split`` (train / validation / test) with exact shares inside each stratum."""
    place = (F.col("rank") - 1) / F.col("group_rows")
    split = (
        F.when(place < train, "train").when(place < train + validation, "validation").otherwise("test")
    )
    ranked = hash_rank(df, key, [stratum], f"split:{seed}")
    return ranked.withColumn("split", split).drop("rank", "group_rows")


def stratified_sample(
    df: DataFrame, key: str, stratum: str, fraction: float, seed: int | str = 42
) -> DataFrame:
    """Exactly ``ceil(fraction * n)`` rows of each stratum."""
    kept = F.col("rank") <= F.ceil(F.col("group_rows") * F.lit(fraction))
    ranked = hash_rank(df, key, [stratum], f"sample:{seed}")
    return ranked.filter(kept).drop("rank", "group_rows")


def sample_up_to(df: DataFrame, key: str, rows: int, seed: int | str = 42) -> DataFrame:
    """``rows`` pseudo-random rows, or all of a smaller table."""
    ranked = hash_rank(df, key, seed=f"draw:{seed}")
    return ranked.filter(F.col("rank") <= rows).drop("rank", "group_rows")


def capped_fraction(rows: int, cap: int) -> float:
    """Share that brings ``rows`` down to ``cap``; 1 for a table that is small enough."""
    return cap / rows if rows > cap else 1.0


def group_flag(df: DataFrame, key: str, test_share: float = 0.1, seed: int | str = 42) -> DataFrame:
    """Add ``group_flag``: T for a reproducible ``test_share`` of keys, C for the others."""
    in_test = unit_fraction(id_digest(key, f"group:{seed}")) <= test_share
    return df.withColumn("group_flag", F.when(in_test, "T").otherwise("C"))


def fold_number(df: DataFrame, key: str, folds: int = 3, seed: int | str = 42) -> DataFrame:
    """Add ``fold`` (0..folds-1) for cross-validation."""
    fraction = unit_fraction(id_digest(key, f"fold:{seed}"))
    return df.withColumn("fold", F.floor(fraction * folds).cast("int"))


def balanced_by_copies(
    df: DataFrame, label: str, key: str, scale_pos_weight: float, seed: int | str = 42
) -> DataFrame:
    """Repeat positive rows ``scale_pos_weight`` times on average, for learners without weights.

    The fractional part of the weight is met by giving that share of positives one more copy.
    """
    whole = math.floor(scale_pos_weight)
    extra = unit_fraction(id_digest(key, f"copies:{seed}")) < (scale_pos_weight - whole)
    copies = F.when(F.col(label) == 1, F.greatest(F.lit(whole) + extra.cast("int"), F.lit(1))).otherwise(1)
    return df.select("*", F.explode(F.array_repeat(F.lit(1), copies)).alias("_copy")).drop("_copy")
