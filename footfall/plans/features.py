"""The table a model is fitted on or scores, one row per customer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from footfall.operators.impute import default_label, median_fill, zero_fill
from footfall.operators.shape import attach_one_row, keep_one
from footfall.plans.profiles import GAP_COLUMNS

NOT_FEATURES = (
    "epsilon_id",
    "epcl_profileid",
    "lightfm_id",
    "user_id",
    "purchase_flag",
    "enroll_date",
    "register_date",
    "first_purchase_date",
    "last_purchase_date",
)


def feature_columns(df: DataFrame, excluded: tuple[str, ...] = NOT_FEATURES) -> list[str]:
    """All columns but ids, dates and the label."""
    return [c for c in df.columns if c not in excluded]


def left_chain(first: DataFrame, others: list[DataFrame], key: str) -> DataFrame:
    return reduce(lambda left, right: left.join(right, key, "left"), others, first)


def filled_purchase_profile(purchases: DataFrame, banner: str) -> DataFrame:
    """One banner's purchase profile with its gap columns median-filled; pass a stored profile."""
    of_banner = purchases.filter(F.col("banner") == banner).drop("epcl_profileid", "banner")
    return median_fill(of_banner, GAP_COLUMNS)


def customer_summary(
    points: DataFrame, filled_purchases: DataFrame, week_and_season_matrix: DataFrame, banner: str
) -> DataFrame:
    """Point profile of a banner with purchases, weeks and seasons attached; gaps are 0."""
    of_banner = points.filter(F.col("banner") == banner).drop("banner")
    return zero_fill(left_chain(of_banner, [filled_purchases, week_and_season_matrix], "epsilon_id"))


def feature_matrix(
    embeddings: DataFrame,
    summary: DataFrame,
    promo_row: DataFrame,
    labels: DataFrame | None = None,
    keep_unprofiled: bool = False,
    statistics: DataFrame | None = None,
) -> DataFrame:
    """Embeddings joined to customer summaries and the promo row; with ``labels``, also the Y/N flag.

    A customer found in several embedding segments keeps the smallest ``lightfm_id``.
    ``keep_unprofiled`` keeps customers that have an embedding only; ``statistics`` adds the view and
    shop statistics.
    """
    one_each = keep_one(embeddings, ["epsilon_id"], ["lightfm_id"])
    joined = one_each.join(summary, "epsilon_id", "left" if keep_unprofiled else "inner")
    if statistics is not None:
        joined = joined.join(
            statistics.select("epsilon_id", "weeks_views", "shop_view_weeks", "lambda_views"),
            "epsilon_id",
            "left",
        )
    matrix = attach_one_row(joined, promo_row)
    if labels is None:
        return matrix
    flags = labels.select("epsilon_id", "purchase_flag").distinct()
    return default_label(matrix.join(flags, "epsilon_id", "left"), "purchase_flag")


def with_target(df: DataFrame, flag: str = "purchase_flag", target: str = "label") -> DataFrame:
    return df.withColumn(target, (F.col(flag) == "Y").cast("int"))


def as_float(df: DataFrame, columns: list[str]) -> DataFrame:
    """Halve the width of the feature columns."""
    return df.withColumns({c: F.col(c).cast("float") for c in columns})
