"""High/low shop and lift labels from scores and view statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.functions.rates import at_least_one
from footfall.operators.shape import latest

LIFT_THRESHOLD = 1.07
WEEKS_PER_YEAR = 52


def newest_threshold(performance: DataFrame, banner: str) -> DataFrame:
    """One row: the threshold of the banner's most recent training run that has one."""
    known = performance.filter((F.col("banner") == banner) & F.col("optimal_threshold").isNotNull())
    return latest(known, ["optimal_threshold"], ["train_timestamp", "optimal_threshold"])


def likelihood_labels(
    predictions: DataFrame,
    statistics: DataFrame,
    threshold: DataFrame,
    lift_threshold: float = LIFT_THRESHOLD,
) -> DataFrame:
    """Shop label from the score, lift label from how much a view raises the chance to shop.

    ``threshold`` is a one-row, one-column frame; none raises. Without views, or without statistics, the lift is
    NULL and its label L.
    """
    score = F.col("predicted_purchase_prob")
    limit = F.coalesce(threshold.scalar(), F.raise_error(F.lit("no threshold is known")).cast("double"))
    shop_and_view = F.when(F.col("weeks_views") == 0, F.lit(0.0)).otherwise(
        at_least_one(F.col("shop_view_weeks") / WEEKS_PER_YEAR)
    )
    return (
        predictions.select("epsilon_id", "predicted_purchase_prob")
        .join(statistics, "epsilon_id", "left")
        .withColumns(
            {
                "shop_prob_label": F.when(score >= limit, "H").otherwise("L"),
                "prob_shop_n_view_exp_01w": shop_and_view,
                "prob_view_exp_01w": at_least_one(F.col("lambda_views")),
            }
        )
        .withColumn(
            "aided_prob",
            F.try_divide(F.col("prob_shop_n_view_exp_01w"), F.col("prob_view_exp_01w")),
        )
        .withColumn("lift_ratio", F.try_divide(F.col("aided_prob"), score))
        .withColumn("lift_label", F.when(F.col("lift_ratio") >= lift_threshold, "H").otherwise("L"))
        .select(
            "customer_id",
            "epsilon_id",
            "predicted_purchase_prob",
            "prob_shop_n_view_exp_01w",
            "prob_view_exp_01w",
            "aided_prob",
            "shop_prob_label",
            "lift_ratio",
            "lift_label",
        )
    )
