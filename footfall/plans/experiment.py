"""Test/control assignment and the overlay of new labels on the previous model's."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.operators.sampling import group_flag
from footfall.operators.shape import override


def assigned(labels: DataFrame, previous: DataFrame, test_share: float = 0.1, seed: int = 42) -> DataFrame:
    """New labels of customers the previous model knows, with their T/C group.

    The group is a function of the customer id, so all rows of a customer share it.
    """
    known = labels.join(previous.select("customer_id"), "customer_id", "left_semi")
    return group_flag(known, "customer_id", test_share, seed)


def test_control(assigned: DataFrame, banner: str) -> DataFrame:
    return assigned.select("customer_id", "epsilon_id", F.lit(banner).alias("banner"), "group_flag")


def final_labels(previous: DataFrame, assigned: DataFrame, banner: str) -> DataFrame:
    """Previous labels, replaced by the new ones for group T of the banner."""
    new = assigned.filter("group_flag = 'T'").select(
        "customer_id",
        F.lit(banner).alias("banner"),
        F.col("shop_prob_label").alias("_new_shop"),
        F.col("lift_label").alias("_new_lift"),
    )
    return (
        previous.join(new.distinct(), ["customer_id", "banner"], "left")
        .withColumns(
            {
                "shop_prob_label": override(F.col("_new_shop"), F.col("shop_prob_label")),
                "lift_label": override(F.col("_new_lift"), F.col("lift_label")),
            }
        )
        .drop("_new_shop", "_new_lift")
        .withColumnRenamed("customer_id", "customerid")
        .distinct()
    )
