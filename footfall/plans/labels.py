"""Who bought in the target week."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from footfall.context import Week
from footfall.plans.transactions import buying_cards


def purchase_labels(detail: DataFrame, accounts: DataFrame, banner: str, week: Week) -> DataFrame:
    """Customers with a purchase in ``week``, flagged Y, one row each per banner."""
    return (
        buying_cards(detail, banner, week.start, week.end)
        .join(accounts, "cardnumber")
        .groupBy("epsilon_id", "banner")
        .agg(F.min("epcl_profileid").alias("epcl_profileid"))
        .withColumn("purchase_flag", F.lit("Y"))
    )
