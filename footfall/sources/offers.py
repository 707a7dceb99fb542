"""Ad-hoc offers from one delimited file per year."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from footfall.plans.offers import adhoc_offers


def read_offer_years(spark: SparkSession, folder: str, years: Iterable[int]) -> DataFrame:
    """Stack ``{folder}/{year}.csv``; headers are normalised, extra columns and non-offers dropped."""
    reader = spark.read.option("header", True).option("escape", '"')
    return adhoc_offers([reader.csv(f"{folder.rstrip('/')}/{year}.csv") for year in years])
