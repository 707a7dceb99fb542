"""The ad-hoc offer table, stacked from one table per year."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from footfall.functions.names import normalise_headers

OFFER_SCHEMA = T.StructType(
    [
        T.StructField("offer_description", T.StringType()),
        T.StructField("start_date", T.DateType()),
        T.StructField("end_date", T.DateType()),
        T.StructField("bonus_code", T.StringType()),
        T.StructField("npp", T.StringType()),
        T.StructField("funding", T.StringType()),
        T.StructField("notes", T.StringType()),
    ]
)


def year_offers(raw: DataFrame) -> DataFrame:
    """One year's rows in the fixed schema; rows without an ``npp`` entry are no offers."""
    tidy = normalise_headers(raw)
    return tidy.filter(F.col("npp").isNotNull()).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in OFFER_SCHEMA.fields]
    )


def adhoc_offers(years: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [year_offers(raw) for raw in years])
