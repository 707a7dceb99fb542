"""Customer embeddings as plain columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def widen(vectors: DataFrame, width: int, vector: str = "embedding", key: str = "lightfm_id") -> DataFrame:
    """Spread a vector column over ``latent_0 .. latent_{width-1}``; a vector of another length raises."""
    size = F.size(vector)
    wrong = F.raise_error(F.concat(F.lit(f"vector of {width} numbers expected, found "), size.cast("string")))
    checked = F.when(F.col(vector).isNotNull() & (size != width), wrong).otherwise(F.col(vector))
    own = vectors.select(key, checked.alias(vector))
    return own.selectExpr(f"`{key}`", *[f"get(`{vector}`, {i}) AS latent_{i}" for i in range(width)])


def embedding_table(segments: Iterable[tuple[DataFrame, DataFrame]], width: int) -> DataFrame:
    """Stack the segments' (vectors, id map) pairs; vectors without a mapped customer fall out."""
    parts = [
        widen(vectors, width).join(ids.select("lightfm_id", "user_id", "epsilon_id"), "lightfm_id")
        for vectors, ids in segments
    ]
    return reduce(DataFrame.unionByName, parts)
