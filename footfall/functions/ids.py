"""Customer-id hashing and hash-based pseudo-random numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hashed_id(column: Column | str) -> Column:
    """Lower-case md5 hex of the upper-cased, trimmed text form of an id."""
    column = F.col(column) if isinstance(column, str) else column
    return F.md5(F.upper(F.trim(column.cast("string"))))


def id_digest(column: Column | str, seed: int | str = "") -> Column:
    """Seeded md5 of an id: a reproducible random sort key that ignores partitioning."""
    column = F.col(column) if isinstance(column, str) else column
    return F.md5(F.concat(F.lit(f"{seed}:"), column.cast("string")))


def unit_fraction(digest: Column) -> Column:
    """Map the first 32 bits of an md5 digest to [0, 1)."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
