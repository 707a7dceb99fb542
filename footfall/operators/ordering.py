"""Exact ranks, running totals and medians without sorting everything in one task.

All of them cut the order into pieces, sum each piece, carry the sums of the earlier pieces forward
(a window over one row per piece), and order rows only inside their piece. The piece of a row must
not change between two evaluations of the plan, so pieces come from literal cut points or from
digits of a hash, never from partition numbers.

Groups are matched as structs, which equal each other where their NULLs do, so rows of a NULL group
stay.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.functions.ids import id_digest

PIECES_PER_PARTITION = 4


def cut_points(df: DataFrame, columns: Sequence[str], pieces: int | None = None) -> dict[str, list[float]]:
    """At most ``pieces - 1`` approximate quantiles per column, from one pass without a shuffle.

    Results never depend on where the cuts fall; only the balance of the pieces does. Without ``pieces`` there are a
    few for each shuffle partition.
    """
    if pieces is None:
        pieces = PIECES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if pieces < 2:
        return {c: [] for c in columns}
    probabilities = [i / pieces for i in range(1, pieces)]
    found = df.approxQuantile(list(columns), probabilities, 0.5 / pieces)
    return {c: sorted(set(cuts)) for c, cuts in zip(columns, found)}


def with_piece(df: DataFrame, value: str, cuts: Sequence[float], into: str = "_piece") -> DataFrame:
    """Add the number of cut points at or below a value, found by binary search."""
    if not cuts:
        return df.withColumn(into, F.lit(0.0))
    splits = [-math.inf, *cuts, math.inf]
    return Bucketizer(splits=splits, inputCol=value, outputCol=into, handleInvalid="keep").transform(df)


def _group(by: Sequence[str]) -> Column:
    return F.struct(*by) if by else F.lit(0)


def _carried(totals: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group and piece. Without groups the number of pieces bounds it: broadcast."""
    return totals if by else F.broadcast(totals)


def running_totals(
    df: DataFrame,
    value: str,
    sums: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add ``{s}_through`` (running, inclusive) and ``{s}_all`` (whole group) for each sum column.

    ``df`` has one row per ``by`` and ``value``, and a ``_piece`` that rises with ``value``.
    """

    def ordered(name: str) -> Column:
        return F.col(name).desc() if descending else F.col(name).asc()

    rows = df.withColumn("_group", _group(by))
    group = Window.partitionBy("_group")
    earlier = group.orderBy(ordered("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy("_group", "_piece")
        .agg(*[F.sum(s).alias(s) for s in sums])
        .select(
            "_group",
            "_piece",
            *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"_{s}_before") for s in sums],
            *[F.sum(s).over(group).alias(f"{s}_all") for s in sums],
        )
    )
    inside = (
        Window.partitionBy("_group", "_piece")
        .orderBy(ordered(value))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.join(_carried(carried, by), ["_group", "_piece"]).select(
        *[c for c in df.columns if c != "_piece"],
        *[(F.col(f"_{s}_before") + F.sum(s).over(inside)).alias(f"{s}_through") for s in sums],
        *[F.col(f"{s}_all") for s in sums],
    )


def hash_rank(
    df: DataFrame, key: str, by: Sequence[str] = (), seed: int | str = "", digits: int = 3
) -> DataFrame:
    """Add ``rank`` (1..n per group, in the order of a seeded hash of ``key``) and ``group_rows``.

    ``key`` identifies a row inside its group and is not NULL. The first hash digits are the pieces:
    uniform, and the same however often or on however many partitions the plan runs.
    """
    rows = (
        df.withColumn("_group", _group(by))
        .withColumn("_digest", id_digest(key, seed))
        .withColumn("_piece", F.substring("_digest", 1, digits))
    )
    group = Window.partitionBy("_group")
    earlier = group.orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        rows.groupBy("_group", "_piece")
        .agg(F.count("*").alias("_n"))
        .select(
            "_group",
            "_piece",
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(group).alias("group_rows"),
        )
    )
    inside = Window.partitionBy("_group", "_piece").orderBy("_digest", key)
    return rows.join(_carried(carried, by), ["_group", "_piece"]).select(
        *df.columns, (F.col("_before") + F.row_number().over(inside)).alias("rank"), "group_rows"
    )


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the exact median of each column, NULLs left out; even counts average the two.

    Runs one pass at call time to place the cut points, so hand it a stored table.
    """
    columns = list(columns)
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    pieces = numbers
    for c, cuts in cut_points(numbers, columns).items():
        pieces = with_piece(pieces, c, cuts, f"_piece_{c}")
    entries = [
        F.struct(F.lit(c).alias("name"), F.col(c).alias("value"), F.col(f"_piece_{c}").alias("_piece"))
        for c in columns
    ]
    values = (
        pieces.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("name", "value", "_piece")
        .agg(F.count("*").alias("n"))
    )
    ranked = running_totals(values, "value", ["n"], by=["name"])
    lower = F.ceil(F.col("n_all") / 2)
    upper = F.floor(F.col("n_all") / 2) + 1
    medians = ranked.groupBy("name").agg(
        F.min(F.when(F.col("n_through") >= lower, F.col("value"))).alias("lower"),
        F.min(F.when(F.col("n_through") >= upper, F.col("value"))).alias("upper"),
    )
    middle = (F.col("lower") + F.col("upper")) / 2
    return medians.agg(*[F.max(F.when(F.col("name") == c, middle)).alias(c) for c in columns])
