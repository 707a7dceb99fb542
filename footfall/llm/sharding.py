"""K-d tree partitioning into shards of near-equal bytes, in DataFrame functions only.

Each inner node is cut at the weighted median of its widest metadata dimension. Dimensions live on a grid of
65,536 levels, so a median is found from totals per (node, level); documents of the median's level are told
apart by a hash of the whole row and, among equal rows, of the copy's number, first by totals per hash prefix, then by
ordering the few that share the prefix. Nothing about single documents leaves the executors: the tables joined to the rows have one row per
node, so their size is bounded by the number of shards, a parameter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from footfall.llm.common import numbered_copies
from footfall.session import cut_lineage

#: Production parameters.
SHARDS = 8
METADATA = ("n_chars", "doc_id", "source", "lang")

_LEVELS = 65_536
_PER_PIECE = 20_000  # documents numbered together in one window group, about


def text_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def _on_grid(docs: DataFrame, columns: list[str]) -> list[Column]:
    """Columns as levels 0 to 65,535: numbers in proportion to their range, other values by hash, null as 0."""
    numbers = [c for c in columns if isinstance(docs.schema[c].dataType, T.NumericType)]
    edges = [f(F.col(c).cast("double")).alias(f"{n}{i}") for i, c in enumerate(numbers) for n, f in (("lo", F.min), ("hi", F.max))]
    found = docs.agg(*edges).first() if edges else {}
    levels = []
    for name in columns:
        if name in numbers:
            i = numbers.index(name)
            low, high = found[f"lo{i}"], found[f"hi{i}"]
            if low is None or not high > low:
                levels.append(F.lit(0))
                continue
            share = (F.col(name).cast("double") - F.lit(low)) / F.lit(high - low)
            level = F.floor(share * (_LEVELS - 1))
        else:
            level = F.shiftrightunsigned(F.xxhash64(F.col(name).cast("string")), 48)
        levels.append(F.when(F.col(name).isNull(), F.lit(0)).otherwise(level).cast("int"))
    return levels


def _cuts(rows: DataFrame, leaves: DataFrame, n_dims: int) -> DataFrame:
    """Per node with two leaves or more: dimension, level, hash prefix and hash of the first row to the right.

    ``leaves`` (``node, first, count``) is one row per node.
    """
    open_nodes = leaves.filter("count > 1")
    inside = rows.join(F.broadcast(open_nodes), "node")
    spreads = [
        F.struct((F.max(F.col("dims")[d]) - F.min(F.col("dims")[d])).alias("spread"), F.lit(-d).alias("d"))
        for d in range(n_dims)
    ]
    widest = F.greatest(*spreads)["d"] if len(spreads) > 1 else F.lit(0)
    nodes = inside.groupBy("node", "first", "count").agg((-widest).alias("dim"), F.sum("size").alias("total"))
    wanted = cut_lineage(
        nodes.select("node", "dim", (F.col("total") * F.floor(F.col("count") / 2) / F.col("count")).alias("goal"))
    )
    at = rows.join(F.broadcast(wanted), "node").withColumn("level", F.get(F.col("dims"), F.col("dim")))
    found = wanted.withColumn("before", F.lit(0).cast("long"))
    for name, value in (("level", F.col("level")), ("prefix", F.shiftrightunsigned(F.col("hash"), 48))):
        keys = ["node"] + (["level"] if name == "prefix" else [])
        here = at.join(F.broadcast(found.drop("dim", "goal")), keys) if name == "prefix" else at.withColumn(
            "before", F.lit(0).cast("long")
        )
        totals = (
            here.withColumn(name, value.cast("int"))
            .groupBy("node", "dim", "goal", "before", *keys[1:], name)
            .agg(F.sum("size").alias("size"))
        )
        ahead = Window.partitionBy("node").orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        reached = totals.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(ahead), F.lit(0)))
        last = reached.filter(F.col("before") < F.col("goal")).groupBy("node")
        best = F.max(F.struct(name, "before", "dim", "goal", *keys[1:])).alias("best")
        found = cut_lineage(last.agg(best).select("node", "best.*"))
    close = at.select("node", "level", "hash", "size").join(F.broadcast(found), ["node", "level"])
    close = close.filter(F.shiftrightunsigned(F.col("hash"), 48) == F.col("prefix"))
    by_hash = close.groupBy("node", "dim", "goal", "level", "prefix", "before", "hash").agg(F.sum("size").alias("size"))
    ahead = Window.partitionBy("node").orderBy(F.col("hash").bitwiseAND(F.lit((1 << 48) - 1))).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = by_hash.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(ahead), F.lit(0)))
    low = F.col("hash").bitwiseAND(F.lit((1 << 48) - 1)).alias("low")
    left = placed.filter(2 * F.col("before") + F.col("size") <= 2 * F.col("goal"))
    edge = left.groupBy("node").agg(F.max(low).alias("low"))
    return (
        found.select("node", F.col("dim").alias("cut_dim"), F.col("level").alias("cut_level"), F.col("prefix").alias("cut_prefix"))
        .join(edge.withColumnRenamed("low", "cut_low"), "node", "left")
        .withColumn("cut_low", F.coalesce("cut_low", F.lit(-1).cast("long")))
    )


def _goes_left() -> Column:
    level = F.get(F.col("dims"), F.col("cut_dim"))
    prefix = F.shiftrightunsigned(F.col("hash"), 48)
    low = F.col("hash").bitwiseAND(F.lit((1 << 48) - 1))
    same = level == F.col("cut_level")
    return (level < F.col("cut_level")) | (
        same & ((prefix < F.col("cut_prefix")) | ((prefix == F.col("cut_prefix")) & (low <= F.col("cut_low"))))
    )


def kd_shards(docs: DataFrame, shards: int = SHARDS, metadata: tuple[str, ...] = METADATA) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    Leaves are cut until there are ``shards`` of them, each with a near-equal part of all bytes (``law`` is
    ``bytes``); ``slot`` numbers the documents of a shard from 0 without gaps. Null texts weigh 1 byte and
    have the checksum of an empty text; null metadata lies at the low end; metadata columns that are missing
    are left out. Rows equal in all of these are counted, numbered and spread like different ones. An empty table
    gives an empty one.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    present = [c for c in metadata if c in docs.columns]
    own = docs.select("text", "doc_id", *[c for c in present if c != "doc_id"])
    levels = _on_grid(own, present) or [F.lit(0)]
    told = own.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_bytes(F.col("text").cast("string")).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(F.col("doc_id"), text).alias("hash"),
        F.array(*[x.cast("int") for x in levels]).alias("dims"),
    )
    counted = cut_lineage(told.groupBy(*told.columns).agg(F.count("*").alias("n")))
    own_hash = F.when(F.col("copy") == 0, F.col("hash")).otherwise(F.xxhash64("hash", "copy"))
    rows = cut_lineage(
        numbered_copies(counted).withColumn("hash", own_hash).drop("n", "copy").withColumn("node", F.lit(0))
    )
    leaves = cut_lineage(
        docs.sparkSession.range(1).select(
            F.lit(0).alias("node"), F.lit(0).alias("first"), F.lit(shards).alias("count")
        )
    )
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        cuts = cut_lineage(_cuts(rows, leaves, len(levels)))
        right = F.col("cut_dim").isNotNull() & ~F.coalesce(_goes_left(), F.lit(True))
        rows = rows.join(F.broadcast(cuts), "node", "left").withColumn(
            "node", 2 * F.col("node") + right.cast("int") + 1
        ).drop("cut_dim", "cut_level", "cut_prefix", "cut_low")
        half = F.floor(F.col("count") / 2).cast("int")
        whole = F.col("count") == 1
        split = leaves.select(
            F.explode(
                F.array(
                    F.struct(
                        (2 * F.col("node") + 1).alias("node"),
                        F.col("first").alias("first"),
                        F.when(whole, F.col("count")).otherwise(half).alias("count"),
                    ),
                    F.struct(
                        (2 * F.col("node") + 2).alias("node"),
                        (F.col("first") + half).alias("first"),
                        F.when(whole, F.lit(0)).otherwise(F.col("count") - half).alias("count"),
                    ),
                )
            ).alias("leaf")
        ).select("leaf.*")
        leaves = cut_lineage(split.filter("count > 0"))
    placed = rows.join(F.broadcast(leaves.select("node", F.col("first").alias("shard"))), "node")
    numbered = _numbered(placed.select("doc_id", "size", "text_crc32", "hash", F.col("shard").cast("int").alias("shard")))
    return numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _numbered(placed: DataFrame) -> DataFrame:
    """``slot`` from 0 within each shard: counts per hash piece carried forward, rows numbered within pieces."""
    pieces = max(16, math.ceil(placed.count() / _PER_PIECE))
    cut = placed.withColumn("piece", F.pmod("hash", F.lit(pieces)).cast("int"))
    ahead = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy("shard", "piece")
        .agg(F.count("*").alias("n"))
        .select("shard", "piece", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("offset"))
    )
    order = Window.partitionBy("shard", "piece").orderBy("hash", "doc_id", "text_crc32", "size")
    return (
        cut.withColumn("place", F.row_number().over(order) - 1)
        .join(offsets, ["shard", "piece"])
        .withColumn("slot", (F.col("offset") + F.col("place")).cast("long"))
    )
