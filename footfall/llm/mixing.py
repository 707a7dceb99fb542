"""Mixing sources to target weights by capped water-filling, in DataFrame functions only.

Sources get shares of all words by weight. A share above the most epochs its source allows is clamped, and
what it gives up goes to the others by weight until none is above. Repeating "clamp and share again" ends at
one level L with ``target = min(cap, L * weight)``, so L is read off running totals over the sources in the
order in which they would be clamped.

A document is taken ``floor(target / size)`` whole times, and once more if it is among the first in seeded
hash order whose words fill the rest of its source's target. Rows equal in id, source and text have a key for each copy. That place in the order is found by two rounds
of totals per hash prefix; only the documents of the last prefix, about one in 16 million, are ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import WORD, numbered_copies
from footfall.session import cut_lineage

#: Production parameters.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"
MOST_BROADCAST = 100_000  # sources in a plan that is broadcast, a few MB

_DIGITS = 3  # hexadecimal digits of the hash that each round resolves


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def hash_key(seed: str) -> Column:
    """A document's place in the seeded order: 16 hexadecimal digits of its id and whole text."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.col("doc_id").cast("string"), F.col("text"))), 1, 16)


def copy_key() -> Column:
    """The key of copy number ``copy`` among rows that share a key; the first keeps it."""
    return F.when(F.col("copy") == 0, F.col("key")).otherwise(
        F.substring(F.md5(F.concat_ws(":", F.col("key"), F.col("copy").cast("string"))), 1, 16)
    )


def _copied(sized: DataFrame) -> DataFrame:
    """Rows with a key each, stored: equal rows are counted first and numbered, so none is a hot key."""
    counted = cut_lineage(sized.groupBy(*sized.columns).agg(F.count("*").alias("n")))
    return cut_lineage(numbered_copies(counted).withColumn("key", copy_key()).drop("n", "copy"))


def water_fill(sources: DataFrame, weights: tuple[int, ...], most_epochs: int) -> DataFrame:
    """``source, source_size`` → with ``target``. Sources by code point, null last, weigh ``weights`` in turn.

    Works on one row per source.
    """
    named = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy(F.lit(1))
    clamped_first = everything.orderBy("_full_at", "_place").rowsBetween(Window.unboundedPreceding, -1)
    place = F.row_number().over(named) - 1
    listed = sources.select("source", "source_size", place.alias("_place")).withColumns(
        {
            "_weight": F.element_at(F.array(*map(F.lit, weights)), (F.col("_place") % len(weights) + 1).cast("int")),
            "_cap": most_epochs * F.col("source_size"),
            "_all": F.sum("source_size").over(everything),
        }
    )
    ordered = listed.withColumn("_full_at", F.col("_cap") / F.col("_weight"))
    left = ordered.withColumns(
        {
            "_rest": F.col("_all") - F.coalesce(F.sum("_cap").over(clamped_first), F.lit(0)),
            "_sharing": F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(clamped_first), F.lit(0)),
        }
    ).withColumn("_level", F.col("_rest") / F.col("_sharing"))
    holds = F.when(F.col("_level") <= F.col("_full_at"), F.struct("_full_at", "_place", "_level"))
    return left.withColumn("_level", F.min(holds).over(everything)["_level"]).select(
        "source",
        "source_size",
        F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")).alias("target"),
    )


def _first_left(totals: DataFrame, prefix: str) -> DataFrame:
    """Per source the last prefix that begins before the wanted words are reached, and the words ahead of it."""
    order = Window.partitionBy("source").orderBy(prefix).rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.withColumn("_ahead", F.coalesce(F.sum("words").over(order), F.lit(0)) + F.col("_before"))
    return (
        ahead.filter(F.col("_ahead") <= F.col("_extra"))
        .groupBy("source")
        .agg(F.max(F.struct(prefix, "_ahead")).alias("_last"), F.first("_extra").alias("_extra"))
        .select("source", "_extra", F.col("_last")[prefix].alias("_prefix"), F.col("_last")["_ahead"].alias("_before"))
    )


def mixing_plan(
    sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """One row per source: size, target, whole repetitions, and the last hash key that is taken once more.

    ``sized`` (``source, key, size``) should be stored, as it is read four times.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(sources, weights, most_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = cut_lineage(
        targets.withColumn("whole", whole).withColumn(
            "_extra", F.col("target") - F.col("whole") * F.col("source_size")
        )
    )
    plan = bounded(plan)
    wanted = plan.select("source", "_extra", F.lit("").alias("_prefix"), F.lit(0).cast("long").alias("_before"))
    for digits in (_DIGITS, 2 * _DIGITS):
        here = _within(sized, wanted).withColumn("_next", F.substring("key", 1, digits))
        totals = here.groupBy("source", "_next").agg(
            F.sum("size").alias("words"), F.first("_extra").alias("_extra"), F.first("_before").alias("_before")
        )
        wanted = _first_left(totals, "_next")
    own = _within(sized, wanted)
    by_key = own.groupBy("source", "key").agg(
        F.sum("size").alias("size"), F.first("_extra").alias("_extra"), F.first("_before").alias("_before")
    )
    order = Window.partitionBy("source").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("size").over(order), F.lit(0)) + F.col("_before")
    taken = by_key.withColumn("_ahead", ahead).filter(2 * F.col("_ahead") + F.col("size") <= 2 * F.col("_extra"))
    last = taken.groupBy("source").agg(F.max("key").alias("_key"))
    cut = _null_safe(wanted.select("source", "_prefix"), last, "left").select(
        "source", F.coalesce("_key", "_prefix").alias("cut")
    )
    return _null_safe(plan.drop("_extra"), cut, "left")


def bounded(plan: DataFrame) -> DataFrame:
    """A stored plan, marked for broadcast if it has few enough rows; the join shuffles otherwise."""
    return F.broadcast(plan) if plan.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else plan


def _null_safe(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on source, null with null."""
    other = right.withColumnRenamed("source", "_source")
    return left.join(other, F.col("source").eqNullSafe(F.col("_source")), how).drop("_source")


def _within(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    return _null_safe(sized, wanted, "inner").filter(F.col("key").startswith(F.col("_prefix")))


def repeats(most_epochs: int) -> Column:
    """How often a document is taken, from its source's plan and its own key."""
    once_more = F.coalesce(F.col("key") <= F.col("cut"), F.lit(False)).cast("long")
    return F.least(F.col("whole") + once_more, F.lit(most_epochs)).cast("long")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = SEED
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, repeats, taken``.

    Null and empty texts have size 0; documents without a source are a source of their own, listed last.
    Rows with equal id, source and text are counted, numbered and taken one by one. An empty table gives an
    empty one. Equal input gives equal output however it is partitioned.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    sized = _copied(
        own.select("doc_id", "source", hash_key(seed).alias("key"), word_count(F.col("text")).alias("size"))
    )
    plan = cut_lineage(mixing_plan(sized.drop("doc_id"), weights, most_epochs))
    return _null_safe(sized, bounded(plan), "inner").select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        repeats(most_epochs).alias("repeats"),
        (repeats(most_epochs) * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS, seed: str = SEED
) -> DataFrame:
    """The mixture itself: every document as often as it is taken, with all its columns.

    Only the plan, one row per source, is joined to the texts; these are not shuffled unless there are more
    than ``MOST_BROADCAST`` sources. Rows that share id, source and text are reduced to different rows with their
    counts before anything else; their copies are taken one by one.
    """
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        F.col("text").cast("string").alias("text"),
    )
    keyed = row.select("_row", "source", "text", hash_key(seed).alias("key"))
    counted = cut_lineage(
        keyed.select("source", "key", word_count(F.col("text")).alias("size"))
        .groupBy("source", "key", "size")
        .agg(F.count("*").alias("n"))
    )
    sized = cut_lineage(numbered_copies(counted).withColumn("key", copy_key()).drop("n", "copy"))
    plan = cut_lineage(mixing_plan(sized, weights, most_epochs))
    shared = counted.filter("n > 1").select(F.col("source").alias("_source"), F.col("key").alias("_key"))
    same = (F.col("key") == F.col("_key")) & F.col("source").eqNullSafe(F.col("_source"))
    alone = keyed.drop("text").join(shared, same, "left_anti")
    taken = _null_safe(alone, bounded(plan), "inner").select("_row", repeats(most_epochs).alias("_times"))
    if not shared.isEmpty():
        taken = taken.unionByName(_of_copies(keyed.drop("text").join(shared, same, "left_semi"), plan, most_epochs))
    copies = taken.filter("_times > 0").select(
        "_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))).alias("_copy")
    )
    return copies.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def _of_copies(keyed: DataFrame, plan: DataFrame, most_epochs: int) -> DataFrame:
    """``_row, _times`` of rows that share their key with others: different ones in a fixed order, equal ones counted."""
    different = cut_lineage(keyed.groupBy("_row", "source", "key").agg(F.count("*").alias("n")))
    order = Window.partitionBy("source", "key").orderBy(F.xxhash64("_row"), F.to_json("_row"))
    ahead = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cut_lineage(different.select("*", ahead.alias("_ahead"), F.monotonically_increasing_id().alias("_id")))
    numbered = numbered_copies(placed.drop("_row")).withColumn("copy", F.col("copy") + F.col("_ahead"))
    keys = numbered.withColumn("key", copy_key())
    times = _null_safe(keys, bounded(plan), "inner").select("_id", repeats(most_epochs).alias("_times"))
    return times.filter("_times > 0").join(placed.select("_id", "_row"), "_id").select("_row", "_times")
