"""What each filter removes in every order of the filters, from min-plus removal ranks.

A document fails a set of filters, its mask. Row ``m`` of the mask matrix holds 0 where mask ``m`` fails a filter and
infinity elsewhere; column ``p`` of the position matrix is the inverse of permutation ``p``, the step at which each
filter is applied. Their min-plus product is the removal rank: the smallest position among the filters that a mask fails.
So the corpus is read once, reduced to the number of documents of every part and mask, and all orders and steps follow
by scattering those weights to their ranks: one matrix product for a block of parts.

Identical texts are told by their SHA-256. Rows are reduced to small ones before anything is shuffled, copies are
counted and not gathered, and no part, text or id is handled in one group.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import objects
from footfall.session import cut_lineage

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
#: Parts whose orders and steps are laid out at once.
PARTS_AT_ONCE = 64

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_INNER_BYTES = bytes(range(0x80, 0xC0))


def own_mask(text: bytes) -> int:
    """Filters A to D that a text fails, as bits."""
    words = text.split()
    points = len(text) if text.isascii() else len(text.translate(None, _INNER_BYTES))
    upper = len(text) - len(text.translate(None, _UPPER))
    fails = (
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * upper > 5 * points,
        len(text.translate(None, SYMBOLS)) < len(text),
    )
    return sum(1 << f for f, failed in enumerate(fails) if failed)


def _masks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame(
            {
                "doc_id": pd.array([None if i is None else int(i) for i in batch["doc_id"]], dtype="Int64"),
                "part": objects(batch["part"]),
                "text_key": objects(hashlib.sha256(t).digest() for t in batch["text"]),
                "mask": np.fromiter(map(own_mask, batch["text"]), dtype=np.int32, count=len(batch)),
            }
        )


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents, and those labelled good or toxic, of every part and failure mask."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    own = docs.select(
        F.col("doc_id").cast("long").cast("string").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
    )
    judged = own.mapInPandas(_masks, "doc_id long, part string, text_key binary, mask int")
    rows = cut_lineage(judged.groupBy("doc_id", "part", "text_key", "mask").agg(F.count("*").alias("n")))
    firsts = rows.groupBy("text_key").agg(F.min("doc_id").alias("doc_id")).withColumn("is_first", F.lit(True))
    marked = rows.filter("doc_id IS NOT NULL").join(firsts, ["text_key", "doc_id"], "left")
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("good"), F.max((F.col("toxic") == 1).cast("long")).alias("toxic")
    )
    copy = F.when(F.col("is_first").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    with_id = marked.join(flags, "doc_id", "left").select("part", (F.col("mask") + copy).alias("mask"), "n", "good", "toxic")
    without = rows.filter("doc_id IS NULL").select("part", "mask", "n", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return with_id.unionByName(without).groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


@cache
def removal_ranks() -> tuple[list[str], np.ndarray, np.ndarray]:
    """Orders, positions (order × filter, from 0) and ranks (mask × order): the step that removes a mask.

    Nothing removes mask 0; its rank is infinity, kept as the number of filters.
    """
    width = len(FILTERS)
    orders = np.array(list(itertools.permutations(range(width))), dtype=np.int64)
    positions = np.argsort(orders, axis=1)
    bits = (np.arange(1 << width)[:, None] >> np.arange(width)) & 1
    masks = np.where(bits == 1, 0, width)
    ranks = np.minimum((masks[:, None, :] + positions[None, :, :]).min(axis=2), width)
    return ["".join(FILTERS[f] for f in order) for order in orders], positions, ranks


def audit(weights: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """Counts of every part, order and step from the documents of every part and mask (parts × masks)."""
    width = len(FILTERS)
    _, positions, ranks = removal_ranks()
    orders = np.argsort(positions, axis=1)
    n_masks, n_orders = ranks.shape
    at_step = (ranks[:, :, None] == np.arange(width)).astype(np.int64)
    fails = (np.arange(n_masks)[:, None] >> np.arange(width)) & 1
    fails_here = fails[:, orders]
    before = (ranks[:, :, None] < np.arange(width)).astype(np.int64)

    def scatter(counts: np.ndarray, onto: np.ndarray) -> np.ndarray:
        return (counts @ onto.reshape(n_masks, n_orders * width)).reshape(-1, n_orders, width)

    removed = scatter(weights, at_step)
    of_filter = np.zeros((len(weights), width), dtype=np.int64)
    np.add.at(of_filter, (slice(None), orders.ravel()), removed.reshape(len(weights), -1))
    return {
        "kept": weights.sum(axis=1)[:, None, None] - removed.cumsum(axis=2),
        "removed": removed,
        "redundant": scatter(weights, fails_here * before),
        "unique_fails": weights[:, 1 << orders],
        "good_lost": scatter(good, at_step),
        "toxic_lost": scatter(toxic, at_step),
        "shapley": of_filter[:, orders],
    }


def _audits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names, positions, _ = removal_ranks()
    n_orders, width = positions.shape
    for batch in batches:
        for first in range(0, len(batch), PARTS_AT_ONCE):
            some = batch.iloc[first : first + PARTS_AT_ONCE]
            counts = audit(*(np.stack(some[c].to_numpy()).astype(np.int64) for c in ("n", "good", "toxic")))
            yield pd.DataFrame(
                {
                    "part": objects(np.repeat(some["part"].to_numpy(dtype=object), n_orders * width)),
                    "filter_order": objects(np.tile(np.repeat(np.array(names, dtype=object), width), len(some))),
                    "step": np.tile(np.arange(1, width + 1, dtype=np.int32), len(some) * n_orders),
                    **{c: counts[c].ravel() for c in COUNTS},
                }
            )


def filter_interactions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, see ``RESULT``; zeros included.

    Null texts are empty, null sources are the part with the empty name. Repeated rows count each; of rows
    that share text and smallest id none is a copy of the other. Rows without an id are never copies, make
    no others copies, and have no labels. A document is good or toxic if any of its label rows says so; null
    labels and labels of unknown ids say nothing. Without documents there are no rows. Other columns are not
    looked at.
    """
    counted = cut_lineage(failures(docs, labels))
    masks = range(1 << len(FILTERS))
    by_mask = [
        F.array(*[F.sum(F.when(F.col("mask") == m, F.col(c)).otherwise(0)) for m in masks]).alias(c)
        for c in ("n", "good", "toxic")
    ]
    return counted.groupBy("part").agg(*by_mask).mapInPandas(_audits, RESULT)
