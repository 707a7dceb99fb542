"""Words, identities and span texts shared by the operators."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: A word, and what stands between words: ASCII blanks only, as ``bytes.split`` has them.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

DIGEST = "doc_id long, text_hash long"


def words_of(text: Column) -> Column:
    """All words of a text as an array; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is evaluated once, also inside higher-order functions."""
    return F.transform(F.array(value), body)[0]


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long, ``text`` (null: empty) and ``text_hash``, which tells rows of one id apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn(
        "text_hash", F.xxhash64("text")
    )


def bounded_sample(docs: DataFrame, rows: int) -> DataFrame:
    """``doc_id, text`` of at most ``rows`` different pairs of id and text, those with the smallest hashes.

    Rows without an id or a text are left out; copies of a pair count once, so no id brings more rows than the bound.
    """
    own = identified(docs.filter("doc_id IS NOT NULL AND text IS NOT NULL"))
    ids = own.select("doc_id", "text_hash").distinct().orderBy(F.xxhash64("doc_id", "text_hash"), "doc_id").limit(rows)
    chosen = own.join(F.broadcast(ids), ["doc_id", "text_hash"], "left_semi")
    return chosen.dropDuplicates(["doc_id", "text_hash"]).select("doc_id", "text")


#: Copies of one row that a task lays out.
COPIES_AT_ONCE = 20_000


def numbered_copies(counted: DataFrame, n: str = "n") -> DataFrame:
    """Every row of a stored table as often as ``n`` says, numbered from 0 in ``copy``.

    Rows with many copies are laid out in stretches by many tasks.
    """
    few = counted.filter(F.col(n) <= COPIES_AT_ONCE)
    first = F.sequence(F.lit(0).cast("long"), F.col(n) - 1, F.lit(COPIES_AT_ONCE).cast("long"))
    dealt = counted.filter(F.col(n) > COPIES_AT_ONCE).withColumn("_first", F.explode(first))
    dealt = dealt.repartition(F.col("_first"), F.col(n))
    last = F.least(F.col("_first") + COPIES_AT_ONCE, F.col(n)) - 1
    many = dealt.withColumn("copy", F.explode(F.sequence(F.col("_first"), last))).drop("_first")
    return few.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))).unionByName(many)


def objects(values: Iterable) -> pd.Series:
    """A pandas column of Python objects. Texts that pandas takes as strings of its own may come in chunks,
    which Spark's Arrow writer refuses."""
    return pd.Series(list(values), dtype=object)


def span_text(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def span_digest(spans: Iterable[tuple[str, int, int]]) -> str:
    return hashlib.sha256(span_text(spans).encode()).hexdigest()
