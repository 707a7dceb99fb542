"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Two fingerprints that differ in at most
two bits agree in one whole segment, and the segment after it differs in at most two bits. Read as words of 23
bits, that segment is decoded with the perfect binary Golay code to the indices of all codewords within four
bits: one index, or six for words that are three bits off. Words at most two bits apart always share an index
(heptads and octads of the Steiner system S(4, 7, 23)), so the key "whole segment, index of the next one"
finds every pair. Candidates are verified bit by bit.

Buckets of more than ``BUCKET`` fingerprints are not compared pair by pair: their members are listed under
themselves and each of their 64 one-bit neighbours, and two of them share such an entry exactly if they differ
in at most two bits, so linking each entry's members to its smallest loses no link.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.llm.common import identified
from footfall.llm.components import components
from footfall.session import cut_lineage

SHINGLE = 3
SEED = 42
MOST_BITS = 2
#: Fingerprints of a key that are compared with each other; more are linked through their neighbours.
BUCKET = 64

# The generator polynomial of the binary Golay code and the segments (shift, width).
GOLAY = 0xC75
SEGMENTS = ((42, 22), (21, 21), (0, 21))

_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """SimHash of the 3-word shingles, lower-cased in A-Z; 0 without words. Signed, as Spark's long."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], dtype=np.uint64)
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
        ends = np.cumsum(sizes) - 1
        starts = (ends + 1 - sizes)[: len(words) - SHINGLE + 1].tolist()
        hash_of = xxhash.xxh64_intdigest
        hashes = np.fromiter(
            (hash_of(joined[s:e], SEED) for s, e in zip(starts, ends[SHINGLE - 1 :].tolist())),
            dtype=np.uint64,
            count=len(starts),
        )
    ones = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), _AT_ONCE):
        part = hashes[i : i + _AT_ONCE].astype("<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [fingerprint(text) for text in batch["text"]]
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "text_hash": batch["text_hash"], "fp": np.array(found, dtype=np.int64)}
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, fp`` of every row."""
    own = identified(docs).withColumn("text", F.col("text").cast("binary"))
    return own.mapInPandas(_fingerprints, "doc_id long, text_hash long, fp long")


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where((rest >> bit) & 1, GOLAY << (bit - 11), 0)
    return rest


def golay_patterns() -> tuple[np.ndarray, np.ndarray]:
    """Error patterns of at most four bits by remainder (2048 × 6), and how many each remainder has."""
    patterns = np.array(
        [sum(1 << b for b in bits) for size in range(5) for bits in itertools.combinations(range(23), size)],
        dtype=np.int64,
    )
    table, count = np.zeros((2048, 6), dtype=np.int64), np.zeros(2048, dtype=np.int64)
    for pattern, rest in zip(patterns.tolist(), _remainders(patterns).tolist()):
        table[rest, count[rest]] = pattern
        count[rest] += 1
    return table, count


def golay_keys(fps: np.ndarray, table: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints."""
    parts = [((fps.astype(np.uint64) >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64) for shift, width in SEGMENTS]
    rows, keys = [], []
    for i, whole in enumerate(parts):
        fuzzy = parts[(i + 1) % len(parts)]
        rest = _remainders(fuzzy)
        for k in range(table.shape[1]):
            has = np.flatnonzero(k < count[rest])
            index = (fuzzy[has] ^ table[rest[has], k]) >> 11
            rows.append(has)
            keys.append((i << 34) | (whole[has] << 12) | index)
    return np.concatenate(rows), np.concatenate(keys)


def _keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    table, count = golay_patterns()
    for batch in batches:
        fps = batch["fp"].to_numpy()
        rows, keys = golay_keys(fps, table, count)
        yield pd.DataFrame({"fp": fps[rows], "key": keys})


def _close(a: Column, b: Column, most_bits: int) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= most_bits


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints ``fp`` → links ``a, b`` whose closure is that of all pairs within two bits."""
    keyed = cut_lineage(fps.select("fp").mapInPandas(_keys, "fp long, key long"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
    shared = cut_lineage(buckets.filter("n > 1"))
    twos = shared.filter("n = 2").select("a", "b").filter(_close(F.col("a"), F.col("b"), MOST_BITS))
    some = cut_lineage(keyed.join(shared.filter(f"n > 2 and n <= {bucket}").select("key"), "key").select("key", "fp"))
    left, right = some.withColumnRenamed("fp", "a"), some.withColumnRenamed("fp", "b")
    near = left.join(right, "key").filter("a < b").filter(_close(F.col("a"), F.col("b"), MOST_BITS)).select("a", "b")
    many = keyed.join(shared.filter(f"n > {bucket}").select("key"), "key").select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for b in range(64)])
    around = cut_lineage(
        many.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("at"))
    )
    hubs = around.groupBy("at").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).filter("n > 1")
    starred = around.join(hubs.select("at", "hub"), "at").filter("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    return twos.unionByName(near).unionByName(starred).distinct()


def clusters(signed: DataFrame) -> DataFrame:
    """Stored ``doc_id, text_hash, fp`` → one row per fingerprint: ``fp, root, first_id``.

    ``first_id`` is the smallest id of the whole component, null if none of its documents has an id.
    """
    distinct = cut_lineage(signed.groupBy("fp").agg(F.min("doc_id").alias("own_id")))
    found = components(links(distinct)).select(F.col("node").alias("fp"), "root")
    linked = cut_lineage(found.join(distinct, "fp"))
    firsts = linked.groupBy("root").agg(F.min("own_id").alias("first_id"))
    by_fp = linked.select("fp", "root").join(firsts, "root")
    return distinct.join(by_fp, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.when(F.col("root").isNull(), F.col("own_id")).otherwise(F.col("first_id")).alias("first_id")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``, fingerprints linked at two bits or fewer.

    Null and empty texts and texts without words have fingerprint 0 and link like any other. Rows without an
    id take part; a component of such rows alone has a null ``component_id``. Repeated rows give repeated
    results, an empty table an empty one; other columns are not looked at.
    """
    signed = cut_lineage(fingerprints(docs))
    return signed.join(cut_lineage(clusters(signed)), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("first_id").alias("component_id")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest id, with all columns of ``docs``.

    Among rows that share the smallest id, or without ids, the one with the smallest hash of its text stays.
    """
    signed = cut_lineage(fingerprints(docs))
    rooted = signed.join(cut_lineage(clusters(signed).select("fp", "root")), "fp")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = cut_lineage(
        rooted.groupBy("root").agg(F.min(order).alias("first")).select(
            F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")
        )
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_doc"),
        F.xxhash64(text).alias("_text"),
    )
    mine = row.join(kept, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash")))
    place = F.row_number().over(Window.partitionBy("_doc", "_text").orderBy("_doc", "_text"))
    first = mine.withColumn("_place", place).filter("_place = 1")
    return first.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
