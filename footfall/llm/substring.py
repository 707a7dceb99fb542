"""Passages of 35 words or more that repeat within or across documents, removed by seed and extend.

Seeds are winnowed anchors: of every 28 consecutive 8-word sequences the one with the smallest hash, so that
each window of 35 words holds an anchor, and equal windows hold it at the same place. Only anchors that occur
twice go on.

Extension never compares occurrences pair by pair. Each anchor carries a hash of its widest context, the 27
words to both sides. Occurrences with equal context are repeats as far as any window around the anchor
reaches; they form a class and are covered at once, however many they are. Where classes of one anchor differ,
one occurrence of each is extended word by word: its windows are hashed and compared with the windows of the
other classes, so the ends of a repeat are found exactly. Work and rows grow with the repeated text, not with
the number of pairs. Keys are two independent 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import identified, objects
from footfall.session import cut_lineage

#: Production parameters: words of a repeat, and of an anchor.
LEAST_WORDS = 35
ANCHOR = 8

# Odd multipliers of the three rolling hashes.
ANCHOR_BASE, CONTEXT_BASE, WINDOW_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93

_CACHED_WORDS = 400_000
_PLACE_BITS = 24


class WordHashes(dict):
    """Hashes of the words met so far; emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word) - (1 << 63)
        return value


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)).view(np.uint64)


def rolling(hashes: np.ndarray, base: int, width: int) -> np.ndarray:
    """Polynomial hash of every ``width`` consecutive values, mixed at the end."""
    mask = (1 << 64) - 1
    total, covered, power = None, 0, hashes
    span, factor = 1, base & mask  # power covers span values; factor is base ** span
    while True:
        if width & span:
            if total is None:
                total, covered = power, span
            else:
                size = len(hashes) - covered - span + 1
                total = power[:size] * np.uint64(pow(base, covered, 1 << 64)) + total[span : span + size]
                covered += span
        if covered == width:
            break
        power = power[:-span] * np.uint64(factor) + power[span:]
        factor = factor * factor & mask
        span *= 2
    mixed = total ^ (total >> np.uint64(31))
    mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def smallest_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` consecutive values the place of the smallest, the last one among equals."""
    found, chunk = [], (1 << _PLACE_BITS) - width
    for at in range(0, max(len(values) - width + 1, 0), chunk):
        part = values[at : at + chunk + width - 1]
        places = np.uint64((1 << _PLACE_BITS) - 1) - np.arange(len(part), dtype=np.uint64)
        low = (part & ~np.uint64((1 << _PLACE_BITS) - 1)) | places
        span = 1
        while span * 2 <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        if span < width:
            low = np.minimum(low[: len(low) - (width - span)], low[width - span :])
        mask = np.uint64((1 << _PLACE_BITS) - 1)
        found.append((mask - (low & mask)).astype(np.int64) + at)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def anchors(hashes: np.ndarray, least: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place, anchor hash and context hash of the anchors of a text of at least ``least`` words."""
    seeds = rolling(hashes, ANCHOR_BASE, anchor)
    places = np.unique(smallest_places(seeds, least - anchor + 1))
    side = least - anchor
    padded = np.concatenate([np.zeros(side, np.uint64), hashes, np.zeros(side, np.uint64)])
    contexts = rolling(padded, CONTEXT_BASE, anchor + 2 * side)
    return places, seeds[places], contexts[places]


def _find_anchors(least: int, anchor: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            ids, hashed, sizes, found = [], [], [], []
            for doc_id, text_hash, text in zip(batch["doc_id"], batch["text_hash"], batch["text"]):
                words = text.split()
                if len(words) < least:
                    continue
                own = anchors(word_hashes(words, known), least, anchor)
                ids.append(doc_id)
                hashed.append(text_hash)
                sizes.append(len(own[0]))
                found.append(own)
            if found:
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(np.repeat(np.array(ids, dtype=object), sizes), dtype="Int64"),
                        "text_hash": np.repeat(np.array(hashed, dtype=np.int64), sizes),
                        "pos": np.concatenate([f[0] for f in found]).astype(np.int32),
                        "anchor": np.concatenate([f[1] for f in found]).view(np.int64),
                        "context": np.concatenate([f[2] for f in found]).view(np.int64),
                    }
                )

    return run


def _extend(least: int, anchor: int):
    """Windows whose own anchor is at one of the listed places (place * 2 + 1 if its class is that one place)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for batch in batches:
            for doc_id, text_hash, text, listed in zip(
                batch["doc_id"], batch["text_hash"], batch["text"], batch["listed"]
            ):
                hashes = word_hashes(text.split(), known)
                seeds = rolling(hashes, ANCHOR_BASE, anchor)
                places = smallest_places(seeds, least - anchor + 1)
                wanted = np.zeros(len(seeds), dtype=np.int8)
                listed = np.asarray(listed, dtype=np.int64)
                wanted[listed >> 1] = 1 + (listed & 1)
                starts = np.flatnonzero(wanted[places])
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array([doc_id] * len(starts), dtype="Int64"),
                        "text_hash": np.full(len(starts), text_hash, dtype=np.int64),
                        "pos": starts.astype(np.int32),
                        "alone": wanted[places[starts]] == 2,
                        "anchor": seeds[places[starts]].view(np.int64),
                        "window": rolling(hashes, WINDOW_BASE, least)[starts].view(np.int64),
                    }
                )

    return run


def _texts(docs: DataFrame) -> DataFrame:
    return identified(docs).withColumn("text", F.col("text").cast("binary"))


def _same_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    other = right.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    return left.join(other, same, how).drop("_id", "_hash")


def repeats(docs: DataFrame, least: int = LEAST_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """Repeated spans of words: ``doc_id, text_hash, spans``, each span as ``start << 32 | end``."""
    texts = _texts(docs)
    found = cut_lineage(
        texts.mapInPandas(
            _find_anchors(least, anchor), "doc_id long, text_hash long, pos int, anchor long, context long"
        )
    )
    # Key lists are stored before they are joined: Spark splits hot keys only of joins that read plain exchanges.
    twice = cut_lineage(found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    seeds = cut_lineage(found.join(twice, "anchor"))
    place = F.struct("doc_id", "text_hash", "pos")
    classes = cut_lineage(
        seeds.groupBy("anchor", "context").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    )
    side = least - anchor
    alike = seeds.join(classes.filter("n > 1").select("anchor", "context"), ["anchor", "context"])
    covered = alike.select(
        "doc_id", "text_hash", F.greatest(F.col("pos") - side, F.lit(0)).alias("start"), (F.col("pos") + least).alias("end")
    )
    differing = cut_lineage(
        classes.groupBy("anchor").agg(F.count("*").alias("classes")).filter("classes > 1").select("anchor")
    )
    extended = classes.join(differing, "anchor").select("one.*", (F.col("n") == 1).cast("long").alias("alone"))
    listed = extended.groupBy("doc_id", "text_hash").agg(
        F.collect_set(F.col("pos").cast("long") * 2 + F.col("alone")).alias("listed")
    )
    windows = cut_lineage(
        _same_row(texts, listed, "inner").mapInPandas(
            _extend(least, anchor),
            "doc_id long, text_hash long, pos int, alone boolean, anchor long, window long",
        )
    )
    elsewhere = cut_lineage(
        windows.groupBy("anchor", "window").agg(F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    ends = windows.filter("alone").join(elsewhere, ["anchor", "window"]).select(
        "doc_id", "text_hash", F.col("pos").alias("start"), (F.col("pos") + least).alias("end")
    )
    span = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
    return (
        covered.unionByName(ends)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(span).alias("spans"))
    )


def kept_words(words: list[bytes], spans: np.ndarray) -> list[bytes]:
    """The words outside the spans."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    starts, ends = spans >> 32, np.minimum(spans & 0xFFFFFFFF, len(words))
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        n_words, n_removed, digests = [], [], []
        for text, spans in zip(batch["text"], batch["spans"]):
            words = text.split()
            kept = words if spans is None else kept_words(words, np.asarray(spans, dtype=np.int64))
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        yield pd.DataFrame(
            {"doc_id": batch["doc_id"], "n_words": n_words, "n_removed": n_removed, "kept_sha256": objects(digests)}
        )


def without_repeats(docs: DataFrame, least: int = LEAST_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256``.

    A window of ``least`` words that begins at two places, in one document or two, goes in both. Null, empty
    and shorter texts lose nothing; repeated rows are copies of each other; an empty table gives an empty
    one; rows without an id are told apart by their text.
    """
    joined = _same_row(_texts(docs), repeats(docs, least, anchor), "left")
    return joined.select("doc_id", "text", "spans").mapInPandas(
        _strip, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )


def _join_kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [
            b" ".join(text.split() if spans is None else kept_words(text.split(), np.asarray(spans, dtype=np.int64)))
            for text, spans in zip(batch["text"], batch["spans"])
        ]
        yield pd.DataFrame({"doc_id": batch["doc_id"], "kept": objects(t.decode("utf-8", "replace") for t in texts)})


def stripped(docs: DataFrame, least: int = LEAST_WORDS, anchor: int = ANCHOR) -> DataFrame:
    """``doc_id`` and ``kept``, the text that is left with one blank between words."""
    joined = _same_row(_texts(docs), repeats(docs, least, anchor), "left")
    return joined.select("doc_id", "text", "spans").mapInPandas(_join_kept, "doc_id long, kept string")
