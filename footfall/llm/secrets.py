"""Secrets in texts: fixed patterns, and character Markov models for everything that looks random.

Two first-order character models are trained, one of random strings and one of ordinary identifiers and
words: those of the texts, and ones made of their words in the ways identifiers are written. Both classes back off
alike to what characters they hold at all, and no single pair of characters weighs more than ``MOST_PAIR``, so a pair
that ordinary strings never showed does not make a string random. A run of token characters is reported if its log-likelihood ratio per character and in total is above
the thresholds, or else those of its best sub-runs for which that holds, so ordinary text around a random string
does not hide it. Counting is a Spark job over labelled strings; only the two tables of character pairs, whose
size is fixed, reach the driver.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm.common import bounded_sample, objects, span_digest, span_text

Span = tuple[str, int, int]

# The patterns and least lengths of the base kinds.
ASSIGN = re.compile(
    r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex")
_ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")

#: Production parameters: documents that training samples come from, generated random strings, thresholds.
SAMPLE_DOCS = 2_000
GENERATED = 4_000
LEAST_CHARS = 20
LEAST_RATIO = 0.9
LEAST_TOTAL = 24.0
BACK_OFF = 20.0  # pairs' worth of the back-off distribution
MOST_PAIR = 2.5
MADE_PER_DOC = 5  # identifiers made of a training document's words
SCAN_RATIO = 0.45  # a pair below it speaks against a sub-run

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CODE = np.zeros(128, dtype=np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(1, len(_ALPHABET) + 1)
_SIZE = len(_ALPHABET) + 1  # 0 is the edge of a string
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % LEAST_CHARS)


def base_spans(text: str) -> dict[str, list[Span]]:
    """Matches of the fixed patterns by kind, those that are too short left out."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found["assign"] = [
            ("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= ASSIGN_LEAST
        ]
    if "AKIA" in text:
        found["access"] = [
            ("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST
        ]
    found["hex"] = [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def in_order(spans: list[Span]) -> list[Span]:
    """By start, then kind as listed, further kinds last."""
    place = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (s[1], place.get(s[0], len(KINDS)), s[2]))


def pair_counts(strings: list[str]) -> np.ndarray:
    """How often each character follows each other one, edges included; other characters are left out."""
    counts = np.zeros((_SIZE, _SIZE), dtype=np.int64)
    codes = _codes(strings)
    np.add.at(counts, (codes[:-1], codes[1:]), 1)
    counts[0, 0] = 0
    return counts


def _codes(strings: list[str]) -> np.ndarray:
    raw = np.frombuffer(("\n" + "\n".join(strings) + "\n").encode("ascii", "ignore"), dtype=np.uint8)
    return _CODE[raw]


@dataclass(frozen=True)
class RandomnessModel:
    """Log-likelihood ratio of random against ordinary for each pair of characters."""

    ratio: np.ndarray

    def score(self, token: str) -> float:
        codes = _codes([token])
        return float(self.ratio[codes[:-1], codes[1:]].sum())


def fit(samples: DataFrame) -> RandomnessModel:
    """Train on ``text, random`` (1 for random strings); repeated rows count as often as they come.

    Null texts and labels are skipped. A pair's probability is shared between its count and the class's characters,
    half of them uniform; without rows all ratios are 0.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals = np.zeros((2, _SIZE, _SIZE), dtype=np.int64)
        for batch in batches:
            for label in (0, 1):
                totals[label] += pair_counts(batch["text"][batch["random"] == label].tolist())
        label, a, b = np.nonzero(totals)
        yield pd.DataFrame({"random": label, "a": a, "b": b, "n": totals[label, a, b]})

    pairs = (
        samples.filter("text is not null and random is not null")
        .select("text", F.col("random").cast("int").alias("random"))
        .mapInPandas(count, "random int, a int, b int, n long")
        .groupBy("random", "a", "b")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    totals = np.zeros((2, _SIZE, _SIZE))
    np.add.at(totals, (pairs["random"].to_numpy(int), pairs["a"].to_numpy(int), pairs["b"].to_numpy(int)), pairs["n"].to_numpy(float))
    characters = totals.sum(axis=1) + 1
    behind = 0.5 * characters / characters.sum(axis=1, keepdims=True) + 0.5 / _SIZE
    logs = np.log((totals + BACK_OFF * behind[:, None, :]) / (totals.sum(axis=2, keepdims=True) + BACK_OFF))
    return RandomnessModel(np.clip(logs[1] - logs[0], -MOST_PAIR, MOST_PAIR))


def identifiers(words: list[str], chance: random.Random, n: int) -> list[str]:
    """Ordinary strings as programs and paths hold them: joined words in all the usual cases, numbers, repeated
    characters and stretches of an alphabet."""
    plain = [w.lower() for w in words if w.isalpha() and w.isascii()] or ["word"]
    found = []
    for _ in range(n):
        some = [chance.choice(plain) for _ in range(chance.randint(2, 5))]
        start, length = chance.randrange(len(_ALPHABET) - 12), chance.randint(6, 40)
        ways = (
            lambda: "".join(w.title() for w in some),
            lambda: some[0] + "".join(w.title() for w in some[1:]),
            lambda: "_".join(some),
            lambda: "-".join(some),
            lambda: "/".join(some),
            lambda: "_".join(some).upper(),
            lambda: "".join(some),
            lambda: f"{'_'.join(some)}_{chance.randint(1, 99_999)}",
            lambda: chance.choice(_ALPHABET) * length,
            lambda: "".join(chance.choice("0123456789") for _ in range(length)),
            lambda: _ALPHABET[start : start + length],
        )
        found.append(chance.choice(ways)())
    return found


def labelled_samples(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, generated: int = GENERATED) -> DataFrame:
    """Labelled strings: values and words of ``sample_docs`` documents, identifiers made of the words, and generated
    random strings.

    The documents are those with the smallest hashes, a bound on the rows that train the models. Values
    matched by the fixed patterns are random, other words ordinary.
    """

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, labels = [], []
            for text in batch["text"]:
                spans = sorted((s, e) for kind in base_spans(text).values() for _, s, e in kind)
                at, rest = 0, []
                for start, end in spans:
                    rest.append(text[at:start])
                    at = max(at, end)
                    value = re.split(r"[\s:=\"']+", text[start:end])[-1]
                    texts.append(value)
                    labels.append(1)
                rest.append(text[at:])
                words = sorted({w for w in re.findall(r"[A-Za-z0-9+/_=-]{6,}", " ".join(rest))})
                words += identifiers(words, random.Random(zlib.crc32(text.encode("utf-8", "replace"))), MADE_PER_DOC)
                texts.extend(words)
                labels.extend([0] * len(words))
            yield pd.DataFrame({"text": objects(texts), "random": labels})

    chosen = bounded_sample(docs, sample_docs)
    return chosen.select("text").mapInPandas(label, "text string, random int").unionByName(
        random_strings(docs.sparkSession, generated)
    )


def random_strings(spark: SparkSession, rows: int) -> DataFrame:
    """Seeded random strings over hexadecimal, base-62 and base-64 characters."""
    alphabets = ("0123456789abcdef", _ALPHABET[:62], _ALPHABET[:64])
    pick = F.element_at(F.array(*map(F.lit, alphabets)), (F.col("id") % 3 + 1).cast("int"))
    letters = F.transform(
        F.sequence(F.lit(1), F.lit(40)),
        lambda i: F.substr(
            F.col("pick"), (F.pmod(F.xxhash64(F.col("id"), i), F.length("pick")) + 1).cast("int"), F.lit(1)
        ),
    )
    return spark.range(rows).withColumn("pick", pick).select(F.array_join(letters, "").alias("text"), F.lit(1).alias("random"))


def random_parts(token: str, model: RandomnessModel) -> list[tuple[int, int]]:
    """Random strings in a run of token characters: the run if it is one as a whole, or else its best sub-runs.

    Best are the maximal-scoring sub-runs (Ruzzo and Tompa) of the pairs' ratios less ``SCAN_RATIO``; none can
    be made better by a longer or shorter one, and they do not overlap. The pairs at the token's edges are
    left out there.
    """
    codes = _codes([token])
    ratios = model.ratio[codes[:-1], codes[1:]]
    whole = float(ratios.sum())
    if whole >= LEAST_TOTAL and whole >= LEAST_RATIO * len(token):
        return [(0, len(token))]
    totals = np.r_[0.0, np.cumsum(ratios[1:-1])]
    found = []
    for first, last in _maximal((totals - SCAN_RATIO * np.arange(len(totals))).tolist()):
        # The pairs first to last - 1 join the characters first to last.
        if last - first + 1 >= LEAST_CHARS and totals[last] - totals[first] >= max(LEAST_TOTAL, LEAST_RATIO * (last - first)):
            found.append((first, last + 1))
    return found


def _maximal(sums: list[float]) -> list[tuple[int, int]]:
    """Maximal-scoring sub-runs as (first, last) places of the running sums, in linear time."""
    runs: list[tuple[int, int]] = []
    links: list[int] = []  # the last earlier run whose left sum is less
    for i in range(1, len(sums)):
        if sums[i] <= sums[i - 1]:
            continue
        left, right = i - 1, i
        while True:
            j = len(runs) - 1
            while j >= 0 and sums[runs[j][0]] >= sums[left]:
                j = links[j]
            if j < 0 or sums[runs[j][1]] >= sums[right]:
                runs.append((left, right))
                links.append(j)
                break
            left = runs[j][0]
            del runs[j:], links[j:]
    return runs


def secret_spans(text: str, model: RandomnessModel) -> tuple[list[Span], list[Span], dict[str, int]]:
    """All spans, base spans (both in order), and counts of base kinds."""
    found = base_spans(text)
    base = in_order([s for kind in KINDS for s in found[kind]])
    more, at = [], 0
    for start, end in [*sorted((s, e) for _, s, e in base), (len(text), len(text))]:
        for m in _TOKEN.finditer(text, at, max(at, start)):
            more += [("random", m.start() + s, m.start() + e) for s, e in random_parts(m.group(), model)]
        at = max(at, end)
    return in_order(base + more), base, {kind: len(found[kind]) for kind in KINDS}


def _scan(model: RandomnessModel) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [secret_spans(text, model) for text in batch["text"]]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    **{f"n_{kind}": [r[2][kind] for r in rows] for kind in KINDS},
                    "base_sha256": objects(span_digest(r[1]) for r in rows),
                    "spans": objects(span_text(r[0]) for r in rows),
                }
            )

    return run


def find_secrets(docs: DataFrame, model: RandomnessModel) -> DataFrame:
    """One row per document: ``doc_id``, counts of base kinds, digest of the base spans, and all spans.

    Spans are ``kind:start:end`` in code points, end exclusive; what only the models find has kind
    ``random``. Null and empty texts have none; repeated rows give repeated results, an empty table an empty
    one; other columns are not looked at.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return own.mapInPandas(
        _scan(model),
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
