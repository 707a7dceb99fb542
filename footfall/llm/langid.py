"""Language identification by error-correcting output codes.

Every language has a codeword. Each bit of it is predicted by a binary n-gram classifier: the log-likelihood
ratio of a text's character n-grams between the languages with the bit set and those without. Decoding takes
the codeword with the smallest weighted logistic loss over all bits, and flags texts whose two best codewords
are close. n-gram counts come from all training documents in one Spark pass; the driver sees one count per
language and n-gram bucket, a size fixed by parameters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import objects

#: Production parameters: n-gram lengths in bytes, hash buckets, and the gap in score below which a text is ambiguous.
LENGTHS = (2, 3, 4)
BUCKETS = 1 << 14
AMBIGUOUS = 0.2
UNKNOWN = "und"

_AT_ONCE = 1 << 18  # bytes
_MOST_EXHAUSTIVE = 5
_WEIGHTY = 60.0
_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from. Rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def letters(text: str) -> np.ndarray:
    """The lower-case UTF-8 bytes of a text between blanks; what is not a letter is a blank."""
    return np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace").translate(_LETTERS), dtype=np.uint8)


def buckets(raw: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
    """Hash buckets of the n-grams that start at places ``first`` to ``last`` (exclusive; None: to the end).

    n-grams that end in two blanks are left out, so blanks between words count once.
    """
    last = len(raw) if last is None else last
    part = raw[first : last + max(LENGTHS) - 1]
    blank = part == 32
    codes, found = part.astype(np.uint32), []
    value = codes.copy()
    for n in range(2, max(LENGTHS) + 1):
        value = value[:-1] * np.uint32(257) + codes[n - 1 :]
        if n in LENGTHS:
            mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x9E3779B1)
            ends = ~(blank[n - 1 :] & blank[n - 2 : -1])
            ends[last - first :] = False
            found.append((mixed >> np.uint32(32 - BUCKETS.bit_length() + 1))[ends])
    return np.concatenate(found)


def counted(text: str) -> np.ndarray:
    """How often each bucket occurs in the whole text; long texts are counted in stretches of starts, with the
    same result."""
    raw, total = letters(text), np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(raw), _AT_ONCE):
        total += np.bincount(buckets(raw, at, min(at + _AT_ONCE, len(raw))), minlength=BUCKETS)
    return total


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            if lang not in totals:
                totals[lang] = np.zeros(BUCKETS, dtype=np.int64)
            totals[lang] += counted(text)
    for lang, own in totals.items():
        at = np.flatnonzero(own)
        yield pd.DataFrame({"lang": objects([lang] * len(at)), "bucket": at, "n": own[at]})


def codewords(classes: int) -> np.ndarray:
    """One row of bits per class: all distinct splits for up to five, else seeded random ones far apart."""
    if classes <= _MOST_EXHAUSTIVE:
        columns = [[1, *((split >> k) & 1 for k in range(classes - 1))] for split in range((1 << (classes - 1)) - 1)]
        return np.array(columns, dtype=np.int8).T.reshape(classes, -1)
    width, random = 12 * int(np.ceil(np.log2(classes))) + 3, np.random.default_rng(7)
    best, apart = np.zeros((classes, width), dtype=np.int8), -1
    for _ in range(60):
        code = random.integers(0, 2, (classes, width), dtype=np.int8)
        code[:, code.min(axis=0) == code.max(axis=0)] = np.arange(classes)[:, None] % 2
        signs = 2 * code.astype(np.int32) - 1
        distance = ((width - signs @ signs.T) // 2)[~np.eye(classes, dtype=bool)].min()
        if distance > apart:
            best, apart = code, distance
    return best


@dataclass(frozen=True)
class LanguageModel:
    """Languages, their codewords, n-gram weights of each bit's classifier, and the bits' weights."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    trust: np.ndarray

    def decode(self, sums: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language, its score and whether it is ambiguous, from summed n-gram weights."""
        if len(self.languages) < 2:
            return np.zeros(len(sums), int), np.ones(len(sums)), np.zeros(len(sums), bool)
        margins = sums / np.maximum(counts, 1)[:, None]
        signs = 2.0 * self.code - 1
        losses = np.stack([np.logaddexp(0, -margins * row * 4) @ self.trust for row in signs], axis=1)
        scale = np.minimum(counts, _WEIGHTY)[:, None] ** 0.5 * len(self.trust)
        shifted = np.exp(-(losses - losses.min(axis=1, keepdims=True)) * scale)
        scores = shifted / shifted.sum(axis=1, keepdims=True)
        order = np.sort(scores, axis=1)
        return scores.argmax(axis=1), order[:, -1], order[:, -1] - order[:, -2] < AMBIGUOUS


def fit(labelled: DataFrame) -> LanguageModel:
    """Train on all rows of ``text, lang``; rows with a null in either are skipped."""
    own = labelled.filter("text is not null and lang is not null").select(
        F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")
    )
    counted = (
        own.mapInPandas(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    ).toPandas()
    languages = sorted(counted["lang"].unique())
    totals = np.zeros((len(languages), BUCKETS))
    place = {lang: i for i, lang in enumerate(languages)}
    totals[counted["lang"].map(place).to_numpy(int), counted["bucket"].to_numpy(int)] = counted["n"].to_numpy(float)
    if len(languages) < 2:
        return LanguageModel(languages, np.zeros((len(languages), 1)), np.zeros((BUCKETS, 1)), np.ones(1))
    code = codewords(len(languages))
    shares = (totals + 0.5) / (totals + 0.5).sum(axis=1, keepdims=True)
    weights, trust = np.zeros((BUCKETS, code.shape[1])), np.zeros(code.shape[1])
    for bit in range(code.shape[1]):
        one, zero = shares[code[:, bit] == 1].mean(axis=0), shares[code[:, bit] == 0].mean(axis=0)
        weights[:, bit] = np.log(one / zero)
        trust[bit] = ((one - zero) * weights[:, bit]).sum()
    return LanguageModel(languages, code, weights, trust / trust.sum())


def _predict(model: LanguageModel) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            size = len(batch)
            sums, counts = np.zeros((size, model.weights.shape[1])), np.zeros(size)
            lettered = np.zeros(size, dtype=bool)
            for i, text in enumerate(batch["text"]):
                if text is None or not has_letter(text):
                    continue
                lettered[i] = True
                own = counted(text)
                sums[i], counts[i] = own @ model.weights, own.sum()
            best, score, unsure = model.decode(sums, counts)
            names = np.array([*model.languages, UNKNOWN], dtype=object)
            known_language = lettered & (len(model.languages) > 0)
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "lang_pred": objects(names[np.where(known_language, best, len(model.languages))]),
                    "score": np.where(known_language, score, 0.0),
                    "ambiguous": known_language & unsure,
                }
            )

    return run


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, ambiguous``, from its text alone.

    Null texts, texts without a letter, and all texts if nothing was learned get ``und`` and score 0. Ties
    go to the language that sorts first. Repeated rows give repeated results, an empty table an empty one;
    other columns are not looked at.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return own.mapInPandas(
        _predict(model), "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    )


def identify(docs: DataFrame) -> DataFrame:
    """Train on the documents that are not held out, and predict all."""
    return predict(docs, fit(docs.filter(~held_out(F.col("doc_id")))))
