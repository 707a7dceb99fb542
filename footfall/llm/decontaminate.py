"""Benchmark decontamination by latent semantic retrieval.

Benchmark items are cut into chunks of at most 48 words; chunks and passages of documents are TF-IDF vectors
over the items' terms, seen through the leading right singular vectors of a distributed randomised SVD, as many
as the chunks ask for (``rank_for``). Passages are overlapping windows of all texts. A chunk is a candidate in every
window whose cosine with it reaches ``LEAST_COSINE``. The rest is not lost: a match of at least T of a chunk's L words has
h of any L - T + h of them in the window, so windows that hold as many of the chunk's rarest words are candidates
too, whatever their cosine. Candidates are verified by the longest common subsequence of words and, for looser
matches, by a check that the end of the item (its answer) is there too.

Items of fewer than ``LEAST_ITEM`` words are not searched, as their words turn up in clean texts by themselves;
:func:`skipped_items` lists them. Document frequencies and the SVD cover all documents: texts are stored as term
numbers once, counted, multiplied and searched. Items are a stated query set: they are taken in blocks of about
``BLOCK_BYTES`` of text, items longer than half of that in pieces, and a block's matches are stored before the next
block is read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import identified, objects
from footfall.session import cut_lineage, scratch_path, staging

#: Production parameters.
#: Singular vectors per square root of a block's chunks, and the fewest.
RANK_PER_ROOT, LEAST_RANK = 6, 32
LEAST_COSINE = 0.45
LEAST_ITEM = 6
POWER_ROUNDS = 2
BLOCK_BYTES = 1 << 20
LEAST_COMMON = 0.6
LOOSE_COMMON, LEAST_ANSWER = 0.45, 0.8
CHUNK, CHUNK_STEP = 48, 24
#: Characters by which pieces of very long items overlap, and of their end in which the answer is.
OVERLAP = 2_000
#: Share of a match's fewest words that is looked for among the chunk's rarest; any share finds the same matches.
RARE = 0.25
#: Longest chunk, blocks per window, words per block: a window holds any chunk of its scale whole.
SCALES = ((16, 3, 8), (CHUNK, 4, 16))

_AT_ONCE = 50_000  # words searched together
_COLUMNS = 256  # chunks counted together
_PASSAGES = 4_096  # passages multiplied together
_CELLS = 1 << 22  # windows times words looked up together
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def tokens(text: str) -> list[bytes]:
    """Lower-case words without punctuation."""
    return text.lower().encode("utf-8", "replace").translate(_PLAIN).split()


@dataclass(frozen=True)
class Items:
    """A block of benchmark items as chunks of term numbers."""

    terms: dict[bytes, int]
    item_ids: list[int]  # of each chunk
    chunks: list[np.ndarray]
    answers: list[np.ndarray]  # end of each chunk's item


def _answer(text: str) -> list[bytes]:
    sentences = [s for s in text.replace("?", ".").replace("!", ".").replace("\n", ".").split(".") if tokens(s)]
    last = tokens(sentences[-1]) if sentences else []
    return last if len(last) >= 3 else tokens(text)[-5:]


def prepare(rows: list[tuple[int, str]] | list[tuple[int, str, str]]) -> Items:
    """Chunks of the items ``(id, text)`` or of pieces ``(id, text, end of the item)``; items of fewer than
    ``LEAST_ITEM`` words have none."""
    terms: dict[bytes, int] = {}
    item_ids, chunks, answers = [], [], []
    for item_id, text, *end in rows:
        found = tokens(text)
        if len(found) < LEAST_ITEM:
            continue
        words = [terms.setdefault(w, len(terms)) for w in found]
        last = _answer(end[0] if end else text)
        answer = np.array([terms.setdefault(w, len(terms)) for w in last], dtype=np.int64)
        at = 0
        while words:
            item_ids.append(item_id)
            chunks.append(np.array(words[at : at + CHUNK], dtype=np.int64))
            answers.append(answer)
            if at + CHUNK >= len(words):
                break
            at = min(at + CHUNK_STEP, len(words) - CHUNK)
    return Items(terms, item_ids, chunks, answers)


def _numbers(text: str, terms: dict[bytes, int]) -> np.ndarray:
    words = tokens(text)
    return np.fromiter(map(terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))


def numbered(texts: DataFrame, items: Items) -> DataFrame:
    """``doc_id, text_hash, numbers``: the words of every text as term numbers (bytes of int32), -1 for other words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            numbers = [_numbers(text, items.terms).astype(np.int32).tobytes() for text in batch["text"]]
            yield pd.DataFrame(
                {"doc_id": batch["doc_id"].astype("Int64"), "text_hash": batch["text_hash"], "numbers": objects(numbers)}
            )

    return texts.select("doc_id", "text_hash", "text").mapInPandas(run, "doc_id long, text_hash long, numbers binary")


def _rows(batch: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(numbers, dtype=np.int32) for numbers in batch["numbers"]]


def document_frequencies(numbers: DataFrame, items: Items) -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and the number of documents."""
    size = len(items.terms)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, docs = np.zeros(size + 1, dtype=np.int64), 0
        there = np.zeros(size + 1, dtype=bool)  # the last one for words that are no terms
        for batch in batches:
            for own in _rows(batch):
                there[:] = False
                there[own] = True
                total += there
                docs += 1
        total[size] = docs
        yield pd.DataFrame({"term": np.arange(size + 1), "n": total})

    counted = numbers.select("numbers").mapInPandas(count, "term int, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = counted.toPandas().set_index("term")["n"].reindex(range(size + 1), fill_value=0).to_numpy()
    return found[:size], int(found[size])


def idf(frequencies: np.ndarray, docs: int) -> np.ndarray:
    """Inverse document frequencies, at least 1, so that no chunk is without a vector."""
    return np.log((1 + docs) / (1 + frequencies)) + 1


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


def _passages(rows: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Terms of the texts' passages, one after the other, and each passage's number of terms, about ``_PASSAGES`` at once.

    Passages without a term are left out.
    """
    size = SCALES[-1][1] * SCALES[-1][2]
    held: list[np.ndarray] = []
    words = 0

    def cut() -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(part) for part in held])
        count = -(-sizes // size)
        place = np.arange(words) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        passage = np.repeat(np.cumsum(count) - count, sizes) + place // size
        own = np.concatenate(held)
        lengths = np.bincount(passage[own >= 0], minlength=int(count.sum()))
        return own[own >= 0], lengths[lengths > 0]

    for row in rows:
        for low in range(0, len(row), size * _PASSAGES):
            held.append(row[low : low + size * _PASSAGES])
            words += len(held[-1])
            if words >= size * _PASSAGES:
                yield cut()
                held, words = [], 0
    if held:
        yield cut()


def _summed(table: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of rows of a table: the first ``lengths[0]`` of ``ids`` make the first sum, and so on."""
    order = np.argsort(-lengths, kind="stable")
    first, falling = (np.cumsum(lengths) - lengths)[order], -lengths[order]
    out = np.zeros((len(lengths), table.shape[1]), dtype=table.dtype)
    row = np.empty_like(out)
    for k in range(int(lengths.max(initial=0))):  # the k-th row of every sum that has one
        more = int(np.searchsorted(falling, -k))
        np.take(table, ids[first[:more] + k], axis=0, out=row[:more], mode="clip")
        out[:more] += row[:more]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def _passages_times(
    words: np.ndarray, lengths: np.ndarray, weights: np.ndarray, latent: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """AᵀA times a basis for the unit TF-IDF rows A of passages, as terms and their rows without the terms' weights.

    ``latent`` is the basis times the weights.
    """
    order = np.argsort(words.astype(np.min_scalar_type(len(weights))), kind="stable")
    by_term, passage = words[order], np.repeat(np.arange(len(lengths)), lengths)[order]
    starts = np.flatnonzero(np.diff(by_term, prepend=-1) | np.diff(passage, prepend=-1))
    times = np.diff(starts, append=len(words))
    norms = np.bincount(passage[starts], (times * weights[by_term[starts]]) ** 2, minlength=len(lengths))
    ahead = _summed(latent, words, lengths) / norms[:, None].astype(np.float32)
    # a term's passages in stretches as long as a passage, so that frequent terms are summed alongside each other
    first = np.flatnonzero(np.diff(by_term, prepend=-1))
    place = np.arange(len(words)) - np.repeat(first, np.diff(first, append=len(words)))
    stretch = np.flatnonzero(place % (SCALES[-1][1] * SCALES[-1][2]) == 0)
    sums = _summed(ahead, passage, np.diff(stretch, append=len(words)))
    of_term = np.searchsorted(stretch, first)
    return by_term[first], np.add.reduceat(sums, of_term, axis=0)


def _matrix(passages: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, columns and values of unit TF-IDF rows."""
    rows = np.repeat(np.arange(len(passages)), [len(p) for p in passages])
    columns = np.concatenate(passages).astype(np.int64) if passages else np.zeros(0, np.int64)
    key, times = np.unique(rows * len(weights) + columns, return_counts=True)
    rows, columns = key // max(len(weights), 1), key % max(len(weights), 1)
    values = times * weights[columns]
    norms = np.sqrt(np.bincount(rows, values**2, minlength=max(len(passages), 1)))
    return rows, columns, values / np.maximum(norms[rows], 1e-12)


def _gram_times(matrix: tuple[np.ndarray, np.ndarray, np.ndarray], basis: np.ndarray) -> np.ndarray:
    """AᵀA times a basis for sparse A."""
    rows, columns, values = matrix
    out = np.zeros_like(basis)
    if len(rows):
        ahead = np.zeros((rows.max() + 1, basis.shape[1]))
        np.add.at(ahead, rows, values[:, None] * basis[columns])
        np.add.at(out, columns, values[:, None] * ahead[rows])
    return out


def rank_for(chunks: int) -> int:
    """Singular vectors for so many chunks."""
    return max(LEAST_RANK, math.ceil(RANK_PER_ROOT * math.sqrt(chunks)))


def latent_basis(numbers: DataFrame, items: Items, weights: np.ndarray, rank: int | None = None) -> np.ndarray:
    """Leading right singular vectors (terms × rank) of the TF-IDF chunks and passages, by randomised subspace iteration.

    Every round multiplies by AᵀA where the passages of all documents lie: a task sums its own, and a shuffle by term
    adds up the tasks, one to a core, so that it does not grow with the documents. Chunks and passages weigh the same in
    total.
    """
    size = len(weights)
    rank = rank_for(len(items.chunks)) if rank is None else rank
    width = min(size, rank + 16)
    own = _matrix(items.chunks, weights)
    dealt = numbers.select("numbers").coalesce(numbers.sparkSession.sparkContext.defaultParallelism)

    def multiplied(basis: np.ndarray) -> np.ndarray:
        latent = (weights[:, None] * basis).astype(np.float32)

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((size + 1, width))  # the last row counts passages
            for batch in batches:
                for words, lengths in _passages(_rows(batch)):
                    if len(words):
                        terms, rows = _passages_times(words, lengths, weights, latent)
                        total[terms] += rows
                        total[size] += len(lengths)
            found = np.flatnonzero(total.any(axis=1))
            for low in range(0, len(found), 1_000):
                some = found[low : low + 1_000]
                rows = objects(total[t].astype(np.float32).tobytes() for t in some)
                yield pd.DataFrame({"term": some, "task": TaskContext.get().partitionId(), "part": rows})

        def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                for term, row in zip(batch["term"], batch["part"]):
                    totals[term] = totals.get(term, 0.0) + np.frombuffer(row, dtype=np.float32).astype(float)
            rows = objects(row.astype(np.float32).tobytes() for row in totals.values())
            yield pd.DataFrame({"term": pd.Series(list(totals), dtype="int64"), "part": rows})

        parts = dealt.mapInPandas(part, "term int, task int, part binary").repartition("term")
        rest = np.zeros((size + 1, width))
        for r in parts.sortWithinPartitions("term", "task").mapInPandas(added, "term int, part binary").collect():
            rest[r.term] = np.frombuffer(bytes(r.part), dtype=np.float32)
        balance = len(items.chunks) / max(rest[size, 0], 1)
        return _gram_times(own, basis) + balance * weights[:, None] * rest[:size]

    basis = np.linalg.qr(np.random.default_rng(11).standard_normal((size, width)))[0]
    for _ in range(POWER_ROUNDS):
        basis = np.linalg.qr(multiplied(basis))[0]
    small = basis.T @ multiplied(basis)
    strength, turn = np.linalg.eigh((small + small.T) / 2)
    return (basis @ turn[:, np.argsort(-strength)[:rank]]).astype(np.float32)


def common_words(chunk_masks: dict[int, int], length: int, window: list[int]) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    full = (1 << length) - 1
    state = full
    for mask in filter(None, map(chunk_masks.get, window)):
        both = state & mask
        state = ((state + both) | (state - both)) & full
    return length - state.bit_count()


def _masks(words: np.ndarray) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, term in enumerate(words.tolist()):
        masks[term] = masks.get(term, 0) | 1 << i
    return masks


def least_words(length: int) -> int:
    """The shortest subsequence that can make a match of a chunk of this length."""
    return next(k for k in range(length + 1) if k / length >= LOOSE_COMMON)


@dataclass(frozen=True)
class Chunks:
    """Chunks of one scale: for each term the columns of the chunks that count it, and the fewest counted words."""

    mine: np.ndarray
    blocks: int
    step: int
    ends: np.ndarray  # columns of term t lie at ends[t] to ends[t + 1]
    columns: np.ndarray
    fewest: np.ndarray


class Search:
    """Candidate search and verification of one block of items in many texts."""

    def __init__(self, items: Items, weights: np.ndarray, basis: np.ndarray):
        self.items = items
        self.latent = (weights[:, None] * basis).astype(np.float32)
        self.queries = _unit(np.stack([self.latent[c].sum(axis=0) for c in items.chunks]))
        self.scales = []
        shortest = 0
        for longest, blocks, step in SCALES:
            mine = [i for i, c in enumerate(items.chunks) if shortest < len(c) <= longest]
            shortest = longest
            for low in range(0, len(mine), _COLUMNS):
                self.scales.append(self._counted(np.array(mine[low : low + _COLUMNS]), blocks, step, weights))
        self.masks = [_masks(c) for c in items.chunks]
        # distinct words of every chunk, filled up with a number no word has, and how many a match needs
        self.padded = np.full((len(items.chunks), CHUNK), len(weights))
        self.needed = np.zeros(len(items.chunks), dtype=np.int64)
        for i, chunk in enumerate(items.chunks):
            distinct = np.unique(chunk)
            self.padded[i, : len(distinct)] = distinct
            self.needed[i] = least_words(len(chunk)) - (len(chunk) - len(distinct))
        self.answer_masks = [_masks(a) for a in items.answers]

    def _counted(self, mine: np.ndarray, blocks: int, step: int, weights: np.ndarray) -> Chunks:
        terms, columns, fewest = [], [], []
        for column, i in enumerate(mine.tolist()):
            chunk = self.items.chunks[i]
            match = least_words(len(chunk))
            rarest = chunk[np.argsort(-weights[chunk], kind="stable")][: len(chunk) - match + max(1, round(RARE * match))]
            counted = np.unique(rarest)
            terms.append(counted)
            columns.append(np.full(len(counted), column))
            fewest.append(match - int((~np.isin(chunk, counted)).sum()))
        by_term = np.argsort(np.concatenate(terms), kind="stable")
        ends = np.searchsorted(np.concatenate(terms)[by_term], np.arange(len(weights) + 1))
        return Chunks(mine, blocks, step, ends, np.concatenate(columns)[by_term], np.array(fewest, dtype=np.uint8))

    def near(self, own: np.ndarray, at: np.ndarray, s: Chunks) -> tuple[np.ndarray, np.ndarray]:
        """Windows (by number) and columns of the chunks whose cosine reaches ``LEAST_COSINE``; ``own`` are known words."""
        block = at // s.step
        first = np.flatnonzero(np.diff(block, prepend=-1))
        words = np.diff(first, append=len(block))
        sums = np.zeros((int(block[-1]) + 2 * s.blocks, self.latent.shape[1]), dtype=np.float32)
        full = self.latent[own[first]]
        for k in range(1, int(words.max())):  # the k-th known word of every block that has one
            more = np.flatnonzero(words > k)
            full[more] += self.latent[own[first[more] + k]]
        sums[block[first] + s.blocks - 1] = full
        count = len(sums) - s.blocks + 1
        windows = sums[:count].copy()
        for k in range(1, s.blocks):
            windows += sums[k : k + count]
        cosines = windows @ self.queries[s.mine].T
        reach = LEAST_COSINE * np.sqrt(np.einsum("ij,ij->i", windows, windows))
        return np.nonzero(cosines >= np.maximum(reach, 1e-6)[:, None])

    def holding(
        self, own: np.ndarray, at: np.ndarray, s: Chunks, row: np.ndarray, column: np.ndarray
    ) -> np.ndarray:
        """Which of the windows, given in order, have enough of their chunk's words for a match."""
        found = np.zeros(len(row), dtype=bool)
        block, wanted = at // s.step, s.mine[column]
        windows, first = np.unique(row, return_index=True)
        step = max(1, _CELLS // (len(self.latent) + 1))
        for low in range(0, len(windows), step):
            some = windows[low : low + step]
            place = np.full(int(some[-1]) + 1, -1)
            place[some] = np.arange(len(some))
            there = np.zeros((len(some), len(self.latent) + 1), dtype=bool)
            start, end = np.searchsorted(block, (some[0] - s.blocks + 1, some[-1] + 1))
            for k in range(s.blocks):
                window = block[start:end] + k
                inside = window < len(place)
                at_row = place[window[inside]]
                there[at_row[at_row >= 0], own[start:end][inside][at_row >= 0]] = True
            upto = first[low + step] if low + step < len(first) else len(row)
            mine = slice(first[low], upto)
            cells = self.padded[wanted[mine]] + (place[row[mine]] * there.shape[1])[:, None]
            held = there.ravel().take(cells, mode="clip").sum(axis=1, dtype=np.uint8)  # CHUNK words at most
            found[mine] = held >= self.needed[wanted[mine]]
        return found

    def counted(self, own: np.ndarray, at: np.ndarray, s: Chunks) -> tuple[np.ndarray, np.ndarray]:
        """Windows (by number) and columns of the chunks that may have a match there, by their rarest words."""
        times = s.ends[own + 1] - s.ends[own]
        words = np.flatnonzero(times)
        if not len(words):
            return words, words
        times = times[words]
        block = at[words] // s.step + s.blocks - 1
        width, size = len(s.mine), int(block[-1]) + s.blocks + 1
        place = np.arange(times.sum()) + np.repeat(s.ends[own[words]] - np.cumsum(times) + times, times)
        cells = np.repeat(block * width, times) + s.columns[place]
        counts = np.bincount(cells, minlength=size * width).astype(np.uint8).reshape(size, width)
        count = size - s.blocks + 1
        windows = counts[:count].copy()
        for k in range(1, s.blocks):
            windows += counts[k : k + count]
        return np.nonzero(windows >= s.fewest)

    def candidates(
        self, own: np.ndarray, at: np.ndarray, ways: tuple[str, ...] = ("near", "counted")
    ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """Window starts and the chunks that are compared there, window by window; ``at`` are the words' places."""
        known = np.flatnonzero(own >= 0)
        if not len(known):
            return
        for s in self.scales:
            found = [getattr(self, way)(own[known], at[known], s) for way in ways]
            cells = np.unique(np.concatenate([row * len(s.mine) + column for row, column in found]))
            row, column = np.divmod(cells, len(s.mine))
            keep = self.holding(own[known], at[known], s, row, column)
            row, column = row[keep], column[keep]
            yield (row - (s.blocks - 1)) * s.step, s.mine[column], s.blocks * s.step

    def run(
        self, texts: list[str], ways: tuple[str, ...] = ("near", "counted")
    ) -> list[tuple[int, int, float, float, float]]:
        """Confirmed (text, item, common, answer, cosine), the best of each text and item."""
        return self.run_numbers((_numbers(text, self.items.terms) for text in texts), ways)

    def run_numbers(
        self, rows: Iterable[np.ndarray], ways: tuple[str, ...] = ("near", "counted")
    ) -> list[tuple[int, int, float, float, float]]:
        """:meth:`run` of texts that are term numbers already."""
        best: dict[tuple[int, int], tuple[float, float, float]] = {}
        gap = max(blocks * step for _, blocks, step in SCALES)
        waiting: list[tuple[int, np.ndarray]] = []
        words = 0

        def flush() -> None:
            starts = np.cumsum([0] + [-(-len(o) // gap) * gap + gap for _, o in waiting])
            own = np.concatenate([o for _, o in waiting])
            at = np.concatenate([s + np.arange(len(o)) for s, (_, o) in zip(starts, waiting)])
            for begins, chunks, width in self.candidates(own, at, ways):
                texts_at = np.searchsorted(starts[:-1], begins + width - 1, side="right") - 1
                before = None
                for begin, chunk, k in zip(begins.tolist(), chunks.tolist(), texts_at.tolist()):
                    place, numbers = waiting[k]
                    if begin != before:  # candidates come window by window
                        low = begin - int(starts[k])
                        window = numbers[max(low, 0) : max(low + width, 0)]
                        window, before = window[window >= 0].tolist(), begin
                    self._verify(best, place, window, chunk)

        for place, numbers in enumerate(rows):
            for low in range(0, len(numbers), _AT_ONCE):
                waiting.append((place, numbers[low : low + _AT_ONCE + gap]))
                words += len(waiting[-1][1])
                if words >= _AT_ONCE:
                    flush()
                    waiting.clear()
                    words = 0
        if waiting:
            flush()
        return [(place, item, *found) for (place, item), found in best.items()]

    def _cosine(self, window: list[int], chunk: int) -> float:
        total = self.latent[window].sum(axis=0)
        return float(total @ self.queries[chunk] / max(np.linalg.norm(total), 1e-6))

    def _verify(self, best: dict, place: int, window: list[int], chunk: int) -> None:
        length = len(self.items.chunks[chunk])
        common = common_words(self.masks[chunk], length, window) / length
        if common < LOOSE_COMMON:
            return
        answer = self.items.answers[chunk]
        there = common_words(self.answer_masks[chunk], len(answer), window) / len(answer)
        if common >= LEAST_COMMON or there >= LEAST_ANSWER:
            key = (place, self.items.item_ids[chunk])
            best[key] = max(best.get(key, (0.0, 0.0, -1.0)), (common, there, self._cosine(window, chunk)))


def _scan(search: Search) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = search.run_numbers(own.astype(np.int64) for own in _rows(batch))
            places = [f[0] for f in found]
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].iloc[places].array,
                    "text_hash": batch["text_hash"].iloc[places].array,
                    "item_id": pd.array([f[1] for f in found], dtype="Int64"),
                    "common": [f[2] for f in found],
                    "answer": [f[3] for f in found],
                    "cosine": [f[4] for f in found],
                }
            )

    return run


_FOUND = "doc_id long, text_hash long, item_id long, common double, answer double, cosine double"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Confirmed matches: ``doc_id, text_hash, item_id, common, answer, cosine``, one row per document and item.

    Items of fewer than ``LEAST_ITEM`` words are not searched.

    ``common`` is the share of the item's (or chunk's) words in the longest common subsequence, ``answer``
    that of its last sentence. Null and empty texts and items match nothing; repeated rows match alike; an
    empty table on either side gives an empty result; other columns are not looked at. Ties between windows
    go to the larger shares.
    """
    texts = identified(docs)
    pieces = _pieces(benchmark)
    size = pieces.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    spark = docs.sparkSession
    result = spark.createDataFrame([], _FOUND)
    for block in range(blocks):
        rows = pieces.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text", "end")
        items = prepare([tuple(r) for r in rows.collect()])
        if not items.chunks:
            continue
        path = scratch_path(spark, "matches")
        with staging(spark):  # a block's numbers go before the next block's are made
            numbers = cut_lineage(numbered(texts, items))
            frequencies, count = document_frequencies(numbers, items)
            weights = idf(frequencies, count)
            search = Search(items, weights, latent_basis(numbers, items, weights))
            numbers.mapInPandas(_scan(search), _FOUND).write.parquet(path)
        result = result.unionByName(spark.read.schema(_FOUND).parquet(path))
    if blocks == 1:
        return result
    shares = F.struct("common", "answer", "cosine")
    best = result.groupBy("doc_id", "text_hash", "item_id").agg(F.max(shares).alias("best"), F.count("*").alias("n"))
    return best.select("doc_id", "text_hash", "item_id", "best.*")


def _pieces(benchmark: DataFrame) -> DataFrame:
    """``item_id, text, end`` of the items, those longer than half a block in overlapping pieces."""
    step = BLOCK_BYTES // 2 // 4
    text = F.col("text").cast("string")
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.char_length(text) - 1) / step), F.lit(0)).cast("int"))
    return (
        benchmark.filter("text is not null")
        .select(F.col("item_id").cast("long").alias("item_id"), text.alias("text"), F.explode(starts).alias("piece"))
        .select(
            "item_id",
            F.substring("text", F.col("piece") * step + 1, F.lit(step + OVERLAP)).alias("text"),
            F.right("text", F.lit(OVERLAP)).alias("end"),
        )
    )


def skipped_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, words`` of the items that are too short to be searched, null ones included."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            words = [0 if t is None else len(tokens(t)) for t in batch["text"]]
            yield pd.DataFrame({"item_id": batch["item_id"].astype("Int64"), "words": words})

    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return own.mapInPandas(count, "item_id long, words int").filter(F.col("words") < LEAST_ITEM)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a confirmed match, with all their columns."""
    marked = cut_lineage(contaminated(docs, benchmark).select("doc_id", "text_hash").distinct()).withColumnsRenamed(
        {"doc_id": "_id", "text_hash": "_hash"}
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("_doc"),
        F.xxhash64(text).alias("_text"),
    )
    same = F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    return row.join(marked, same, "left_anti").select(*[F.col("_row")[c].alias(c) for c in docs.columns])
