"""Runs (maximal periodic stretches of words) found in an enhanced suffix array of each document.

A run of period q and length L >= max(24, 3q) ends in squares ww whose halves are whole numbers of periods; the longest
one that fits twice has a half of ``LEAST_HALF`` words or more. Its two halves share exactly ``|w|`` words with each
other, so both suffixes lie in one LCP interval of depth ``|w|``, in different children. For every LCP interval of at
least that depth the suffixes of all children but the largest are looked up: suffix i gives a square if ISA[i + depth]
or ISA[i - depth] lies in the interval. Squares are rotated as far as their period holds, reduced to their
primitive period and merged; no tree is built.

Documents are read whole, one at a time inside a task, and nothing is shuffled. A document none of whose
``LEAST_HALF``-word sequences occurs twice has no such interval and gets no suffix array. Memory is some 40 bytes a
word and level of prefix doubling of the longest document.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import objects

LEAST_RUN = 24
LEAST_PERIODS = 3
#: Smallest half, over all periods q, of the longest square of whole periods in a run of max(24, 3q) words.
LEAST_HALF = min(max(LEAST_RUN, LEAST_PERIODS * q) // (2 * q) * q for q in range(1, LEAST_RUN))

RESULT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)

_ODD = np.uint64(0x9E3779B97F4A7C15)


def with_periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, for every tenth id (told by its CRC-32) with a tail that repeats; a null id leaves them alone."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [*words[:a], *(words[a + i % p] for i in range(n - a))]


def repeats_a_half(ids: np.ndarray) -> bool:
    """Whether ``LEAST_HALF`` consecutive words may occur twice: told by hashes, so never wrongly denied."""
    if len(ids) <= LEAST_HALF:
        return False
    spread = ids.astype(np.uint64) * _ODD
    rolled = np.zeros(len(ids) - LEAST_HALF + 1, dtype=np.uint64)
    for k in range(LEAST_HALF):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * _ODD + spread[k : k + len(rolled)]
    rolled.sort()
    return bool((rolled[1:] == rolled[:-1]).any())


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array, its inverse, and LCP with the suffix before, by prefix doubling.

    The ranks of every level are kept, and the LCP of neighbours is read from them level by level.
    """
    n = len(ids)
    rank = np.unique(ids, return_inverse=True)[1].astype(np.int64)
    levels, width = [rank], 1
    order = np.argsort(rank, kind="stable")
    while width < n:
        after = np.zeros(n, dtype=np.int64)
        after[: n - width] = rank[width:] + 1
        pair = rank * (n + 1) + after
        order = np.argsort(pair, kind="stable")
        ranked = pair[order]
        new = np.concatenate(([0], np.cumsum(ranked[1:] != ranked[:-1])))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = new
        width *= 2
        if new[-1] == n - 1:
            break
        levels.append(rank)
    inverse = np.empty(n, dtype=np.int64)
    inverse[order] = np.arange(n)
    left, right = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n, dtype=np.int64)
    for place in range(len(levels) - 1, -1, -1):
        step, of = 1 << place, levels[place]
        inside = (left + step <= n) & (right + step <= n)
        same = inside.copy()
        same[inside] = of[left[inside]] == of[right[inside]]
        lcp[1:][same] += step
        left[same] += step
        right[same] += step
        # a suffix that has ended shares nothing more
        ended = (left >= n) | (right >= n)
        left[ended] = right[ended] = n
    return order, inverse, lcp


def small_children(lcp: list[int], least: int) -> list[tuple[int, int, int, int, int]]:
    """(child first, child last, interval first, interval last, depth) of all children but the largest of every
    LCP interval at least ``least`` deep."""
    found = []
    # an open interval: depth, first place, place where its present child starts, largest closed child, other children
    stack: list[list] = []

    def close(top: list, last: int) -> None:
        depth, first, child, largest, others = top
        others.append(min((child, last), largest, key=lambda c: c[1] - c[0]))
        found.extend((a, b, first, last, depth) for a, b in others)

    for place in range(1, len(lcp) + 1):
        depth = lcp[place] if place < len(lcp) else 0
        first = place - 1
        while stack and stack[-1][0] > depth:
            top = stack.pop()
            close(top, place - 1)
            first = top[1]
        if depth < least:
            continue
        if stack and stack[-1][0] == depth:
            top = stack[-1]
            ended, largest = (top[2], place - 1), top[3]
            if ended[1] - ended[0] > largest[1] - largest[0]:
                top[4].append(largest)
                top[3] = ended
            else:
                top[4].append(ended)
            top[2] = place
        else:
            stack.append([depth, first, place, (first, place - 1), []])
    return found


def squares(ids: np.ndarray, least: int = LEAST_HALF) -> tuple[np.ndarray, np.ndarray]:
    """(start, half) of the branching squares whose half has ``least`` words or more."""
    order, inverse, lcp = suffix_array(ids)
    children = np.array(small_children(lcp.tolist(), least), dtype=np.int64).reshape(-1, 5)
    if not len(children):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    sizes = children[:, 1] - children[:, 0] + 1
    child_first, child_last, first, last, depth = (np.repeat(c, sizes) for c in children.T)
    ahead = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    suffix = order[child_first + np.arange(len(depth)) - np.repeat(ahead, sizes)]
    starts, halves = [], []
    for partner, start in ((suffix + depth, suffix), (suffix - depth, suffix - depth)):
        inside = np.flatnonzero((partner >= 0) & (partner < len(ids)))
        at = inverse[partner[inside]]
        own = (at >= child_first[inside]) & (at <= child_last[inside])
        hit = inside[(at >= first[inside]) & (at <= last[inside]) & ~own]
        starts.append(start[hit])
        halves.append(depth[hit])
    return np.concatenate(starts), np.concatenate(halves)


def _held(ids: np.ndarray, start: int, end: int, period: int) -> tuple[int, int]:
    """The stretch around ``start`` to ``end`` over which the period holds, looked up in doubling steps."""
    step = 64
    while end < len(ids):
        upto = min(len(ids), end + step)
        wrong = np.flatnonzero(ids[end:upto] != ids[end - period : upto - period])
        if len(wrong):
            end += int(wrong[0])
            break
        end, step = upto, 2 * step
    step = 64
    while start > 0:
        back = max(0, start - step)
        wrong = np.flatnonzero(ids[back:start] != ids[back + period : start + period])
        if len(wrong):
            start = back + int(wrong[-1]) + 1
            break
        start, step = back, 2 * step
    return start, end


def _root(block: np.ndarray) -> int:
    """Length of the primitive root."""
    n = len(block)
    for q in range(1, n // 2 + 1):
        if n % q == 0 and np.array_equal(block[q:], block[:-q]):
            return q
    return n


def runs(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least max(24, 3 periods) words, by start, then period.

    Words are given by numbers. Squares are taken from the shortest half up; each is rotated both ways, and
    the squares of whole periods inside the stretch it leads to are merged into it.
    """
    if not repeats_a_half(ids):
        return []
    starts, halves = squares(ids)
    by_half = np.argsort(halves, kind="stable")
    starts, halves = starts[by_half], halves[by_half]
    found = []
    while len(starts):
        start, half = int(starts[0]), int(halves[0])
        period = _root(ids[start : start + half])
        first, end = _held(ids, start, start + 2 * half, period)
        if end - first >= max(LEAST_RUN, LEAST_PERIODS * period):
            found.append((first, end - first, period))
        merged = (starts >= first) & (starts + 2 * halves <= end) & (halves % period == 0)
        starts, halves = starts[~merged], halves[~merged]
    return sorted(found, key=lambda r: (r[0], r[2]))


def numbered(words: list[bytes]) -> np.ndarray:
    """Words as numbers: equal words, and only those, have equal ones."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    return np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words))


def digest(doc_id: int | None, text: bytes) -> tuple:
    words = with_periodic_tail(doc_id, text.split())
    found = runs(numbered(words))
    best: tuple = (None, None, None, None)
    if found:
        start, length, period = found[0]
        for s, l, q in found[1:]:
            if l * period > length * q:
                start, length, period = s, l, q
        best = (start, length, period, 1000 * length // period)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for s, l, q in found:
        change[s + q] += 1
        change[s + l] -= 1
    kept = words if not found else [w for w, inside in zip(words, accumulate(change.tolist())) if not inside]
    listed = "".join(f"{s},{l},{q}\n" for s, l, q in found)
    return (
        doc_id,
        len(found),
        *best,
        hashlib.sha256(listed.encode()).hexdigest(),
        hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [part.split()[0] for part in RESULT.split(", ")]
    for batch in batches:
        ids = [None if i is None else int(i) for i in batch["doc_id"]]
        rows = [digest(i, text) for i, text in zip(ids, batch["text"])]
        columns = zip(*rows) if rows else [[]] * len(names)
        yield pd.DataFrame(
            {
                name: objects(values) if name.endswith("sha256") else pd.array(list(values), dtype="Int64")
                for name, values in zip(names, columns)
            }
        )


def periodic_runs(docs: DataFrame) -> DataFrame:
    """One row per document: number of runs, the run of the greatest exponent, digests of all runs and of the
    text without repeated periods.

    Null and empty texts and texts without words have no run: ``n_runs`` 0, four nulls and the digests of
    nothing. Rows without an id keep their words as they are. Among runs of one exponent the smallest start,
    then the smallest period is shown. Repeated rows give repeated results, an empty table an empty one; columns
    other than ``doc_id`` and ``text`` are not looked at.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    own = docs.select(F.col("doc_id").cast("long").cast("string").alias("doc_id"), text.alias("text"))
    return own.mapInPandas(_digests, RESULT)
