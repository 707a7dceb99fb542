"""Personal data in texts: fixed patterns, and a linear-chain conditional random field over word shapes.

The field is trained from a small labelled table of word windows and decoded by Viterbi in numpy batches. The table
holds windows of documents, labelled by the fixed patterns, and written variants that the patterns miss, beside
look-alikes such as dates, versions and prices. A shape keeps the lengths of digit runs and all punctuation; its
features (:func:`features`) are shared by shapes that were never seen, and count for the word itself, its left and
its right neighbour. Texts are decoded whole: words whose emission rules every other tag out whatever their
neighbours are (a bound from the learned transitions) cut a text into short runs, and the runs of a batch are
decoded together, which gives the same tags as decoding each text in one go.
"""

from __future__ import annotations

import bisect
import functools
import random
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import bounded_sample, objects, span_digest, span_text
from footfall.session import cut_lineage

Span = tuple[str, int, int]

# Kinds and their patterns.
KINDS = ("email", "ip", "card", "phone")
TAGS = ("none", *KINDS)
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (13, 19), (9, 15)

#: Production parameters: documents and word windows that the field is trained on, and its training.
SAMPLE_DOCS = 3_000
WINDOWS = 2_000
SIDE = 3
ROUNDS = 120
PENALTY = 0.02
VARIANTS = 2_000  # written variants and look-alikes in the labelled table
MOST_SHAPES = 20_000  # shapes whose weights a task remembers

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGIT = re.compile(r"[0-9]")
_CACHED_WORDS = 300_000
_TEXTS = 1_000  # texts decoded together


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def valid(kind: str, text: str) -> bool:
    """Whether a match of a kind's pattern holds."""
    if kind == "ip":
        return all(int(part.lstrip("0")[:4] or 0) <= 255 for part in text.split("."))
    if kind == "card":
        digits = _digits(text)
        return CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits)
    if kind == "phone":
        return PHONE_DIGITS[0] <= len(_digits(text)) <= PHONE_DIGITS[1]
    return True


def emails(text: str) -> list[Span]:
    """Leftmost matches of local part, at sign and dotted domain, found from the at signs.

    A local part reaches back to the last character that cannot be in it, or to the match before.
    """
    found, after = [], 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > after and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            found.append(("email", start, m.end()))
            after = m.end()
    return found


def base_spans(text: str) -> dict[str, list[Span]]:
    """Matches of the fixed patterns by kind; matches that fail their check are dropped."""
    found: dict[str, list[Span]] = {kind: [] for kind in KINDS}
    if "@" in text:
        found["email"] = emails(text)
    if _DIGIT.search(text):
        for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
            found[kind] = [
                (kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(kind, m.group())
            ]
    return found


def in_order(spans: list[Span]) -> list[Span]:
    """By kind as listed, then start."""
    place = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(spans, key=lambda s: (place.get(s[0], len(KINDS)), s[0], s[1], s[2]))


# Bytes by class: letters (all of UTF-8's longer characters count as small ones), digits, and the rest as it is.
_CLASSES = bytes(
    b"X"[0] if 65 <= b <= 90 else b"x"[0] if 97 <= b <= 122 or b >= 128 else b"0"[0] if 48 <= b <= 57 else b
    for b in range(256)
)
_RUNS = re.compile(rb"X+|x+|0+|.", re.S)
_LONG = 200


def classes(text: str) -> list[bytes]:
    """The words of a text, each character replaced by its class."""
    return text.encode("utf-8", "replace").translate(_CLASSES).split()


def shape(word: bytes) -> str:
    """Shape of a word of classes: runs of letters as X or x, digit runs with their length, the rest as it is.

    Words are read whole; those of more than ``_LONG`` bytes are not remembered.
    """
    return _shape(word) if len(word) <= _LONG else _shape.__wrapped__(word)


@functools.lru_cache(maxsize=100_000)
def _shape(word: bytes) -> str:
    parts = [f"d{min(len(r), 20)}" if r[:1] == b"0" else chr(r[0]) for r in _RUNS.findall(word)]
    return "".join(p for i, p in enumerate(parts) if i == 0 or p != parts[i - 1])


_PART = re.compile(r"d[0-9]+|[xX]|[^xXd]", re.S)


def features(shape_: str) -> list[str]:
    """What a shape is made of: itself, digit runs and what joins them, its ends, letters, and at signs."""
    parts = _PART.findall(shape_)
    runs = [int(p[1:]) for p in parts if p[0] == "d"]
    found = [f"first {parts[0][0]}", f"last {parts[-1][0]}"] if parts else []
    if len(shape_) <= 40:
        found.append(f"shape {shape_}")
    if any(p in "xX" for p in parts):
        found.append("letters" if runs else "only letters")
    if runs:
        inner = parts[next(i for i, p in enumerate(parts) if p[0] == "d") :]
        joins = {p for p in inner if p[0] not in "dxX"}
        found += [
            f"runs {'-'.join(map(str, runs[:8]))}",
            f"run count {min(len(runs), 8)}",
            f"digits {min(sum(runs), 20)}",
            f"longest {min(max(runs), 12)}",
            f"joined by {''.join(sorted(joins))[:6]}",
        ]
    if "@" in shape_:
        name, _, domain = shape_.partition("@")
        found += ["at", f"at {bool(name)} {domain[:1].isalnum()} {'.' in domain} {shape_.count('@')}"]
    if re.search(r"[\[({](x|X|\.|@)[\])}]", shape_):
        found += ["written out", f"written out {'x' in shape_ or 'X' in shape_} {bool(runs)}"]
    return found


class Made:
    """Seeded variants of personal data that the fixed patterns miss, and look-alikes, as words with their tag."""

    def __init__(self, seed: int | str) -> None:
        self.own = random.Random(seed)

    def number(self, *sizes: int) -> list[str]:
        return ["".join(self.own.choice("0123456789") for _ in range(n)) for n in sizes]

    def name(self) -> str:
        return "".join(self.own.choice("abcdefghijklmnoprstuvwyz") for _ in range(self.own.randint(2, 9)))

    def card_digits(self) -> str:
        found = self.own.choice("3456") + "".join(self.number(14))
        return found + next(c for c in "0123456789" if luhn(found + c))

    def phone(self) -> str:
        sizes = self.own.choice(((3, 3, 4), (3, 4, 4), (4, 3, 4), (2, 4, 4), (5, 6), (3, 3, 3), (2, 3, 3, 2), (1, 3, 3, 4)))
        parts = self.number(*sizes)
        join = self.own.choice(("-", ".", " ", " ", "/"))
        way = self.own.randrange(5)
        if way == 0:
            return f"({parts[0]}) " + join.join(parts[1:])
        if way == 1:
            return f"({parts[0]})" + join.join(parts[1:])
        return join.join(parts)

    def card(self) -> str:
        digits = self.card_digits()
        parts = [digits[i : i + 4] for i in range(0, 16, 4)]
        if self.own.random() < 0.2:
            parts = [digits[:4], digits[4:10], digits[10:]]
        return self.own.choice((".", "/", "_", "\u2013", ":", " - ", ",")).join(parts)

    def ip(self) -> str:
        parts = [str(self.own.randint(0, self.own.choice((9, 99, 255, 255)))) for _ in range(4)]
        way = self.own.randrange(4)
        if way == 0:
            return "[.]".join(parts)
        if way == 1:
            return ".".join(parts[:3]) + "[.]" + parts[3]
        return self.own.choice(("(.)", "{.}")).join(parts)

    def email(self) -> str:
        name, host = self.own.choice((self.name(), f"{self.name()}.{self.name()}", f"{self.name()}{self.own.randint(1, 99)}")), self.name()
        way = self.own.randrange(5)
        if way == 0:
            return f"{name}@{host}"
        if way == 1:
            return f"{name}@{host[:2]}\u00fc{host[2:]}.{self.name()[:3]}"
        at = self.own.choice(("[at]", "(at)", "{at}", "[@]", "(@)"))
        return f"{name}{at}{host}{self.own.choice(('.', '[.]', '(.)'))}{self.name()[:3]}"

    def alike(self) -> str:
        own, n = self.own, self.own.randint
        return own.choice(
            (
                lambda: f"{n(1900, 2040)}-{n(1, 12):02d}-{n(1, 28):02d}",
                lambda: f"{n(1, 28):02d}.{n(1, 12):02d}.{n(1900, 2040)}",
                lambda: f"{n(1, 12)}/{n(1, 28)}/{n(1900, 2040)}",
                lambda: f"{n(0, 23):02d}:{n(0, 59):02d}:{n(0, 59):02d}",
                lambda: f"{n(1900, 2040)}-{n(1, 12):02d}-{n(1, 28):02d} {n(0, 23):02d}:{n(0, 59):02d}:{n(0, 59):02d}",
                lambda: f"{n(1900, 2040)}-{n(1, 12):02d}-{n(1, 28):02d}T{n(0, 23):02d}:{n(0, 59):02d}:{n(0, 59):02d}Z",
                lambda: f"{n(1700, 2040)}-{n(1700, 2040)}",
                lambda: f"{n(1, 30)}.{n(0, 30)}.{n(0, 99)}",
                lambda: f"v{n(1, 30)}.{n(0, 30)}",
                lambda: f"978-{n(0, 9)}-{n(10, 99)}-{n(100000, 999999)}-{n(0, 9)}",
                lambda: f"{n(1, 999)},{n(0, 999):03d},{n(0, 999):03d}.{n(0, 99):02d}",
                lambda: f"{n(1, 99)}.{n(0, 9999):04d}",
                lambda: f"{n(0, 10**12)}",
                lambda: f"{n(1, 999)}-{n(1, 999)}",
                lambda: f"({n(1, 9999)})",
                lambda: f"[{n(1, 99)}] {n(1, 99)}:{n(1, 99)}",
                lambda: f"{n(1, 99)} {n(1, 99)} {n(1, 99)} {n(1, 99)}",
                lambda: f"{n(10000, 99999)} {n(1900, 2040)}",
                lambda: f"{self.name()}[{n(0, 99)}]",
                lambda: f"({self.name()})",
                lambda: f"{self.name()}({self.name()})",
                lambda: f"@{self.name()}",
                lambda: f"{self.name()}@",
                lambda: f"{n(1, 99)}x{n(1, 99)}x{n(1, 99)}",
                lambda: f"{self.name()}/{self.name()}.{self.name()[:3]}?id={n(1, 99999)}",
                lambda: f"-{n(1, 99)}.{n(0, 999999):06d},{n(1, 99)}.{n(0, 999999):06d}",
            )
        )()

    def example(self) -> tuple[str, str]:
        kind = self.own.choice((*KINDS, "none", "none", "none"))
        return (kind, self.alike() if kind == "none" else getattr(self, kind)())

    def window(self, side: int = SIDE) -> tuple[list[str], list[int]]:
        """Words and tags of an example between ordinary words; a variant that the patterns find is drawn anew."""
        kind, found = self.example()
        while kind != "none" and any(base_spans(found).values()):
            kind, found = self.example()
        ordinary = [self.own.choice(("{}", "{}", "{}", "{},", "{}.", "{}:", "({}", "{})")) for _ in range(2 * side)]
        around = [w.format(self.name().title() if self.own.random() < 0.2 else self.name()) for w in ordinary]
        words = (found + self.own.choice(("", "", "", ".", ",", ")"))).split()
        before, after = around[: self.own.randint(0, side)], around[side : side + self.own.randint(0, side)]
        return [*before, *words, *after], [0] * len(before) + [TAGS.index(kind)] * len(words) + [0] * len(after)


def variant_windows(rows: int = VARIANTS, seed: int | str = "train") -> pd.DataFrame:
    """The part of the labelled table that is written out: ``shapes, tags, n``."""
    made, counted = Made(seed), Counter()
    for _ in range(rows):
        words, tags = made.window()
        counted[tuple(shape(classes(w)[0]) for w in words), tuple(tags)] += 1
    return pd.DataFrame([(list(a), list(b), n) for (a, b), n in counted.items()], columns=["shapes", "tags", "n"])


def labelled_windows(
    docs: DataFrame, sample_docs: int = SAMPLE_DOCS, windows: int = WINDOWS, side: int = SIDE
) -> DataFrame:
    """The labelled table: ``shapes, tags, n`` of at most ``windows`` distinct word windows of ``sample_docs`` documents.

    Windows are ``side`` words to both sides of every word with a digit or an at sign, and of every seventh
    word; a word is tagged with the kind of the fixed pattern that matches in it. ``n`` counts equal windows.
    Documents are those with the smallest hashes of their ids, half of the windows the most frequent ones
    with tags, half the most frequent ones without.
    """

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows: Counter = Counter()
            for text in batch["text"]:
                spans = sorted((s, e, k) for k, found in base_spans(text).items() for _, s, e in found)
                words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
                shapes = [shape(word) for word in classes(text)]
                tags = [0] * len(words)
                ends = [e for _, e in words]
                for start, end, kind in spans:
                    i = bisect.bisect_right(ends, start)
                    while i < len(words) and words[i][0] < end:
                        tags[i] = TAGS.index(kind)
                        i += 1
                centres = [i for i, x in enumerate(shapes) if _DIGIT.search(x) or "@" in x]
                centres += list(range(side, len(words), 7))
                for i in centres:
                    low = max(0, i - side)
                    rows[tuple(shapes[low : i + side + 1]), tuple(tags[low : i + side + 1])] += 1
            yield pd.DataFrame([(a, b, n) for (a, b), n in rows.items()], columns=["shapes", "tags", "n"])

    chosen = bounded_sample(docs, sample_docs)
    found = chosen.select("text").mapInPandas(label, "shapes array<string>, tags array<int>, n long")
    ranked = cut_lineage(found.groupBy("shapes", "tags").agg(F.sum("n").alias("n")))
    tagged = F.exists("tags", lambda t: t > 0)
    order = [F.col("n").desc(), F.xxhash64("shapes", "tags")]
    halves = [ranked.filter(which).orderBy(*order).limit(windows // 2) for which in (tagged, ~tagged)]
    return halves[0].unionByName(halves[1])


@dataclass
class Field:
    """Weights of the chain: per shape for the word itself, its left and right neighbour; transitions.

    A shape weighs what its features weigh; shapes met later are added by :meth:`knowing`.
    """

    shapes: dict[str, int]
    weights: np.ndarray  # 3 × (features + 1) × tags; the last row stands for unseen shapes
    moves: np.ndarray
    parts: dict[str, int] = field(default_factory=dict)
    shared: np.ndarray | None = None  # 3 × features × tags
    lead: np.ndarray = field(init=False)  # weights over those of no tag
    pull: np.ndarray = field(init=False)  # per tag, the most that its neighbours' tags can add over no tag
    may_open: np.ndarray = field(init=False)  # per shape, whether some neighbours let it have a tag

    def __post_init__(self) -> None:
        self.lead = (self.weights - self.weights[:, :, :1])[:, :, 1:]
        into = (self.moves[:, 1:] - self.moves[:, :1]).max(axis=0)
        out_of = (self.moves[1:] - self.moves[:1]).max(axis=1)
        self.pull = np.maximum(into, 0) + np.maximum(out_of, 0)
        around = self.lead[1].max(axis=0) + self.lead[2].max(axis=0) + self.pull
        self.may_open = (self.lead[0] + around).max(axis=1) >= 0

    def place(self, word: bytes) -> int:
        return self.shapes.get(shape(word), len(self.shapes))

    def knowing(self, shapes: list[str]) -> Field:
        """The field with further shapes, whose places follow those of the known ones."""
        if not shapes or self.shared is None:
            return self
        known, more = len(self.shapes), np.zeros((3, len(shapes), len(TAGS)))
        for i, name in enumerate(shapes):
            at = [self.parts[f] for f in features(name) if f in self.parts]
            more[:, i] = self.shared[:, at].sum(axis=1)
        weights = np.concatenate([self.weights[:, :known], more, self.weights[:, known:]], axis=1)
        places = {**self.shapes, **{name: known + i for i, name in enumerate(shapes)}}
        return Field(places, weights, self.moves, self.parts, self.shared)


def emissions(weights: np.ndarray, own: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return weights[0][own] + weights[1][left] + weights[2][right]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(table: pd.DataFrame, rounds: int = ROUNDS, penalty: float = PENALTY) -> Field:
    """Fit the field to the labelled windows by gradient ascent on the penalised conditional likelihood."""
    table = table[table["shapes"].map(len) > 0]
    names = sorted({s for row in table["shapes"] for s in row})
    shapes = {name: i for i, name in enumerate(names)}
    unseen, edge, tags = len(names), len(names) + 1, len(TAGS)
    rows, width = len(table), max((len(r) for r in table["shapes"]), default=1)
    own = np.full((rows, width + 2), edge)
    gold = np.zeros((rows, width), dtype=int)
    mask = np.zeros((rows, width), dtype=bool)
    for i, (row, labels) in enumerate(zip(table["shapes"], table["tags"])):
        own[i, 1 : len(row) + 1] = [shapes[s] for s in row]
        gold[i, : len(row)] = labels
        mask[i, : len(row)] = True
    left, centre, right = own[:, :-2], own[:, 1:-1], own[:, 2:]
    known = [features(name) for name in names]
    times_seen = Counter(f for found in known for f in found)
    parts = {f: i for i, f in enumerate(sorted(times_seen))}
    holds = np.zeros((len(names) + 2, len(parts)))
    for i, found in enumerate(known):
        holds[i, [parts[f] for f in found]] = 1
    shared, moves = np.zeros((3, len(parts), tags)), np.zeros((tags, tags))
    weights = np.zeros((3, len(names) + 2, tags))
    steps = [np.zeros_like(shared), np.zeros_like(moves)]
    truth, true_moves = np.zeros_like(weights), np.zeros_like(moves)
    times = table["n"].to_numpy(float)
    weighed = mask * times[:, None]
    hot = np.eye(tags)[gold] * weighed[..., None]
    for part, at in enumerate((centre, left, right)):
        np.add.at(truth[part], at, hot)
    both = mask[:, 1:] & mask[:, :-1]
    np.add.at(true_moves, (gold[:, :-1][both], gold[:, 1:][both]), weighed[:, 1:][both])
    for _ in range(rounds if rows else 0):
        weights = holds @ shared
        scores = emissions(weights, centre, left, right)
        forward, backward = np.zeros_like(scores), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0]
        for t in range(1, width):
            ahead = _log_sum(forward[:, t - 1, :, None] + moves, 1) + scores[:, t]
            forward[:, t] = np.where(mask[:, t, None], ahead, forward[:, t - 1])
        for t in range(width - 2, -1, -1):
            behind = _log_sum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], 2)
            backward[:, t] = np.where(mask[:, t + 1, None], behind, 0)
        total = _log_sum(forward[:, -1], 1)
        belief = np.exp(forward + backward - total[:, None, None]) * weighed[..., None]
        expected = np.zeros_like(weights)
        for part, at in enumerate((centre, left, right)):
            np.add.at(expected[part], at, belief)
        pairs = forward[:, :-1, :, None] + moves + (scores + backward)[:, 1:, None, :] - total[:, None, None, None]
        expected_moves = (np.exp(np.minimum(pairs, 0)) * (both * times[:, None])[..., None, None]).sum(axis=(0, 1))
        for value, step, gradient in (
            (shared, steps[0], holds.T @ (truth - expected) - penalty * shared),
            (moves, steps[1], true_moves - expected_moves - penalty * moves),
        ):
            step += gradient**2
            value += 0.5 * gradient / np.sqrt(step + 1e-8)
    weights = holds @ shared
    weights[:, unseen] = weights[:, edge] = 0
    return Field(shapes, weights, moves, parts, shared)


def viterbi(scores: np.ndarray, lengths: np.ndarray, first: np.ndarray, last: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best tags of padded runs; ``first`` and ``last`` are added to the scores at their ends."""
    rows, width, tags = scores.shape
    best = scores[:, 0] + first
    back = np.zeros((rows, width, tags), dtype=np.int8)
    final = np.where((lengths == 1)[:, None], best + last, 0)
    for t in range(1, width):
        ways = best[:, :, None] + moves
        back[:, t] = ways.argmax(axis=1)
        best = ways.max(axis=1) + scores[:, t]
        final = np.where((lengths == t + 1)[:, None], best + last, final)
    tagged = np.zeros((rows, width), dtype=np.int8)
    here = final.argmax(axis=1)
    everyone = np.arange(rows)
    for t in range(width - 1, -1, -1):
        inside = t < lengths
        tagged[inside, t] = here[inside]
        if t:
            here = np.where(inside, back[everyone, t, here], here)
    return tagged


def decode(field_: Field, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Tags of all words of a batch; ``own`` are shape places, ``starts`` where each text begins."""
    size = len(own)
    tags = np.zeros(size, dtype=np.int8)
    if not size:
        return tags  # an empty batch
    edge = len(field_.shapes) + 1
    begins = np.zeros(size + 1, dtype=bool)
    begins[starts[starts < size]] = True
    begins[size] = True
    left = np.where(begins[:-1], edge, np.concatenate([[edge], own[:-1]]))
    right = np.where(begins[1:], edge, np.concatenate([own[1:], [edge]]))
    open_ = field_.may_open[own]
    some = np.flatnonzero(open_)
    gain = field_.lead[0][own[some]] + field_.lead[1][left[some]] + field_.lead[2][right[some]]
    open_[some] = (gain + field_.pull).max(axis=1) >= 0
    runs = np.flatnonzero(open_ & ~(np.concatenate([[False], open_[:-1]]) & ~begins[:-1]))
    if not len(runs):
        return tags
    closes = np.flatnonzero(open_ & ~(np.concatenate([open_[1:], [False]]) & ~begins[1:])) + 1
    lengths = closes - runs
    for bucket in np.unique(np.ceil(np.log2(lengths)).astype(int)):
        mine = np.flatnonzero(np.ceil(np.log2(lengths)).astype(int) == bucket)
        width = int(lengths[mine].max())
        for part in np.array_split(mine, max(1, len(mine) * width // 2_000_000)):
            at = np.minimum(runs[part][:, None] + np.arange(width), size - 1)
            scores = emissions(field_.weights, own[at], left[at], right[at])
            opens, ends = begins[runs[part]], begins[closes[part]]
            first = np.where(opens[:, None], 0.0, field_.moves[0][None, :])
            last = np.where(ends[:, None], 0.0, field_.moves[:, 0][None, :])
            found = viterbi(scores, lengths[part], first, last, field_.moves)
            inside = np.arange(width) < lengths[part][:, None]
            tags[at[inside]] = found[inside]
    return tags


class Places:
    """Shape places of the words met so far, and the field that knows them; both start anew when they are full."""

    def __init__(self, field_: Field):
        self.trained = self.field = field_
        self.words: dict[bytes, int] = {}

    def of(self, texts: Iterable[list[bytes]]) -> list[np.ndarray]:
        """Places of the words of a batch of texts, taken one by one; shapes they bring are added at the end."""
        if len(self.field.shapes) >= MOST_SHAPES + len(self.trained.shapes):
            self.field, self.words = self.trained, {}
        known, fresh, found = self.field.shapes, {}, []
        for words in texts:
            if len(self.words) >= _CACHED_WORDS:
                self.words.clear()
            for word in set(words).difference(self.words):
                name = shape(word)
                place = known.get(name)
                if place is None:
                    place = len(known) if self.field.shared is None else fresh.setdefault(name, len(known) + len(fresh))
                self.words[word] = place
            found.append(np.fromiter(map(self.words.__getitem__, words), dtype=np.int32, count=len(words)))
        self.field = self.field.knowing(list(fresh))
        return found


_EDGES = re.compile(r"[+(]?[A-Za-z0-9].*[A-Za-z0-9]|[A-Za-z0-9]", re.S)


def field_spans(text: str, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans the field adds: runs of one tag that no base span touches and that hold like base matches.

    They get the kinds ``crf_email`` and so on.
    """
    words = [(m.start(), m.end()) for m in _WORD.finditer(text)]
    added, i = [], 0
    while i < len(tags):
        j = i
        while j < len(tags) and tags[j] == tags[i]:
            j += 1
        if tags[i]:
            kind, low, high = TAGS[tags[i]], words[i][0], words[j - 1][1]
            inner = _EDGES.search(text[low:high])
            if inner and _holds(kind, inner.group()):
                start, end = low + inner.start(), low + inner.end()
                if not any(s < end and start < e for _, s, e in base):
                    added.append((f"crf_{kind}", start, end))
        i = j
    return added


_AT = re.compile(r"@|[\[({](?:at|@)[\])}]", re.I)
_DOT = re.compile(r"[\[({]\.[\])}]")


def _holds(kind: str, text: str) -> bool:
    """Whether a run the field tagged has what its kind cannot do without, written variants read as meant."""
    if kind == "email":
        name, *domain = _AT.split(text)
        return bool(name) and len(domain) == 1 and any(c.isalpha() for c in domain[0]) and not text.isdigit()
    if kind == "ip":
        plain = _DOT.sub(".", text)
        return bool(IP.fullmatch(plain)) and valid("ip", plain)
    return valid(kind, text) and not any(c.isalpha() for c in text)


def _scan(field_: Field) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        places = Places(field_)
        for batch in (b.iloc[at : at + _TEXTS] for b in batches for at in range(0, len(b), _TEXTS)):
            texts = batch["text"].tolist()
            own = places.of(map(classes, texts))
            starts = np.cumsum([0, *map(len, own)])[:-1].tolist()
            tags = decode(places.field, np.concatenate(own) if own else np.zeros(0, np.int32), np.array(starts, dtype=int))
            rows = []
            for text, start, words in zip(texts, starts, own):
                found = base_spans(text)
                base = in_order([s for kind in KINDS for s in found[kind]])
                mine = tags[start : start + len(words)]
                more = field_spans(text, mine, base) if mine.any() else []
                rows.append((base, in_order(base + more), {k: len(found[k]) for k in KINDS}))
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"].array,
                    **{f"n_{kind}": [r[2][kind] for r in rows] for kind in KINDS},
                    "base_sha256": objects(span_digest(r[0]) for r in rows),
                    "spans": objects(span_text(r[1]) for r in rows),
                }
            )

    return run


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, windows: int = WINDOWS) -> Field:
    """Train on labelled windows of the documents, whose number is bounded by ``windows``, and on ``VARIANTS`` variants.

    Documents without an id or a text are left out, copies count once; without documents the variants alone train it.
    """
    return train(pd.concat([labelled_windows(docs, sample_docs, windows).toPandas(), variant_windows()], ignore_index=True))


def find_personal(docs: DataFrame, field_: Field) -> DataFrame:
    """One row per document: ``doc_id``, counts of base kinds, digest of the base spans, and all spans.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind and start. Null and empty texts have
    none; repeated rows give repeated results, an empty table an empty one; other columns are not looked at.
    """
    own = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    return own.mapInPandas(
        _scan(field_),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )
