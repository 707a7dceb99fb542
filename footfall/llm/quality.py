"""Quality rules: a threshold table compiled into one projection.

Everything is built from SQL functions, so the whole filter is one map stage over the documents: no
shuffle, no user function, one pass over every text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import WORD, let, words_of

# Symbols that are counted, the repeated window, and common words of the collection's languages.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
STOP_WORDS = (
    "the be is was are to of and in that have it for on with as at by this from he they an or not "
    "de la que el en los las del un una por con para es se su no al lo más como "
    "der die und das den dem des von mit zu ist ein eine für auf im nicht sich als auch "
    "le les et du est qui dans pour au sur pas avec par ne ce il"
).split()


@dataclass(frozen=True)
class Rule:
    """A measure that must stay within bounds in documents of at least ``from_words`` words."""

    measure: str
    at_least: float | None = None
    at_most: float | None = None
    from_words: int = 1


#: The production table. Ratios are per word, duplicate lines per line with a word.
RULES = (
    Rule("n_words", at_least=10, from_words=0),
    Rule("mean_word_chars", at_least=2.0, at_most=15.0),
    Rule("symbol_ratio", at_most=0.1),
    Rule("stop_word_ratio", at_least=0.02, from_words=50),
    Rule("dup_line_ratio", at_most=0.35),
    Rule("repeat_word_ratio", at_most=0.2),
)


def _ratio(above: Column, below: Column) -> Column:
    return F.when(below > 0, above / below).otherwise(F.lit(0.0))


def measure(m: Column, name: str) -> Column:
    """A count or ratio from the counts of ``counts_of``; ratios over nothing are 0."""
    ratios = {
        "mean_word_chars": ("word_chars", "n_words"),
        "symbol_ratio": ("n_symbols", "n_words"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "repeat_word_ratio": ("n_repeat_words", "n_words"),
    }
    return _ratio(m[ratios[name][0]], m[ratios[name][1]]) if name in ratios else m[name]


def passes(m: Column, rules: tuple[Rule, ...]) -> Column:
    """The rule table as one boolean expression over the counts."""
    verdict = F.lit(True)
    for rule in rules:
        value, holds = measure(m, rule.measure), F.lit(True)
        if rule.at_least is not None:
            holds = holds & (value >= rule.at_least)
        if rule.at_most is not None:
            holds = holds & (value <= rule.at_most)
        verdict = verdict & (holds | (m["n_words"] < rule.from_words))
    return verdict


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def _grams(words: Column) -> Column:
    """The windows of five words as texts, by position."""
    size = F.size(words)
    first = F.slice(words, F.lit(1), F.greatest(size - (WINDOW - 1), F.lit(0)))
    texts = F.transform(first, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, WINDOW)]))
    return F.when(size >= WINDOW, texts).otherwise(F.array().cast("array<string>"))


def _by_text(grams: Column) -> Column:
    """Windows with their positions in the order of their texts, if any two are equal."""
    placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    none = F.array().cast("array<struct<g:string,i:int>>")
    return F.when(F.size(F.array_distinct(grams)) < F.size(grams), placed).otherwise(none)


def _repeated(ordered: Column) -> Column:
    """Positions of windows that are equal to a neighbour in that order, sorted."""

    def same(p: Column, j: Column) -> Column:
        return F.coalesce(F.get(ordered, j)["g"] == p["g"], F.lit(False))

    twice = F.filter(ordered, lambda p, j: same(p, j - 1) | same(p, j + 1))
    return F.sort_array(F.transform(twice, lambda p: p["i"]))


def _covered(starts: Column) -> Column:
    """Positions inside windows of five that begin at the sorted ``starts``."""
    steps = F.transform(starts, lambda p, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - p))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step)


def counts_of(text: Column) -> Column:
    """All counts of a text as one struct. Null and empty texts have no words.

    Every intermediate array is bound once, so the expression stays whole when Spark moves it into a filter.
    Repeated windows are found by sorting a text's own windows, only in texts that have some.
    """
    own = F.coalesce(text.cast("string"), F.lit(""))
    blanks = "\x20\x09\x0a\x0b\x0c\x0d"
    lines = F.filter(F.split(own, "\n"), lambda line: line.rlike(WORD))

    def counted(words: Column) -> Column:
        repeated = let(
            _grams(words),
            lambda grams: let(_by_text(grams), lambda ordered: let(_repeated(ordered), _covered)),
        )
        dup_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("distinct")))
        return let(
            dup_lines,
            lambda x: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.length(F.translate(own, blanks, "")).cast("long").alias("word_chars"),
                (F.length(own) - F.length(F.translate(own, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                x["n"].cast("long").alias("n_lines"),
                (x["n"] - x["distinct"]).cast("long").alias("n_dup_lines"),
                repeated.cast("long").alias("n_repeat_words"),
                F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            ),
        )

    return let(words_of(own), counted)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: ``doc_id``, counts, ``base_failed`` and ``kept``.

    Rows are judged one by one: repeated rows give repeated results, an empty table an empty one, null and
    empty texts fail the base rule, and columns besides ``doc_id`` and ``text`` are not looked at.
    """
    m = F.col("_counts")
    counted = docs.select("doc_id", counts_of(F.col("text")).alias("_counts"))
    return counted.select(
        "doc_id", "_counts.*", base_failed(m).alias("base_failed"), (~base_failed(m) & passes(m, rules)).alias("kept")
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The documents that are kept, with all their columns, whatever those are called."""
    return docs.filter(let(counts_of(F.col("text")), lambda m: ~base_failed(m) & passes(m, rules)))
