"""Classifier metrics as aggregations over (actual, score) rows.

Every function takes ``by``, the columns to report separately on. Curves first collapse rows to one
per distinct score, so ties and hot scores cost nothing further.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.operators.ordering import cut_points, running_totals, with_piece


def collapsed_scores(scored: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score (``threshold``); rows without a score are left out."""
    return scored.filter(F.col(score).isNotNull()).groupBy(*by, F.col(score).alias("threshold")).agg(
        F.count_if(F.col(actual) == 1).alias("pos"), F.count_if(F.col(actual) == 0).alias("neg")
    )


def by_score(
    scored: DataFrame,
    actual: str,
    score: str,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Per distinct score: positives, negatives, their counts at or above it, and the totals.

    Rows without a score are left out. Without ``cuts`` one pass at call time places the cut points;
    hand it a stored table then, if scoring is costly.
    """
    if cuts is None:
        cuts = cut_points(scored.select(score), [score])[score]
    pieces = with_piece(collapsed_scores(scored, actual, score, by), "threshold", cuts)
    counted = running_totals(pieces, "threshold", ["pos", "neg"], by, descending=True)
    return counted.withColumnsRenamed(
        {"pos_through": "tp", "neg_through": "fp", "pos_all": "positives", "neg_all": "negatives"}
    )


def roc_auc(
    scored: DataFrame,
    actual: str,
    score: str,
    by: Sequence[str] = (),
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """Chance that a positive outscores a negative, ties counted as one half; NULL for one class.

    One pass over the scores: each piece of the order reports its counts and the pairs ordered inside it, and pairs
    across pieces follow from the counts.
    """
    if cuts is None:
        cuts = cut_points(scored.select(score), [score])[score]
    inside = Window.partitionBy(*by, "_piece").orderBy("threshold").rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy(*by).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)

    def pairs(before: Column) -> Column:
        return F.col("pos") * F.coalesce(before, F.lit(0))

    pieces = (
        with_piece(collapsed_scores(scored, actual, score, by), "threshold", cuts)
        .withColumn("won", pairs(F.sum("neg").over(inside)) + F.col("pos") * F.col("neg") / 2)
        .groupBy(*by, "_piece")
        .agg(*[F.sum(c).alias(c) for c in ("pos", "neg", "won")])
        .withColumn("won", F.col("won") + pairs(F.sum("neg").over(below)))
    )
    every = F.sum("pos").cast("double") * F.sum("neg")
    return pieces.groupBy(*by).agg(F.try_divide(F.sum("won"), every).alias("roc_auc"))


def roc_curve(scored: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return by_score(scored, actual, score, by).select(
        *by,
        "threshold",
        F.try_divide(F.col("fp"), F.col("negatives")).alias("fpr"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("tpr"),
    )


def pr_curve(scored: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    return by_score(scored, actual, score, by).select(
        *by,
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("positives")).alias("recall"),
    )


def average_precision(scored: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision summed over the recall gained at each distinct score."""
    step = F.try_divide(F.col("pos"), F.col("positives"))
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return (
        by_score(scored, actual, score, by)
        .groupBy(*by)
        .agg(F.sum(step * precision).alias("average_precision"))
    )


def optimal_threshold(scored: DataFrame, actual: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Threshold of the greatest F1 and that F1; the lowest threshold among equals."""
    f1 = (2 * F.col("precision") * F.col("recall")) / (F.col("precision") + F.col("recall") + F.lit(1e-9))
    best = F.max_by(F.struct("threshold", "f1"), F.struct("f1", -F.col("threshold")))
    return (
        pr_curve(scored, actual, score, by)
        .withColumn("f1", f1)
        .groupBy(*by)
        .agg(best.alias("best"))
        .select(
            *by, F.col("best.threshold").alias("optimal_threshold"), F.col("best.f1").alias("optimal_f1")
        )
    )


def _cells(actual: str, predicted: str) -> list[Column]:
    a, p = F.col(actual), F.col(predicted)
    return [
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
    ]


def _ratio(over: Column, under: Column, empty: float = 0.0) -> Column:
    return F.coalesce(F.try_divide(over, under), F.lit(empty))


def confusion_matrix(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    return scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("count")
    )


def classification_report(
    scored: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """Precision, recall, F1 and support per class, accuracy, macro and weighted F1, in one row."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    support_1, support_0 = tp + fn, tn + fp
    total = support_0 + support_1
    f1_0, f1_1 = F.col("f1_0"), F.col("f1_1")
    return (
        scored.groupBy(*by)
        .agg(*_cells(actual, predicted))
        .withColumns(
            {
                "precision_0": _ratio(tn, tn + fn),
                "recall_0": _ratio(tn, support_0),
                "f1_0": _ratio(2 * tn, 2 * tn + fn + fp),
                "support_0": support_0,
                "precision_1": _ratio(tp, tp + fp),
                "recall_1": _ratio(tp, support_1),
                "f1_1": _ratio(2 * tp, 2 * tp + fp + fn),
                "support_1": support_1,
                "accuracy": _ratio(tp + tn, total),
                "support_total": total,
            }
        )
        .withColumns(
            {
                "macro_f1": (f1_0 + f1_1) / 2,
                "weighted_f1": _ratio(
                    f1_0 * F.col("support_0") + f1_1 * F.col("support_1"), F.col("support_total")
                ),
            }
        )
        .drop("tp", "fp", "fn", "tn")
    )


SWEEP = (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)


def threshold_sweep(
    scored: DataFrame, actual: str, score: str, thresholds: Sequence[float] = SWEEP
) -> DataFrame:
    """Confusion cells, precision (1 if nothing is predicted), recall and F1 at fixed thresholds.

    One aggregation holds the cells of all thresholds and is unrolled to rows afterwards.
    """
    a, s = F.col(actual), F.col(score)
    cells = [
        F.struct(
            F.lit(float(t)).alias("threshold"),
            F.count_if((a == 1) & (s >= t)).alias("tp"),
            F.count_if((a == 0) & (s >= t)).alias("fp"),
            F.count_if((a == 1) & (s < t)).alias("fn"),
            F.count_if((a == 0) & (s < t)).alias("tn"),
        )
        for t in thresholds
    ]
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    precision, recall = F.col("precision"), F.col("recall")
    return (
        scored.agg(F.array(*cells).alias("cells"))
        .select(F.inline("cells"))
        .withColumns({"precision": _ratio(tp, tp + fp, 1.0), "recall": _ratio(tp, tp + fn)})
        .withColumn("f1", _ratio(2 * precision * recall, precision + recall))
        .select("threshold", "precision", "recall", "f1", "tp", "fp", "fn", "tn")
        .orderBy("threshold")
    )


def with_segments(df: DataFrame, days: str, limits: Sequence[int] = (365, 730)) -> DataFrame:
    """Repeat each row under every recency segment it belongs to; segments are nested."""
    names = [F.when(F.col(days) <= limit, F.lit(f"within_{limit}_days")) for limit in limits]
    segments = F.filter(F.array(*names, F.lit("all")), lambda name: name.isNotNull())
    return df.withColumn("segment", F.explode(segments))


def segment_metrics(
    scored: DataFrame, actual: str, score: str, predicted: str, days: str, limits: Sequence[int] = (365, 730)
) -> DataFrame:
    """AUC and report per recency segment; a segment without rows does not appear."""
    rows = with_segments(scored.select(days, actual, score, predicted), days, limits)
    report = classification_report(rows, actual, predicted, ["segment"])
    return report.join(roc_auc(rows, actual, score, ["segment"]), "segment")
