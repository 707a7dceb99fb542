"""Metrics against their definitions."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from footfall.operators import metrics


def scored(spark, seed=0, rows=400, levels=None):
    chance = random.Random(seed)
    data = []
    for i in range(rows):
        label = int(chance.random() < 0.3)
        score = min(max(chance.gauss(0.4 + 0.2 * label, 0.2), 0.0), 1.0)
        data.append((i, label, round(score, levels) if levels else score))
    return data, spark.createDataFrame(data, "id int, actual int, score double")


def pairwise_auc(data):
    pos = np.array([s for _, a, s in data if a == 1])
    neg = np.array([s for _, a, s in data if a == 0])
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [None, 1])
def test_auc_equals_pairwise_and_spark(spark, levels):
    data, frame = scored(spark, levels=levels)
    found = metrics.roc_auc(frame, "actual", "score").first().roc_auc
    assert found == pytest.approx(pairwise_auc(data))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="actual", numBins=0)
    assert found == pytest.approx(evaluator.evaluate(frame.withColumn("actual", F.col("actual").cast("double"))))


def test_auc_of_reversed_scores(spark):
    _, frame = scored(spark, levels=2)
    reversed_frame = frame.withColumn("score", -F.col("score"))
    forward, backward = (metrics.roc_auc(f, "actual", "score").first().roc_auc for f in (frame, reversed_frame))
    assert 0 <= forward <= 1
    assert forward + backward == pytest.approx(1)


@pytest.mark.parametrize("label", [0, 1])
def test_one_class_has_no_auc(spark, label):
    frame = spark.createDataFrame([(label, 0.1), (label, 0.9)], "actual int, score double")
    assert metrics.roc_auc(frame, "actual", "score").first().roc_auc is None


def test_curves_and_best_threshold(spark):
    data, frame = scored(spark, levels=2)
    actual = np.array([a for _, a, _ in data])
    score = np.array([s for _, _, s in data])
    points = []
    for t in sorted(set(score), reverse=True):
        tp, fp = ((score >= t) & (actual == 1)).sum(), ((score >= t) & (actual == 0)).sum()
        points.append((t, tp / (tp + fp), tp / actual.sum(), fp / (actual == 0).sum()))
    found = {r.threshold: (r.precision, r.recall) for r in metrics.pr_curve(frame, "actual", "score").collect()}
    assert found == {t: (pytest.approx(p), pytest.approx(r)) for t, p, r, _ in points}
    roc = {r.threshold: (r.fpr, r.tpr) for r in metrics.roc_curve(frame, "actual", "score").collect()}
    assert roc == {t: (pytest.approx(f), pytest.approx(r)) for t, _, r, f in points}
    f1 = [(2 * p * r / (p + r + 1e-9), -t) for t, p, r, _ in points]
    best = metrics.optimal_threshold(frame, "actual", "score").first()
    assert (best.optimal_f1, best.optimal_threshold) == (pytest.approx(max(f1)[0]), -max(f1)[1])
    recalls = [0.0] + [r for _, _, r, _ in points]
    want = sum((recalls[i + 1] - recalls[i]) * points[i][1] for i in range(len(points)))
    assert metrics.average_precision(frame, "actual", "score").first().average_precision == pytest.approx(want)


def test_report_agrees_with_the_confusion_matrix(spark):
    _, frame = scored(spark)
    frame = frame.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    cells = {(r.actual, r.predicted): r["count"] for r in metrics.confusion_matrix(frame, "actual", "predicted").collect()}
    report = metrics.classification_report(frame, "actual", "predicted").first()
    assert report.support_1 == cells[1, 0] + cells[1, 1]
    assert report.support_0 == cells[0, 0] + cells[0, 1]
    assert report.precision_1 == pytest.approx(cells[1, 1] / (cells[1, 1] + cells[0, 1]))
    assert report.recall_0 == pytest.approx(cells[0, 0] / report.support_0)
    assert report.accuracy == pytest.approx((cells[0, 0] + cells[1, 1]) / 400)


def test_report_without_any_positive_prediction(spark):
    frame = spark.createDataFrame([(1, 0), (0, 0)], "actual int, predicted int")
    report = metrics.classification_report(frame, "actual", "predicted").first()
    assert (report.precision_1, report.recall_1, report.f1_1) == (0, 0, 0)


def test_sweep_treats_no_prediction_as_precision_one(spark):
    frame = spark.createDataFrame([(1, 0.55), (0, 0.1)], "actual int, score double")
    rows = {r.threshold: r for r in metrics.threshold_sweep(frame, "actual", "score").collect()}
    assert (rows[0.9].precision, rows[0.9].recall, rows[0.9].f1) == (1, 0, 0)
    assert (rows[0.5].tp, rows[0.5].fp, rows[0.5].fn, rows[0.5].tn) == (1, 0, 0, 1)


def test_segments_are_nested_and_empty_ones_absent(spark):
    frame = spark.createDataFrame(
        [(400, 1, 0.9, 1), (400, 0, 0.2, 0), (900, 0, 0.8, 1), (None, 1, 0.4, 0)],
        "days int, actual int, score double, predicted int",
    )
    found = {r.segment: r for r in metrics.segment_metrics(frame, "actual", "score", "predicted", "days").collect()}
    assert set(found) == {"within_730_days", "all"}
    assert found["within_730_days"].support_total == 2
    assert found["all"].support_total == 4
    assert found["within_730_days"].roc_auc == 1.0
    assert found["all"].roc_auc == pytest.approx(0.75)
