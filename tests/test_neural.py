"""The weighted net against finite differences, copies of rows and other partitions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from footfall.models import neural, scoring
from footfall.operators.metrics import roc_auc

SMALL = {"hidden": (6, 4), "dropout": (0.0, 0.0)}


def case(normalise, n=40, seed=0):
    chance = np.random.default_rng(seed)
    x, w = chance.standard_normal((n, 5)), chance.uniform(0.5, 3, n)
    y = (x[:, 0] + 0.3 * chance.standard_normal(n) > 0).astype(float)
    shape = neural.Shape(5, (6, 4), (0.0, 0.0), normalise)
    return shape, shape.start(1), x, y, w


@pytest.mark.parametrize("normalise", [True, False])
def test_gradient_equals_finite_differences(normalise):
    shape, weights, x, y, w = case(normalise)
    _, found, _ = neural.gradient(shape, weights, x, y, w, None)
    for name, values in weights.items():
        for place in list(np.ndindex(values.shape))[:6]:
            moved = []
            for side in (1e-6, -1e-6):
                other = {k: v.copy() for k, v in weights.items()}
                other[name][place] += side
                moved.append(neural.gradient(shape, other, x, y, w, None)[0])
            assert found[name][place] == pytest.approx((moved[0] - moved[1]) / 2e-6, rel=1e-3, abs=1e-5)


def test_a_weight_of_two_is_a_row_twice():
    shape, weights, x, y, _ = case(False)
    twice = np.concatenate([x, x[:10]]), np.concatenate([y, y[:10]])
    w = np.ones(len(x))
    w[:10] = 2
    one, found, _ = neural.gradient(shape, weights, x, y, w, None)
    other, copied, _ = neural.gradient(shape, weights, *twice, np.ones(len(twice[0])), None)
    assert one == pytest.approx(other)
    assert all(np.allclose(found[k], copied[k]) for k in found)


def test_dropout_keeps_its_share_and_repeats():
    shape = neural.Shape(5, (4000,), (0.3,), False)
    weights, x = shape.start(1), np.ones((1, 5))
    results = [neural.gradient(shape, weights, x, np.ones(1), np.ones(1), np.random.default_rng(s))[1] for s in (3, 3, 4)]
    active = (x @ weights["w0"] > 0).ravel()
    dropped = (results[0]["w1"].ravel() == 0) & active
    assert abs(dropped.sum() / active.sum() - 0.3) < 0.05
    assert np.array_equal(results[0]["w1"], results[1]["w1"]) and not np.array_equal(results[0]["w1"], results[2]["w1"])


@pytest.fixture(scope="module")
def rows(spark):
    x = [((F.col("id") * p % 997) / 997 - 0.5).alias(f"x{p}") for p in (31, 53, 71)]
    table = spark.range(1500).select("id", *x).withColumn("label", (F.col("x31") + F.col("x53") > 0.3).cast("int"))
    table = table.withColumn("weight", F.when(F.col("label") == 1, 2.0).otherwise(1.0))
    return VectorAssembler(inputCols=["x31", "x53", "x71"], outputCol="features").transform(table)


def plain_fit(rows, shape, epochs):
    """The same steps in one process."""
    table = sorted(rows.selectExpr("id", "pmod(xxhash64(cast(id AS string)), 6) AS chunk", "features", "label", "weight").collect(),
                   key=lambda r: str(r.id))
    chunks = {}
    for r in table:
        chunks.setdefault(r.chunk, []).append(r)
    weights, done = shape.start(neural.SEED), 0
    m = {k: np.zeros_like(v) for k, v in weights.items()}
    v = {k: np.zeros_like(x) for k, x in weights.items()}
    for epoch in range(epochs):
        for part in range(6):
            members = chunks.get(part, [])
            if not members:
                continue
            x = np.array([r.features.toArray() for r in members])
            y, w = (np.array([float(r[c]) for r in members]) for c in ("label", "weight"))
            _, g, _ = neural.gradient(shape, weights, x, y, w, np.random.default_rng((neural.SEED, epoch * 6 + part, part)))
            done += 1
            for k in weights:
                m[k] = 0.9 * m[k] + 0.1 * g[k] / len(x)
                v[k] = 0.999 * v[k] + 0.001 * (g[k] / len(x)) ** 2
                step = m[k] / (1 - 0.9**done) / (np.sqrt(v[k] / (1 - 0.999**done)) + 1e-7)
                weights[k] = weights[k] - 0.01 * step
    return weights


def test_fit_equals_one_process_on_any_partitions(rows):
    shape = neural.Shape(3, (6, 4), (0.3, 0.0), True)
    want = plain_fit(rows, shape, 2)
    for partitions in (1, 4, 20):
        chunked, chunks = neural.packed(rows.repartition(partitions), "id", "label", "weight")
        assert chunks == 6
        got, _, history = neural.fit_weights(chunked.repartition(partitions), chunks, shape, epochs=2, step_size=0.01)
        assert all(np.allclose(got[k], want[k], atol=1e-9) for k in want)
        assert history[1][0] < history[0][0]


def test_learns_is_saved_and_read(rows, tmp_path):
    flagged = rows.withColumn("held", F.col("id") % 5 == 0)
    learner = neural.WeightedNet("id", hidden=(16, 8), dropout=(0.1, 0.0), epochs=12, step_size=0.01, validation_flag="held")
    model = Pipeline(stages=[learner]).fit(flagged)
    held = flagged.filter("held")
    area = roc_auc(scoring.score(model, held, ["label"], "p"), "label", "p").first().roc_auc
    assert area > 0.95
    model.write().overwrite().save(str(tmp_path / "net"))
    back = PipelineModel.load(str(tmp_path / "net"))
    same = scoring.score(model, held, ["id"], "p").join(scoring.score(back, held, ["id"], "q"), "id")
    assert same.filter("p <> q").count() == 0 and same.count() == 300
    assert {r.prediction for r in model.transform(held).select("prediction").collect()} == {0.0, 1.0}


def test_no_rows_raise(rows):
    with pytest.raises(ValueError, match="no rows"):
        neural.WeightedNet("id").fit(rows.limit(0))
