"""Refitted leaf values against the formula in plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from footfall.models import learners, refit, scoring

SETTINGS = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.5, "subsample": 1.0, "colsample": 1.0}


@pytest.fixture(scope="module")
def rows(spark):
    x = [((F.col("id") * p % 211) / 211).alias(f"x{p}") for p in (31, 53)]
    table = spark.range(600).select("id", *x)
    label = ((F.col("x31") + F.col("x53") > 1) != (F.col("id") % 9 == 0)).cast("int")
    return table.withColumn("label", label).withColumn("weight", F.when(F.col("id") % 2 == 0, 2.0).otherwise(1.0)).cache()


@pytest.fixture(scope="module")
def model(rows):
    stages = [VectorAssembler(inputCols=["x31", "x53"], outputCol="features"), learners.boosted_trees(SETTINGS)]
    return Pipeline(stages=stages).fit(rows)


def plainly(model, rows, reg_lambda=1.0, reg_alpha=0.0, min_child_weight=1.0, max_delta_step=0.0):
    learner = model.stages[-1]
    table = model.transform(rows).select("id", "features", "label", "weight").collect()
    leaves = np.array([learner.predictLeaf(r.features).toArray() for r in table]).astype(int)
    y, w = (np.array([float(r[c]) for r in table]) for c in ("label", "weight"))
    margin, found = np.zeros(len(table)), []
    for t in range(leaves.shape[1]):
        p = 1 / (1 + np.exp(-margin))
        values = {}
        for leaf in set(leaves[:, t]):
            own = leaves[:, t] == leaf
            g, h = (w * (p - y))[own].sum(), (w * p * (1 - p))[own].sum()
            value = -math.copysign(max(abs(g) - reg_alpha, 0), g) / (h + reg_lambda)
            if max_delta_step:
                value = min(max(value, -max_delta_step), max_delta_step)
            values[leaf] = 0.5 * value if h >= min_child_weight else 0.0
        margin = margin + np.array([values[leaf] for leaf in leaves[:, t]])
        found.append(values)
    return found, {r.id: 1 / (1 + math.exp(-m)) for r, m in zip(table, margin)}


@pytest.mark.parametrize(
    "penalties",
    [{}, {"reg_lambda": 50.0}, {"reg_alpha": 5.0, "min_child_weight": 12.0}, {"max_delta_step": 0.2, "reg_lambda": 0.0}],
)
def test_values_follow_the_formula(rows, model, penalties):
    want, chances = plainly(model, rows, **penalties)
    again = refit.refit(model, rows, {**SETTINGS, **penalties})
    got = again.stages[-1].leaf_values()
    for tree, values in enumerate(want):
        assert all(got[tree][leaf] == pytest.approx(v, abs=1e-9) for leaf, v in values.items())
    scored = scoring.score(again, rows, ["id"], "p").collect()
    assert all(r.p == pytest.approx(chances[r.id], abs=1e-9) for r in scored)


def test_penalties_bound_values_and_refit_helps(rows, model):
    tight = refit.refit(model, rows, {**SETTINGS, "max_delta_step": 0.1}).stages[-1].leaf_values()
    assert max(abs(v) for tree in tight for v in tree) <= 0.05 + 1e-12
    none = refit.refit(model, rows, {**SETTINGS, "min_child_weight": 1e9}).stages[-1].leaf_values()
    assert {v for tree in none for v in tree} == {0.0}

    def loss(m):
        return refit.log_loss(scoring.score(m, rows, ["label", "weight"], "p"), "label", "p", "weight")

    losses = [loss(refit.refit(model, rows, {**SETTINGS, "reg_lambda": penalty})) for penalty in (0.1, 100.0, 1e4)]
    assert losses == sorted(losses) and losses[-1] < math.log(2)


def test_refitted_model_is_saved_and_read(rows, model, tmp_path):
    again = refit.refit(model, rows, SETTINGS)
    again.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    both = scoring.score(again, rows, ["id"], "p").join(scoring.score(back, rows, ["id"], "q"), "id")
    assert both.filter("p <> q").count() == 0 and both.count() == 600
