"""Learners, tuning, persistence and attribution on embeddings with a planted target."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import model_queries as m
from checks.standins import Standins
from footfall.models import attribution, learners, scoring, tuning
from footfall.models.prepare import FeatureNames, as_vectors
from footfall.operators.metrics import roc_auc
from footfall.sources import tables


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return m.labelled_vectors(Standins(spark, sf_dir)).cache()


@pytest.fixture(scope="module")
def boosted(rows):
    return m.boosted(rows)


def auc(model, rows, name):
    return roc_auc(scoring.score(model, m.part(rows, name), ["label"], "p"), "label", "p").first().roc_auc


def test_boosted_trees_learn_the_planted_target(rows, boosted):
    full = learners.fit_weighted(learners.boosted_trees(m.BOOSTING), m.NAMES, m.part(rows, "train"))
    assert auc(full, rows, "train") > 0.8
    assert boosted.stages[-1].getNumTrees <= full.stages[-1].getNumTrees == 10


def test_forest_and_net_learn(rows):
    for fit in (m.forest, m.net):
        assert auc(fit(rows), rows, "train") > 0.7


def test_default_settings_are_translated():
    settings = learners.spark_settings(learners.BOOSTING_DEFAULTS, learners.BOOSTING_PARAMS)
    assert settings == {
        "maxIter": 500,
        "maxDepth": 8,
        "stepSize": 0.05,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "0.8",
    }


def test_feature_order_is_numeric_then_binary():
    names = FeatureNames.of(["3_weeks_back_purchase", "sales", "deal_season_num_1", "latent_0"])
    assert names.ordered == ["sales", "latent_0", "3_weeks_back_purchase", "deal_season_num_1"]


def test_saved_model_scores_the_same(spark, rows, boosted, tmp_path):
    tables.save_model(boosted, str(tmp_path), "boosted_trees", "2001_327")
    loaded = tables.load_model(str(tmp_path), "boosted_trees", "2001_327")
    before, after = (
        {r[m.KEY]: r.p for r in scoring.score(model, rows, [m.KEY], "p").collect()} for model in (boosted, loaded)
    )
    assert before == after


def test_scaling_comes_from_the_training_rows(rows, boosted):
    train = m.part(rows, "train", "validation")
    stats = (
        as_vectors(boosted, train, [])
        .select(vector_to_array("features")[5].alias("z"))
        .agg(F.avg("z").alias("mean"), F.stddev_pop("z").alias("dev"))
        .first()
    )
    assert stats.mean == pytest.approx(0, abs=1e-9) and stats.dev == pytest.approx(1)
    other = as_vectors(boosted, m.part(rows, "test"), []).select(vector_to_array("features")[5].alias("z"))
    assert abs(other.agg(F.avg("z")).first()[0]) > 1e-6


def test_trials_are_reproducible_and_in_range():
    first, second = (tuning.draw(tuning.BOOSTING_SPACE, 50) for _ in range(2))
    assert first == second
    assert all(100 <= t["n_estimators"] <= 800 and t["n_estimators"] % 50 == 0 for t in first)
    assert all(0.01 <= t["learning_rate"] <= 0.2 and 64 <= t["max_bin"] <= 256 for t in first)


def test_tuning_sample_is_capped_and_stratified(rows):
    sample = tuning.tuning_rows(rows, m.KEY, 100)
    assert 100 <= sample.count() <= 102
    share = rows.agg(F.avg("label")).first()[0]
    assert sample.agg(F.avg("label")).first()[0] == pytest.approx(share, abs=0.02)
    assert tuning.tuning_rows(rows, m.KEY, 10**6).count() == tuning.tuning_rows(rows, m.KEY).count() == rows.count()


def test_forest_search_keeps_the_best_trial_whatever_the_partitions(rows):
    space = {"n_estimators": ("int", 2, 3, 1), "max_depth": ("int", 1, 5, 4), "max_features": ("choice", "sqrt", "log2")}
    train = m.part(rows, "train").select(m.KEY, "label", *m.LATENT)
    found = [
        tuning.tune_forest(learners.random_forest(), m.NAMES, df, m.KEY, space, 3)
        for df in (train.coalesce(1), train.repartition(4))
    ]
    drawn = tuning.draw(space, 3)
    for best, scores in found:
        assert len(scores) == 3 and all(0 <= score <= 1 for score in scores)
        assert best == drawn[scores.index(max(scores))]
    assert found[0][1] == pytest.approx(found[1][1], abs=0.1)


def brute_force_shapley(leaves, x, width):
    """Shapley values from the definition, over all subsets of the features a leaf uses."""
    phi = np.zeros(width)
    for value, conditions in leaves:
        met = {f: float(low < x[f] <= high) for f, low, high, _ in conditions}
        share = {f: s for f, _, _, s in conditions}
        features = list(met)
        for j in features:
            others = [f for f in features if f != j]
            for size in range(len(others) + 1):
                weight = math.factorial(size) * math.factorial(len(others) - size) / math.factorial(len(features))
                for chosen in itertools.combinations(others, size):
                    rest = math.prod(met[f] if f in chosen else share[f] for f in others)
                    phi[j] += weight * value * rest * (met[j] - share[j])
    return phi


@pytest.mark.parametrize("kind", ["boosted_trees", "random_forest"])
def test_shapley_values_add_up_and_match_the_definition(spark, rows, boosted, kind):
    model = boosted if kind == "boosted_trees" else m.forest(rows)
    learner = model.stages[-1]
    leaves = attribution.tree_paths(learner, spark)
    vectors = as_vectors(model, m.part(rows, "test"), [m.KEY]).orderBy(m.KEY).limit(20)
    scored = learner.transform(vectors).select(
        vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")
    )
    collected = scored.collect()
    x = np.array([r.x for r in collected])
    base, phi = attribution.shapley_batches(leaves, x.shape[1])(x)
    margin = base + phi.sum(axis=1)
    probability = np.array([r.p for r in collected])
    want = np.log(probability / (1 - probability)) if kind == "boosted_trees" else probability
    assert margin == pytest.approx(want, abs=1e-9)
    for i in range(3):
        assert phi[i] == pytest.approx(brute_force_shapley(leaves, x[i], x.shape[1]), abs=1e-9)


def test_shapley_summary_ranks_both_classes(rows, boosted):
    vectors = as_vectors(boosted, m.part(rows, "validation"), [m.KEY])
    found = attribution.shapley_summary(boosted.stages[-1], vectors, m.NAMES.ordered, m.KEY, k=5).collect()
    assert len(found) == 10
    one = {r.feature: r.mean_abs_shap_value for r in found if r["class"] == "class_1"}
    assert list(one.values()) == sorted(one.values(), reverse=True)


def test_permuting_the_only_used_feature_matters_most(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    base = spark.range(600).select(
        "id",
        array_to_vector(F.array((F.col("id") * 7919 % 601) / 601.0, (F.col("id") * 104729 % 607) / 607.0)).alias("features"),
        ((F.col("id") * 104729 % 607) > 300).cast("int").alias("label"),
    )
    learner = DecisionTreeClassifier(maxDepth=2).fit(base)
    found = {
        r.feature: r.importance
        for r in attribution.permutation_importance(learner, base, ["idle", "used"], "id").collect()
    }
    assert found["used"] > 0.3 and found["idle"] == pytest.approx(0, abs=1e-9)
    one_by_one = attribution.permutation_importance(learner, base, ["idle", "used"], "id", features_at_once=1)
    assert {r.feature: r.importance for r in one_by_one.collect()} == found


def test_permuted_rows_are_never_broadcast(spark, monkeypatch, capsys):
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.functions import array_to_vector

    stored = []
    monkeypatch.setattr(attribution, "cut_lineage", lambda df: stored.append(df) or df)
    vector = array_to_vector(F.array(F.col("id") % 7 / 7.0, F.col("id") % 5 / 5.0))
    base = spark.range(40).select("id", vector.alias("features"), (F.col("id") % 5 > 2).cast("int").alias("label"))
    learner = DecisionTreeClassifier(maxDepth=2).fit(base)
    attribution.permutation_importance(learner, base, ["idle", "used"], "id", repeats=2)
    paired = stored[0]
    assert paired.count() == 2 * 40
    capsys.readouterr()
    paired.explain()  # the join of receivers and donors is the topmost one
    top = next(line for line in capsys.readouterr().out.splitlines() if "Join" in line)
    assert "SortMergeJoin [rank#" in top, top


@pytest.mark.parametrize("name", sorted(m.MODEL_QUERIES))
def test_model_queries_return_rows(spark, sf_dir, name):
    assert m.MODEL_QUERIES[name](Standins(spark, sf_dir)).count() > 0


def test_performance_record_has_its_fields(spark, sf_dir):
    record = m.performance_record(Standins(spark, sf_dir))
    assert len(record.columns) == 23
    row = record.first()
    assert 0 < row.roc_auc <= 1 and row.support_total == row.support_0 + row.support_1
    assert row.top_20_shap_features_class_1.count("mean_abs_shap_value") == 20
