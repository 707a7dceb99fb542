"""Hyper-parameter search, random or by halving, and cross-validation by Spark's own validator."""

from __future__ import annotations

import json
import logging
import math
import random
from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.base import Estimator
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

from footfall.models.learners import BOOSTING_PARAMS, FOREST_PARAMS, SEED, spark_settings
from footfall.models.prepare import FeatureNames, vector_stages, with_class_weight
from footfall.models.search import Trial, halving_search
from footfall.operators.sampling import capped_fraction, fold_number, stratified_sample, stratified_split
from footfall.session import cut_lineage

# Search ranges (kind, low, high[, step]) or the list of choices, trial counts, hold-out.
BOOSTING_SPACE = {
    "n_estimators": ("int", 100, 800, 50),
    "learning_rate": ("log", 0.01, 0.2),
    "max_depth": ("int", 3, 15, 1),
    "min_child_weight": ("log", 0.1, 256.0),
    "gamma": ("log", 1e-8, 10.0),
    "subsample": ("float", 0.6, 0.95),
    "colsample": ("float", 0.4, 0.9),
    "max_bin": ("log_int", 64, 256),
}
FOREST_SPACE = {
    "n_estimators": ("int", 50, 300, 1),
    "max_depth": ("int", 5, 30, 1),
    "min_samples_leaf": ("int", 1, 10, 1),
    "max_features": ("choice", "sqrt", "log2"),
}
WIDE_BOOSTING_SPACE = {
    "n_estimators": ("int", 100, 600, 1),
    "max_depth": ("int", 1, 30, 1),
    "learning_rate": ("log", 0.01, 0.3),
    "subsample": ("float", 0.6, 1.0),
    "colsample": ("float", 0.6, 1.0),
}
BOOSTING_TRIALS = 100
FOREST_TRIALS = 20
WIDE_BOOSTING_TRIALS = 14
ROWS_PER_PARTITION = 100_000
FOLDS = 3
HOLD_OUT = 0.2
PARALLEL_TRIALS = 4


def _auc() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(metricName="areaUnderROC")


def draw(space: Mapping[str, tuple], trials: int, seed: int = SEED) -> list[dict[str, object]]:
    """Independent random settings; ``log`` kinds are uniform in the logarithm."""
    chance = random.Random(seed)

    def one(kind: str, *bounds):
        if kind == "choice":
            return chance.choice(bounds)
        low, high, *step = bounds
        if kind == "int":
            return low + step[0] * chance.randint(0, (high - low) // step[0])
        if kind == "float":
            return chance.uniform(low, high)
        value = math.exp(chance.uniform(math.log(low), math.log(high)))
        return round(value) if kind == "log_int" else value

    return [{name: one(*spec) for name, spec in space.items()} for _ in range(trials)]


def param_maps(
    learner: Estimator, trials: Sequence[Mapping[str, object]], known: Mapping[str, tuple]
) -> list[dict]:
    return [
        {learner.getParam(name): value for name, value in spark_settings(settings, known).items()}
        for settings in trials
    ]


def tuning_rows(train: DataFrame, key: str, cap: int | None = None) -> DataFrame:
    """The training rows, or a stratified sample of about ``cap`` of them, which is logged when it is smaller."""
    if cap is None:
        return train
    fraction = capped_fraction(train.count(), cap)
    if fraction == 1.0:
        return train
    logging.getLogger(__name__).warning("search fitted on a sample of %.4f of the training rows", fraction)
    return stratified_sample(train, key, "label", fraction)


def search_vectors(names: FeatureNames, train: DataFrame, key: str, max_rows: int | None = None) -> DataFrame:
    """Weighted, scaled rows with a ``split`` of their own, stored; scaling is fitted on the rows trials are fitted on.

    Rows are dealt to partitions by a hash of ``key`` and ordered by it, as subsampling draws by partition
    and place.
    """
    rows = with_class_weight(tuning_rows(train, key, max_rows))
    kept = [c for c in ("label", "weight", "is_validation") if c in rows.columns]
    split = stratified_split(
        rows.select(key, *names.ordered, *kept), key, "label", 1 - HOLD_OUT, HOLD_OUT, f"search:{SEED}"
    )
    fitted = split.filter("split = 'train'")
    n_fitted = fitted.count()
    scaling = Pipeline(stages=vector_stages(names, n_fitted)).fit(fitted)
    vectors = scaling.transform(split).select(key, "features", "split", *kept)
    dealt = vectors.repartition(math.ceil(max(n_fitted, 1) / ROWS_PER_PARTITION), key).sortWithinPartitions(key)
    return cut_lineage(dealt)


def tune(
    learner: Estimator,
    names: FeatureNames,
    train: DataFrame,
    key: str,
    known: Mapping[str, tuple],
    space: Mapping[str, tuple],
    trials: int,
    max_rows: int | None = None,
) -> tuple[dict[str, object], list[float]]:
    """Best settings by ROC-AUC on a held-out fifth, and the ROC-AUC of every trial in the order drawn.

    The hold-out has an exact share of each class and is told by a hash of ``key``, whatever the partitions.
    Every trial is weighted and runs on the cluster; scaling is fitted once, on the rows the trials are fitted
    on. ``max_rows`` bounds the labelled rows searched; without it all are.
    """
    vectors = search_vectors(names, train, key, max_rows)
    held_out = vectors.filter("split <> 'train'")
    settings, auc = draw(space, trials), _auc()
    models = learner.fitMultiple(vectors.filter("split = 'train'"), param_maps(learner, settings, known))

    def measured(_: int) -> tuple[int, float]:
        place, model = next(models)
        return place, auc.evaluate(model.transform(held_out))

    with ThreadPool(PARALLEL_TRIALS) as pool:
        found = dict(pool.imap_unordered(inheritable_thread_target(vectors.sparkSession)(measured), range(trials)))
    scores = [found[i] for i in range(trials)]
    return settings[scores.index(max(scores))], scores


def tune_boosting(
    learner: Estimator,
    names: FeatureNames,
    train: DataFrame,
    key: str,
    space: Mapping[str, tuple] = BOOSTING_SPACE,
    trials: int = BOOSTING_TRIALS,
    max_rows: int | None = None,
) -> tuple[dict[str, object], list[float]]:
    return tune(learner, names, train, key, BOOSTING_PARAMS, space, trials, max_rows)


def search(
    learner: Estimator,
    names: FeatureNames,
    train: DataFrame,
    key: str,
    known: Mapping[str, tuple],
    space: Mapping[str, tuple],
    resource: str,
    trials: int,
    max_rows: int | None = None,
    **halving: int,
) -> list[Trial]:
    """Trials of a halving search, best first, scored by ROC-AUC on the held-out fifth of :func:`tune`.

    ``resource`` is the setting that grows from rung to rung, the number of trees.
    """
    vectors = search_vectors(names, train, key, max_rows)
    fitted, held_out, auc = vectors.filter("split = 'train'"), vectors.filter("split <> 'train'"), _auc()

    def evaluate(settings: dict[str, object], amount: int) -> float:
        params = param_maps(learner, [{**settings, resource: amount}], known)[0]
        return auc.evaluate(learner.fit(fitted, params).transform(held_out))

    wrap = inheritable_thread_target(vectors.sparkSession)
    return halving_search(space, evaluate, resource, trials, SEED, parallel=PARALLEL_TRIALS, wrap=wrap, **halving)


def search_boosting(
    learner: Estimator,
    names: FeatureNames,
    train: DataFrame,
    key: str,
    space: Mapping[str, tuple] = BOOSTING_SPACE,
    trials: int = BOOSTING_TRIALS,
    max_rows: int | None = None,
    **halving: int,
) -> list[Trial]:
    """Halving search over boosted trees; pass ``WIDE_BOOSTING_SPACE`` for the wider ranges."""
    return search(learner, names, train, key, BOOSTING_PARAMS, space, "n_estimators", trials, max_rows, **halving)


def search_table(like: DataFrame, trials: Sequence[Trial]) -> DataFrame:
    """One row per trial and rung: resource used and ROC-AUC there, and whether the trial won."""
    rows = [
        (t.number, rung, amount, json.dumps(t.settings), float(score), place == 0)
        for place, t in enumerate(trials)
        for rung, (amount, score) in enumerate(zip(t.resources, t.scores))
    ]
    schema = "trial int, rung int, trees int, settings string, roc_auc double, is_best boolean"
    return like.sparkSession.createDataFrame(rows, schema).orderBy("trial", "rung")


def tune_forest(
    learner: Estimator,
    names: FeatureNames,
    train: DataFrame,
    key: str,
    space: Mapping[str, tuple] = FOREST_SPACE,
    trials: int = FOREST_TRIALS,
    max_rows: int | None = None,
) -> tuple[dict[str, object], list[float]]:
    return tune(learner, names, train, key, FOREST_PARAMS, space, trials, max_rows)


def cross_validate(
    learner: Estimator,
    names: FeatureNames,
    train: DataFrame,
    key: str,
    settings: Sequence[Mapping[str, object]],
    known: Mapping[str, tuple] = FOREST_PARAMS,
    folds: int = FOLDS,
) -> CrossValidatorModel:
    """Mean ROC-AUC over folds told by a hash of ``key``; scaling is fitted anew in every fold."""
    rows = fold_number(with_class_weight(train), key, folds)
    pipeline = Pipeline(stages=[*vector_stages(names, rows.count()), learner])
    return CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=param_maps(learner, settings, known),
        evaluator=_auc(),
        numFolds=folds,
        foldCol="fold",
        parallelism=PARALLEL_TRIALS,
        seed=SEED,
    ).fit(rows)


def trial_table(
    like: DataFrame, settings: Sequence[Mapping[str, object]], scores: Sequence[float]
) -> DataFrame:
    """One row per trial with its settings as JSON and its ROC-AUC."""
    rows = [(i, json.dumps(dict(s)), float(score)) for i, (s, score) in enumerate(zip(settings, scores))]
    return like.sparkSession.createDataFrame(rows, "trial int, settings string, roc_auc double").orderBy(
        F.col("roc_auc").desc(), "trial"
    )
