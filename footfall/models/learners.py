"""The classifiers, as Spark ML estimators with the settings that exist there.

Spark's boosting has no counterpart for L1/L2 penalties or step caps; :mod:`footfall.models.refit` gives the leaves
values that follow them. ``gamma`` and ``min_child_weight`` bound Spark's impurity gain and rows of a node here, which
are other quantities than loss reduction and Hessian sums; the refit reads ``min_child_weight`` as the latter. Spark's
neural net has no dropout, batch normalisation or row weights, so it is fitted on copies of positive rows;
:mod:`footfall.models.neural` has all three.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.sql import DataFrame

from footfall.models.prepare import FeatureNames, vector_stages, with_class_weight
from footfall.operators.audit import class_balance
from footfall.operators.sampling import balanced_by_copies

SEED = 42

# Default settings of the boosted trees, the random forest and the neural net.
BOOSTING_DEFAULTS = {
    "n_estimators": 500,
    "max_depth": 8,
    "learning_rate": 0.05,
    "subsample": 0.8,
    "colsample": 0.8,
}
FOREST_DEFAULTS = {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 1, "max_features": "sqrt"}
HIDDEN_LAYERS = (128, 64, 32)
EPOCHS = 50

BOOSTING_PARAMS = {
    "n_estimators": ("maxIter", int),
    "max_depth": ("maxDepth", int),
    "learning_rate": ("stepSize", float),
    "subsample": ("subsamplingRate", float),
    "colsample": ("featureSubsetStrategy", str),
    "max_bin": ("maxBins", int),
    "least_gain": ("validationTol", float),
    "gamma": ("minInfoGain", float),
    "min_child_weight": ("minInstancesPerNode", lambda v: max(1, round(v))),
}
FOREST_PARAMS = {
    "n_estimators": ("numTrees", int),
    "max_depth": ("maxDepth", int),
    "min_samples_leaf": ("minInstancesPerNode", int),
    "max_features": ("featureSubsetStrategy", str),
}


def spark_settings(settings: Mapping[str, object], known: Mapping[str, tuple]) -> dict[str, object]:
    """Translate setting names to Spark's, leaving out those Spark has no parameter for."""
    return {known[k][0]: known[k][1](v) for k, v in settings.items() if k in known}


def boosted_trees(
    settings: Mapping[str, object] | None = None,
    weight: str | None = "weight",
    validation_flag: str | None = None,
) -> GBTClassifier:
    """Gradient-boosted trees; ``validation_flag`` names the boolean column of early-stopping rows.

    Setting ``least_gain`` is the loss reduction on those rows below which boosting stops.
    """
    learner = GBTClassifier(
        seed=SEED, **spark_settings({**BOOSTING_DEFAULTS, **(settings or {})}, BOOSTING_PARAMS)
    )
    if weight:
        learner = learner.setWeightCol(weight)
    if validation_flag:
        learner = learner.setValidationIndicatorCol(validation_flag)
    return learner


def random_forest(
    settings: Mapping[str, object] | None = None, weight: str | None = "weight"
) -> RandomForestClassifier:
    learner = RandomForestClassifier(
        seed=SEED, **spark_settings({**FOREST_DEFAULTS, **(settings or {})}, FOREST_PARAMS)
    )
    return learner.setWeightCol(weight) if weight else learner


def neural_net(
    inputs: int, hidden: Sequence[int] = HIDDEN_LAYERS, epochs: int = EPOCHS
) -> MultilayerPerceptronClassifier:
    return MultilayerPerceptronClassifier(layers=[inputs, *hidden, 2], maxIter=epochs, seed=SEED)


def fit(learner: Estimator, names: FeatureNames, train: DataFrame) -> PipelineModel:
    """Fit scaling and learner together, so scoring reuses the training means and deviations.

    ``train`` has the feature columns, ``label`` and, where the learner asks for it, ``weight``.
    """
    stages = vector_stages(names, train.count())
    return Pipeline(stages=[*stages, learner]).fit(train)


def fit_weighted(learner: Estimator, names: FeatureNames, train: DataFrame) -> PipelineModel:
    return fit(learner, names, with_class_weight(train))


def fit_on_copies(learner: Estimator, names: FeatureNames, train: DataFrame, key: str) -> PipelineModel:
    """Even out the classes by repeating positive rows; scaling is fitted on the original rows.

    The repeat count needs the class ratio on the driver: one number.
    """
    ratio = class_balance(train, "label").first().scale_pos_weight
    scaling = Pipeline(stages=vector_stages(names, train.count())).fit(train)
    copies = balanced_by_copies(train, "label", key, ratio)
    fitted = learner.fit(scaling.transform(copies))
    return PipelineModel([*scaling.stages, fitted])
