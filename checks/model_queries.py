"""Queries that fit models, on embeddings with a planted target. Small settings, all rows."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from checks import products
from checks.standins import BANNER, EMBEDDING_WIDTH, FEATURE_WEEK, Standins
from footfall.models import attribution, learners, neural, performance, refit, scoring, tuning
from footfall.models.prepare import FeatureNames, as_vectors, vector_stages, with_class_weight
from footfall.operators.sampling import stratified_split
from footfall.plans.embeddings import widen
from footfall.session import cut_lineage

LATENT = [f"latent_{i}" for i in range(EMBEDDING_WIDTH)]
NAMES = FeatureNames.of(LATENT)
KEY = "lightfm_id"
IDS = [KEY, "epsilon_id"]
BOOSTING = {"n_estimators": 10, "max_depth": 4, "learning_rate": 0.3}
FOREST = {"n_estimators": 20, "max_depth": 5}
SMALL_SPACE = {**tuning.BOOSTING_SPACE, "n_estimators": ("int", 5, 10, 5), "max_depth": ("int", 2, 4, 1)}


def labelled_vectors(s: Standins) -> DataFrame:
    """Embedding rows with label, split and early-stopping flag, stored once for the fits."""
    target = s.table("embeddings").select(
        F.col("vec_id").alias(KEY), (F.col("label") >= 5).cast("int").alias("label")
    )
    rows = products.embedding_table(s).join(target, KEY)
    split = stratified_split(rows, KEY, "label")
    return cut_lineage(split.withColumn("is_validation", F.col("split") == "validation"))


def part(rows: DataFrame, *names: str) -> DataFrame:
    return rows.filter(F.col("split").isin(*names))


def boosted(rows: DataFrame) -> PipelineModel:
    """Boosted trees fitted on the training rows, stopped early on the validation rows."""
    learner = learners.boosted_trees(BOOSTING, validation_flag="is_validation")
    return learners.fit_weighted(learner, NAMES, part(rows, "train", "validation"))


def forest(rows: DataFrame) -> PipelineModel:
    return learners.fit_weighted(learners.random_forest(FOREST), NAMES, part(rows, "train"))


def net(rows: DataFrame) -> PipelineModel:
    return learners.fit_on_copies(
        learners.neural_net(EMBEDDING_WIDTH, epochs=30), NAMES, part(rows, "train"), KEY
    )


def held_out(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    return scoring.held_out_predictions(boosted(rows), part(rows, "test"), KEY)


def gbt_scores(s: Standins) -> DataFrame:
    """The learner fitted once more on all rows, then applied to all rows."""
    rows = labelled_vectors(s)
    model = learners.fit_weighted(learners.boosted_trees(BOOSTING), NAMES, rows)
    return scoring.score(model, rows, IDS)


def forest_scores(s: Standins) -> DataFrame:
    """The forest with the library's own settings."""
    rows = labelled_vectors(s)
    model = learners.fit_weighted(learners.random_forest(), NAMES, part(rows, "train"))
    return scoring.score(model, rows, IDS)


def mlp_scores(s: Standins) -> DataFrame:
    """The neural net with the library's own settings."""
    rows = labelled_vectors(s)
    model = learners.fit_on_copies(learners.neural_net(EMBEDDING_WIDTH), NAMES, part(rows, "train"), KEY)
    return scoring.score(model, rows, IDS)


def net_scores(s: Standins) -> DataFrame:
    """The weighted net with the library's own settings, ended by the validation rows."""
    rows = labelled_vectors(s)
    learner = neural.WeightedNet(KEY, validation_flag="is_validation")
    return scoring.score(learners.fit_weighted(learner, NAMES, part(rows, "train", "validation")), rows, IDS)


def regularised_scores(s: Standins) -> DataFrame:
    """Boosted trees with their leaves refitted under penalties, applied to all rows."""
    rows = labelled_vectors(s)
    settings = {**BOOSTING, "reg_lambda": 5.0, "max_delta_step": 1.0}
    fitted = learners.fit_weighted(learners.boosted_trees(settings), NAMES, part(rows, "train"))
    return scoring.score(refit.refit(fitted, with_class_weight(part(rows, "train")), settings), rows, IDS)


def tuned_model(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    learner = learners.boosted_trees(validation_flag="is_validation")
    train = part(rows, "train", "validation")
    trials = 3
    _, scores = tuning.tune_boosting(learner, NAMES, train, KEY, SMALL_SPACE, trials)
    return tuning.trial_table(rows, tuning.draw(SMALL_SPACE, trials), scores)


def halving_trials(s: Standins) -> DataFrame:
    """Two brackets of nine trials: scores of every trial at every rung it reached."""
    rows = labelled_vectors(s)
    learner = learners.boosted_trees(validation_flag="is_validation")
    train = part(rows, "train", "validation")
    space = {**SMALL_SPACE, "n_estimators": ("int", 9, 18, 9)}
    return tuning.search_table(rows, tuning.search_boosting(learner, NAMES, train, KEY, space, trials=18))


def cv_auc(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    settings = [{"n_estimators": 10, "max_depth": depth} for depth in (3, 5)]
    found = tuning.cross_validate(learners.random_forest(), NAMES, part(rows, "train"), KEY, settings)
    return tuning.trial_table(rows, settings, found.avgMetrics)


def model_comparison(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    models = {"boosted_trees": boosted(rows), "random_forest": forest(rows), "neural_net": net(rows)}
    return scoring.model_comparison(models, rows)


def feature_importance(s: Standins) -> DataFrame:
    learner = boosted(labelled_vectors(s)).stages[-1]
    return attribution.impurity_importance(s.spark, learner, NAMES.ordered)


def permutation_importance(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    model = net(rows)
    vectors = cut_lineage(as_vectors(model, part(rows, "validation"), [KEY, "label"]))
    return attribution.permutation_importance(model.stages[-1], vectors, NAMES.ordered, KEY)


def _shapley(s: Standins, rows: DataFrame, model: PipelineModel) -> DataFrame:
    vectors = as_vectors(model, part(rows, "validation"), [KEY])
    return attribution.shapley_summary(model.stages[-1], vectors, NAMES.ordered, KEY)


def shapley_summary(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    return _shapley(s, rows, boosted(rows))


def performance_record(s: Standins) -> DataFrame:
    rows = labelled_vectors(s)
    model = boosted(rows)
    predictions = cut_lineage(scoring.held_out_predictions(model, part(rows, "test"), KEY))
    return performance.performance_record(
        predictions,
        _shapley(s, rows, model),
        "boosted_trees",
        BANNER,
        FEATURE_WEEK.identifier,
        dt.datetime(2001, 6, 30),
        NAMES.ordered,
        BOOSTING,
    )


def standard_scale(s: Standins) -> DataFrame:
    wide = widen(s.table("embeddings").withColumnRenamed("vec_id", KEY), EMBEDDING_WIDTH)
    fitted = Pipeline(stages=vector_stages(NAMES, wide.count())).fit(wide)
    scaled = fitted.transform(wide).select(KEY, vector_to_array("features").alias("z"))
    return scaled.select(
        F.col(KEY).alias("vec_id"), *[F.col("z")[i].alias(f"scaled_{i}") for i in range(EMBEDDING_WIDTH)]
    )


def weighted_rows(s: Standins) -> DataFrame:
    """Labelled customers with the row weight that evens out the classes."""
    return with_class_weight(products.labelled_customers(s)).select("epsilon_id", "label", "weight")


MODEL_QUERIES = {
    "gbt_scores": gbt_scores,
    "forest_scores": forest_scores,
    "mlp_scores": mlp_scores,
    "net_scores": net_scores,
    "regularised_scores": regularised_scores,
    "held_out_predictions": held_out,
    "tuned_model": tuned_model,
    "halving_trials": halving_trials,
    "cv_auc": cv_auc,
    "model_comparison": model_comparison,
    "feature_importance": feature_importance,
    "permutation_importance": permutation_importance,
    "shapley_summary": shapley_summary,
    "performance_record": performance_record,
}
