"""The weekly jobs: each reads tables of one folder, and writes tables to it.

Inputs are un-versioned tables (``transaction_detail``, ``transaction_summary``, ``loyalty_account``,
``week_reference``, ``active_customers``, ``offer_impressions``, ``id_mapping``, ``adhoc_offers``) and
the previous model's ``previous_labels`` snapshots. Results named after a week are snapshots.

Order by data: features and embeddings of the feature week and labels of the target week before
:func:`train`; features and embeddings of the scoring week before :func:`score`; statistics before
:func:`label`; labels before :func:`merge`.

Every job removes the stages it stored once its results are saved, also when it fails.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import wraps

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.context import Week, resolve_week
from footfall.models import attribution, learners, neural, performance, refit, scoring, tuning
from footfall.models.prepare import FeatureNames, as_vectors, with_class_weight
from footfall.operators import audit
from footfall.operators.metrics import pr_curve, roc_curve, segment_metrics, threshold_sweep
from footfall.operators.sampling import stratified_split
from footfall.plans import affinity, embeddings, experiment, features, history, labels, likelihood
from footfall.plans import profiles, promo, transactions
from footfall.plans.calendar import week_reference
from footfall.session import cut_lineage, staging
from footfall.sources import tables
from footfall.sources.json_lines import read_segments

LOOK_BACK_DAYS = 1095
KEY = "epsilon_id"
PENALTIES = {"reg_lambda", "reg_alpha", "max_delta_step"}
RUN_KEY = ("banner", "model_type", "week_identifier")
RUN_COLUMNS = ("label", "split", "is_validation")


@dataclass(frozen=True)
class Store:
    """A folder of tables for one banner."""

    spark: SparkSession
    folder: str
    banner: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}"

    def table(self, name: str) -> DataFrame:
        return tables.read_table(self.spark, self.path(name))

    def snapshot(self, name: str, week_identifier: str) -> DataFrame:
        return tables.read_snapshot(self.spark, self.path(name), week_identifier)

    def save(self, df: DataFrame, name: str, week_identifier: str | None = None) -> None:
        if week_identifier is None:
            tables.replace_table(df, self.path(name))
        else:
            tables.write_snapshot(df, self.path(name), week_identifier)
        tables.vacuum(self.spark, self.path(name))

    def calendar(self) -> DataFrame:
        return week_reference(self.table("week_reference"))

    def week(self, week_identifier: str) -> Week:
        return resolve_week(self.calendar(), week_identifier)

    def accounts(self) -> DataFrame:
        return transactions.accounts(self.table("loyalty_account"))


def job(run: Callable) -> Callable:
    """A job that owns its stages; what it returns is read from saved tables."""

    @wraps(run)
    def owned(store: Store, *args, **kwargs):
        with staging(store.spark):
            return run(store, *args, **kwargs)

    return owned


def _look_back(week: Week) -> tuple[dt.date, dt.date]:
    return week.days_before(LOOK_BACK_DAYS), week.days_before(1)


@job
def customer_features(store: Store, week_identifier: str) -> None:
    """Purchase profile, point profile and purchase history as of the start of the week.

    The customers' purchase days are stored once and feed both purchase tables.
    """
    week = store.week(week_identifier)
    window = _look_back(week)
    clean = transactions.clean_transactions(store.table("transaction_detail"), store.banner, *window)
    days = cut_lineage(profiles.of_customers(profiles.daily_purchases(clean), store.accounts()))
    summary = transactions.point_summary(store.table("transaction_summary"), store.banner, *window)
    points = profiles.point_profile(profiles.card_points(summary, week.start), store.accounts())
    store.save(profiles.purchase_profile(days, week.start), "purchase_profile", week_identifier)
    store.save(points, "point_profile", week_identifier)
    store.save(history.purchase_history(days, store.calendar(), week), "purchase_history", week_identifier)


@job
def promo_weeks(
    store: Store,
    first_year: int,
    last_year: int,
    funding: str,
    described_as: str,
    not_described_as: Sequence[str] = (),
) -> None:
    chosen = promo.qualifying(store.table("adhoc_offers"), funding, described_as, not_described_as)
    store.save(promo.promo_history(chosen, store.calendar(), first_year, last_year), "promo_history")


@job
def customer_labels(store: Store, week_identifier: str) -> None:
    found = labels.purchase_labels(
        store.table("transaction_detail"), store.accounts(), store.banner, store.week(week_identifier)
    )
    store.save(found, "purchase_labels", week_identifier)


@job
def customer_embeddings(
    store: Store, week_identifier: str, segments: Iterable[tuple[DataFrame, DataFrame]], width: int
) -> None:
    found = embeddings.embedding_table(segments, width)
    tables.write_snapshot(found, store.path("embeddings"), week_identifier, tables.ROWS_PER_FILE)


def customer_embeddings_of(store: Store, week_identifier: str, segment_map: str, width: int) -> None:
    """:func:`customer_embeddings` of the segments that a JSON file lists."""
    customer_embeddings(store, week_identifier, read_segments(store.spark, segment_map), width)


@job
def statistic_inputs(store: Store, week_identifier: str, with_customer_base: bool = False) -> None:
    """Offer views and transactions by week; on request also the active customers' weeks, which no job reads."""
    week, calendar = store.week(week_identifier), store.calendar()
    first, last = _look_back(week)
    seen = affinity.offer_views(
        store.table("offer_impressions"),
        store.table("id_mapping"),
        store.table("active_customers"),
        [store.banner],
        first,
        week.start,
    )
    clean = transactions.clean_transactions(store.table("transaction_detail"), store.banner, first, last)
    base = affinity.transaction_base(clean, store.accounts(), calendar, first, last)
    store.save(affinity.offer_views_by_week(seen, calendar, first, week.start), "offer_views")
    store.save(base, "transaction_base")
    if with_customer_base:
        customers = affinity.customer_base(store.table("active_customers"), calendar, week, store.banner)
        store.save(customers, "customer_base")


@job
def statistic_features(store: Store, week_identifier: str) -> None:
    found = affinity.statistic_features(
        store.table("active_customers"),
        store.table("transaction_base"),
        store.table("offer_views"),
        store.calendar(),
        store.week(week_identifier),
    )
    store.save(found, "statistic_features", week_identifier)


def feature_matrix(
    store: Store,
    week_identifier: str,
    label_week: str | None = None,
    weeks: int = history.WEEKS,
    statistic_week: str | None = None,
    keep_unprofiled: bool = False,
) -> DataFrame:
    """The model's table from the week's snapshots, with the purchase flag of ``label_week`` if given.

    ``statistic_week`` adds that week's view and shop statistics, ``keep_unprofiled`` customers with an embedding
    only. Training and scoring call the same function, so their columns cannot differ.
    """
    week, calendar = store.week(week_identifier), store.calendar()
    bought = store.snapshot("purchase_history", week_identifier)
    summary = features.customer_summary(
        store.snapshot("point_profile", week_identifier),
        features.filled_purchase_profile(store.snapshot("purchase_profile", week_identifier), store.banner),
        history.week_and_season_matrix(bought, calendar, week, weeks),
        store.banner,
    )
    return features.feature_matrix(
        store.snapshot("embeddings", week_identifier),
        summary,
        promo.promo_matrix(store.table("promo_history"), calendar, week, weeks),
        None if label_week is None else store.snapshot("purchase_labels", label_week),
        keep_unprofiled,
        None if statistic_week is None else store.snapshot("statistic_features", statistic_week),
    )


def _explained(best: str, models: Mapping[str, PipelineModel], rows: DataFrame, names: FeatureNames) -> DataFrame:
    """Top features of the best model: Shapley values of trees (of the trees before a refit), else permutations."""
    model = models["boosted_trees" if best == "regularised_trees" else best]
    if best == "neural_net":
        vectors = cut_lineage(as_vectors(model, rows, [KEY, "label"]))
        return attribution.importance_summary(model.stages[-1], vectors, names.ordered, KEY)
    vectors = as_vectors(model, rows, [KEY])
    return attribution.shapley_summary(model.stages[-1], vectors, names.ordered, KEY)


@job
def train(
    store: Store,
    feature_week: str,
    label_week: str,
    model_week: str,
    trained_at: dt.datetime,
    settings: Mapping[str, object] | None = None,
    trials: int = 0,
    space: Mapping[str, tuple] = tuning.BOOSTING_SPACE,
    forest_settings: Mapping[str, object] | None = None,
    forest_trials: int = 0,
    tuning_rows: int | None = None,
    net_settings: Mapping[str, object] | None = None,
    statistic_week: str | None = None,
    keep_unprofiled: bool = False,
) -> DataFrame:
    """Fit, measure and keep a model; returns the validation and test AUC per model, also kept by ``model_week``.

    With ``trials`` the boosting ``settings`` come from a halving search, whose trials are kept, with ``forest_trials`` the forest's;
    ``tuning_rows`` bounds the labelled rows searched (None: all). Boosted trees compete with a random forest and,
    with ``net_settings``, the weighted neural net; penalties among ``settings`` are met by a refit of the leaves;
    the better one on validation rows is recorded with its own settings, then fitted again on all rows and
    saved. Null counts, class sizes, held-out rows, their threshold sweep and the exported matrix are kept by
    ``model_week``.
    """
    table = feature_matrix(
        store, feature_week, label_week, statistic_week=statistic_week, keep_unprofiled=keep_unprofiled
    )
    matrix = features.with_target(table)
    rows = cut_lineage(
        stratified_split(matrix, KEY, "label").withColumn("is_validation", F.col("split") == "validation")
    )
    columns = [c for c in features.feature_columns(rows) if c not in RUN_COLUMNS]
    names = FeatureNames.of(columns)
    fit_rows, train_rows, test_rows = (
        rows.filter(F.col("split").isin(*splits))
        for splits in (("train", "validation"), ("train",), ("test",))
    )
    flagged = learners.boosted_trees(settings, validation_flag="is_validation")
    chosen = {**learners.BOOSTING_DEFAULTS, **(settings or {})}
    if trials:
        tried = tuning.search_boosting(flagged, names, fit_rows, KEY, space, trials, tuning_rows)
        store.save(tuning.search_table(rows, tried), "search_trials", model_week)
        chosen = {**chosen, **tried[0].settings}
        flagged = learners.boosted_trees(chosen, validation_flag="is_validation")
    forest = {**learners.FOREST_DEFAULTS, **(forest_settings or {})}
    if forest_trials:
        best_settings, _ = tuning.tune_forest(
            learners.random_forest(forest), names, train_rows, KEY, trials=forest_trials, max_rows=tuning_rows
        )
        forest = {**forest, **best_settings}
    used = {"boosted_trees": chosen, "random_forest": forest}
    models = {
        "boosted_trees": learners.fit_weighted(flagged, names, fit_rows),
        "random_forest": learners.fit_weighted(learners.random_forest(forest), names, train_rows),
    }
    finals = {"boosted_trees": learners.boosted_trees(chosen), "random_forest": learners.random_forest(forest)}
    if net_settings is not None:
        used["neural_net"] = dict(net_settings)
        held = neural.WeightedNet(KEY, validation_flag="is_validation", **net_settings)
        models["neural_net"] = learners.fit_weighted(held, names, fit_rows)
        finals["neural_net"] = neural.WeightedNet(KEY, **net_settings)
    if PENALTIES & (settings or {}).keys():
        models["regularised_trees"] = refit.refit(models["boosted_trees"], with_class_weight(train_rows), chosen)
        used["regularised_trees"], finals["regularised_trees"] = chosen, finals["boosted_trees"]
    comparison = cut_lineage(scoring.model_comparison(models, rows))
    best = scoring.best_model(comparison)
    held_out = cut_lineage(scoring.held_out_predictions(models[best], test_rows, KEY))
    shapley = _explained(best, models, rows.filter("is_validation"), names)
    record = performance.performance_record(
        held_out, shapley, best, store.banner, model_week, trained_at, names.ordered, used[best]
    )
    recency = test_rows.select(KEY, "days_since_last_purchase")
    by_segment = segment_metrics(
        held_out.join(recency, KEY), "actual", "predicted_proba", "predicted", "days_since_last_purchase"
    )
    tables.upsert_record(record, store.path("model_performance"), RUN_KEY, "train_timestamp")
    store.save(by_segment, "segment_performance", model_week)
    store.save(held_out, "test_predictions", model_week)
    store.save(threshold_sweep(held_out, "actual", "predicted_proba"), "threshold_sweep", model_week)
    store.save(roc_curve(held_out, "actual", "predicted_proba"), "roc_curve", model_week)
    store.save(pr_curve(held_out, "actual", "predicted_proba"), "pr_curve", model_week)
    store.save(audit.null_audit(rows), "null_audit", model_week)
    store.save(audit.class_balance(rows, "label"), "class_balance", model_week)
    exported = store.path("model_features")
    tables.export_features(rows, exported, [KEY, "epcl_profileid"], columns, "purchase_flag", model_week)
    final = learners.fit_weighted(finals[best], names, rows)
    if best == "regularised_trees":
        final = refit.refit(final, with_class_weight(rows), chosen)
    tables.save_model(final, store.path("models"), best, model_week)
    store.save(comparison, "model_comparison", model_week)
    return store.snapshot("model_comparison", model_week).orderBy(F.col("validation_auc").desc(), "model")


@job
def score(
    store: Store,
    week_identifier: str,
    model_type: str,
    model_week: str,
    statistic_week: str | None = None,
    keep_unprofiled: bool = False,
) -> None:
    """Probability to shop for every customer of the week's features, by a saved model."""
    model = tables.load_model(store.path("models"), model_type, model_week)
    population = feature_matrix(
        store, week_identifier, statistic_week=statistic_week, keep_unprofiled=keep_unprofiled
    )
    store.save(scoring.score(model, population, [KEY, "epcl_profileid"]), "predictions", week_identifier)


@job
def label(store: Store, prediction_week: str, statistic_week: str, label_week: str) -> None:
    found = likelihood.likelihood_labels(
        store.snapshot("predictions", prediction_week),
        store.snapshot("statistic_features", statistic_week),
        likelihood.newest_threshold(store.table("model_performance"), store.banner),
    )
    store.save(found, "likelihood_labels", label_week)


@job
def merge(store: Store, week_identifier: str, test_share: float = 0.1, seed: int = 42) -> None:
    """Assign test and control customers and overlay the test group's new labels."""
    previous = store.snapshot("previous_labels", week_identifier)
    new = experiment.assigned(
        store.snapshot("likelihood_labels", week_identifier), previous, test_share, seed
    )
    store.save(experiment.test_control(new, store.banner), "test_control", week_identifier)
    store.save(experiment.final_labels(previous, new, store.banner), "final_labels", week_identifier)
