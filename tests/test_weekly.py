"""The weekly jobs end to end on stand-in tables, against the products they are made of."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import pytest

from checks import products
from checks.standins import BANNER, EMBEDDING_WIDTH, EVENT_WEEK, FEATURE_WEEK, TARGET_WEEK, Standins
from footfall import weekly
from footfall.session import cut_lineage, shared_folder
from footfall.sources import tables

SMALL = {"n_estimators": 4, "max_depth": 3, "learning_rate": 0.3}


def same_rows(found, want):
    assert sorted(found.columns) == sorted(want.columns)
    want = want.select(*found.columns)
    assert found.count() == want.count()
    assert found.exceptAll(want).count() == 0


def stages(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    return {p.name for p in folder.iterdir()} if folder.exists() else set()


@pytest.fixture(scope="module")
def standins(spark, sf_dir):
    return Standins(spark, sf_dir)


def fill(store, s, detail):
    calendar = s.calendar().drop("week_identifier")
    for name, df in {
        "week_reference": calendar,
        "transaction_detail": detail,
        "transaction_summary": s.transaction_summary(),
        "loyalty_account": s.loyalty_account(),
        "active_customers": s.active_customers(),
        "offer_impressions": s.views(),
        "id_mapping": s.id_mapping(),
        "adhoc_offers": products.adhoc_offers(s),
    }.items():
        store.save(df, name)
    return store


@pytest.fixture(scope="module")
def trained(spark, standins, tmp_path_factory):
    store = weekly.Store(spark, str(tmp_path_factory.mktemp("store")), BANNER)
    fill(store, standins, standins.transaction_detail())
    before = stages(spark)
    weekly.customer_features(store, FEATURE_WEEK.identifier)
    assert stages(spark) == before
    weekly.promo_weeks(store, 1999, 2001, "Brand#1", "RING", ["PROMO", "SMALL"])
    weekly.customer_labels(store, TARGET_WEEK.identifier)
    segments = standins.embedding_segments()
    weekly.customer_embeddings(store, FEATURE_WEEK.identifier, segments, EMBEDDING_WIDTH)
    return store


def test_snapshots_equal_the_products(trained, standins):
    week = FEATURE_WEEK.identifier
    same_rows(
        trained.snapshot("purchase_history", week), products.purchase_history(standins)
    )
    same_rows(trained.table("promo_history"), products.promo_history(standins))
    same_rows(trained.snapshot("purchase_labels", TARGET_WEEK.identifier), products.purchase_labels(standins))
    assert trained.snapshot("purchase_profile", week).count() == products.purchase_profile(standins).count()
    assert trained.snapshot("point_profile", week).count() == products.point_profile(standins).count()


def test_a_job_that_fails_leaves_no_stage(spark, tmp_path):
    @weekly.job
    def fails(store):
        assert cut_lineage(store.spark.range(3)).count() == 3 and len(stages(spark) - before) == 1
        raise ValueError("lost")

    before = stages(spark)
    with pytest.raises(ValueError, match="lost"):
        fails(weekly.Store(spark, str(tmp_path), BANNER))
    assert stages(spark) == before


def test_training_and_scoring_share_their_columns(trained):
    training = weekly.feature_matrix(trained, FEATURE_WEEK.identifier, TARGET_WEEK.identifier)
    scoring = weekly.feature_matrix(trained, FEATURE_WEEK.identifier)
    assert [c for c in training.columns if c != "purchase_flag"] == scoring.columns
    assert training.select("epsilon_id").distinct().count() == training.count() > 0


def test_train_then_score(trained):
    # The target week of the small tables holds next to no buyers; label the busier look-back instead.
    busy = trained.snapshot("purchase_history", FEATURE_WEEK.identifier).drop("made_purchase", "week_identifier")
    flags = busy.distinct().selectExpr("*", "'Y' AS purchase_flag")
    trained.save(flags, "purchase_labels", "2001_399")
    before = stages(trained.spark)
    comparison = weekly.train(
        trained, FEATURE_WEEK.identifier, "2001_399", "2001_331", dt.datetime(2001, 6, 30), SMALL
    )
    assert stages(trained.spark) == before and comparison.count() == 2
    assert trained.snapshot("model_comparison", "2001_331").columns == ["model", "validation_auc", "test_auc"]
    best = comparison.first().model
    record = trained.table("model_performance").collect()
    assert len(record) == 1 and record[0].model_type == best and record[0].roc_auc > 0.8
    assert trained.snapshot("segment_performance", "2001_331").count() >= 1
    exported = trained.snapshot("model_features", "2001_331")
    assert trained.snapshot("threshold_sweep", "2001_331").count() == 8
    assert trained.snapshot("class_balance", "2001_331").first().rows == exported.count()
    assert trained.snapshot("null_audit", "2001_331").columns == ["column_name", "null_count"]
    assert {"epsilon_id", "epcl_profileid", "purchase_flag"} < set(exported.columns)
    weekly.score(trained, FEATURE_WEEK.identifier, best, "2001_331")
    scores = trained.snapshot("predictions", FEATURE_WEEK.identifier)
    assert scores.count() == weekly.feature_matrix(trained, FEATURE_WEEK.identifier).count()
    assert scores.filter("predicted_purchase_prob NOT BETWEEN 0 AND 1").count() == 0


def test_net_and_penalties_compete_and_a_rerun_keeps_one_record(trained):
    busy = trained.snapshot("purchase_history", FEATURE_WEEK.identifier).drop("made_purchase", "week_identifier")
    trained.save(busy.distinct().selectExpr("*", "'Y' AS purchase_flag"), "purchase_labels", "2001_398")
    settings = {**SMALL, "reg_lambda": 2.0}
    for _ in range(2):
        comparison = weekly.train(
            trained,
            FEATURE_WEEK.identifier,
            "2001_398",
            "2001_332",
            dt.datetime(2001, 7, 7),
            settings,
            forest_settings={"n_estimators": 5, "max_depth": 3},
            net_settings={"hidden": (8, 4), "dropout": (0.1, 0.0), "epochs": 3},
        )
    models = {r.model for r in comparison.collect()}
    assert models == {"boosted_trees", "random_forest", "neural_net", "regularised_trees"}
    assert trained.table("model_performance").filter("week_identifier = '2001_332'").count() == 1
    weekly.score(trained, FEATURE_WEEK.identifier, comparison.first().model, "2001_332")
    assert trained.snapshot("roc_curve", "2001_332").count() > 1


def test_statistics_labels_and_merge(spark, standins, tmp_path):
    store = fill(weekly.Store(spark, str(tmp_path), BANNER), standins, standins.event_detail())
    week = EVENT_WEEK.identifier
    weekly.statistic_inputs(store, week, with_customer_base=True)
    weekly.statistic_features(store, week)
    same_rows(store.snapshot("statistic_features", week), products.statistic_features(standins))
    same_rows(store.table("customer_base"), products.customer_base(standins))
    same_rows(store.table("offer_views"), products.offer_views_by_week(standins))
    store.save(standins.predictions(), "predictions", week)
    store.save(standins.model_performance(), "model_performance")
    store.save(standins.previous_labels(), "previous_labels", week)
    weekly.label(store, week, week, week)
    weekly.merge(store, week)
    same_rows(store.snapshot("likelihood_labels", week), products.likelihood_labels(standins))
    same_rows(store.snapshot("final_labels", week), products.final_labels(standins))
    assert store.snapshot("test_control", week).count() == products.assigned(standins).count()
    assert tables.SNAPSHOT in store.table("final_labels").columns
