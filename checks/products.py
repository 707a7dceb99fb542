"""The data products built on the stand-in inputs, shared by several queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from checks.standins import (
    BANNER,
    EMBEDDING_WIDTH,
    EVENT_WEEK,
    FEATURE_WEEK,
    LOOK_BACK_DAYS,
    OFFER_YEARS,
    TARGET_WEEK,
    Standins,
)
from footfall.context import Week
from footfall.operators.audit import require_columns
from footfall.operators.impute import default_label
from footfall.plans import affinity, embeddings, experiment, features, history, labels, likelihood, offers
from footfall.plans import profiles, promo, transactions
from footfall.session import cut_lineage

ONE_DAY = dt.timedelta(days=1)
PROMO_YEARS = (1999, 2001)


def look_back(week: Week) -> tuple[dt.date, dt.date]:
    return week.days_before(LOOK_BACK_DAYS), week.start - ONE_DAY


def accounts(s: Standins) -> DataFrame:
    return transactions.accounts(s.loyalty_account())


def clean(s: Standins) -> DataFrame:
    return transactions.clean_transactions(s.transaction_detail(), BANNER, *look_back(FEATURE_WEEK))


def summary(s: Standins) -> DataFrame:
    return transactions.point_summary(s.transaction_summary(), BANNER, *look_back(FEATURE_WEEK))


def customer_days(s: Standins) -> DataFrame:
    return profiles.of_customers(profiles.daily_purchases(clean(s)), accounts(s))


def purchase_profile(s: Standins) -> DataFrame:
    return profiles.purchase_profile(customer_days(s), FEATURE_WEEK.start)


def point_profile(s: Standins) -> DataFrame:
    return profiles.point_profile(profiles.card_points(summary(s), FEATURE_WEEK.start), accounts(s))


def purchase_history(s: Standins, days: DataFrame | None = None, by_range: bool = False) -> DataFrame:
    days = customer_days(s) if days is None else days
    return history.purchase_history(days, s.calendar(), FEATURE_WEEK, by_range=by_range)


def purchase_matrix(s: Standins, days: DataFrame | None = None) -> DataFrame:
    return history.purchase_matrix(purchase_history(s, days), s.calendar(), FEATURE_WEEK)


def season_matrix(s: Standins, days: DataFrame | None = None) -> DataFrame:
    return history.season_matrix(purchase_history(s, days), s.calendar(), FEATURE_WEEK)


def adhoc_offers(s: Standins) -> DataFrame:
    raw = s.adhoc_offers()
    return offers.adhoc_offers([raw.filter(F.year("Start Date") == year) for year in OFFER_YEARS])


def promo_history(s: Standins, by_day: bool = False) -> DataFrame:
    chosen = promo.qualifying(adhoc_offers(s), "Brand#1", "RING", ["PROMO", "SMALL"])
    return promo.promo_history(chosen, s.calendar(), *PROMO_YEARS, by_day=by_day)


def promo_matrix(s: Standins) -> DataFrame:
    return promo.promo_matrix(promo_history(s), s.calendar(), FEATURE_WEEK, history.WEEKS)


def purchase_labels(s: Standins) -> DataFrame:
    return labels.purchase_labels(s.transaction_detail(), accounts(s), BANNER, TARGET_WEEK)


def embedding_table(s: Standins) -> DataFrame:
    return embeddings.embedding_table(s.embedding_segments(), EMBEDDING_WIDTH)


def customer_summary(s: Standins) -> DataFrame:
    """Point profiles with purchases, weeks and seasons.

    The customers' purchase days feed the profile and the matrix, and the medians read the profile
    several times, so each of the two is stored once.
    """
    days = cut_lineage(customer_days(s))
    profile = cut_lineage(profiles.purchase_profile(days, FEATURE_WEEK.start))
    return features.customer_summary(
        point_profile(s),
        features.filled_purchase_profile(profile, BANNER),
        history.week_and_season_matrix(purchase_history(s, days), s.calendar(), FEATURE_WEEK),
        BANNER,
    )


def feature_matrix(s: Standins) -> DataFrame:
    """Training matrix: customers with an embedding and a profile, and their label."""
    return features.feature_matrix(
        embedding_table(s), customer_summary(s), promo_matrix(s), purchase_labels(s)
    )


def score_matrix(s: Standins) -> DataFrame:
    """The same columns without the label."""
    return features.feature_matrix(embedding_table(s), customer_summary(s), promo_matrix(s))


def feature_matrix_unprofiled(s: Standins) -> DataFrame:
    """Every customer with an embedding, profiled or not, with the view statistics."""
    return features.feature_matrix(
        embedding_table(s),
        customer_summary(s),
        promo_matrix(s),
        purchase_labels(s),
        keep_unprofiled=True,
        statistics=statistic_features(s),
    )


def labelled_embeddings(s: Standins) -> DataFrame:
    """Embeddings and label only, all rows of all segments."""
    table = require_columns(embedding_table(s), [f"latent_{i}" for i in range(EMBEDDING_WIDTH)])
    flags = purchase_labels(s).select("epsilon_id", "purchase_flag")
    return features.with_target(default_label(table.join(flags, "epsilon_id", "left"), "purchase_flag"))


def customer_base(s: Standins) -> DataFrame:
    return affinity.customer_base(s.active_customers(), s.calendar(), EVENT_WEEK, BANNER)


def offer_views_by_week(s: Standins) -> DataFrame:
    first, end = EVENT_WEEK.days_before(LOOK_BACK_DAYS), EVENT_WEEK.start
    seen = affinity.offer_views(s.views(), s.id_mapping(), s.active_customers(), [BANNER], first, end)
    return affinity.offer_views_by_week(seen, s.calendar(), first, end)


def event_days(s: Standins) -> DataFrame:
    first, last = look_back(EVENT_WEEK)
    cleaned = transactions.clean_transactions(s.event_detail(), BANNER, first, last)
    daily = profiles.daily_purchases(cleaned)
    return affinity.shopping_days(daily, accounts(s), s.calendar(), first, last)


def transaction_base(s: Standins) -> DataFrame:
    return affinity.transaction_base(clean(s), accounts(s), s.calendar(), *look_back(FEATURE_WEEK))


def weekly_shop_view(s: Standins) -> DataFrame:
    return affinity.weekly_shop_view(customer_base(s), event_days(s), offer_views_by_week(s), EVENT_WEEK)


def statistic_features(s: Standins) -> DataFrame:
    return affinity.statistic_features(
        s.active_customers(), event_days(s), offer_views_by_week(s), s.calendar(), EVENT_WEEK
    )


def likelihood_labels(s: Standins) -> DataFrame:
    threshold = likelihood.newest_threshold(s.model_performance(), BANNER)
    return likelihood.likelihood_labels(s.predictions(), statistic_features(s), threshold)


def assigned(s: Standins) -> DataFrame:
    return experiment.assigned(likelihood_labels(s), s.previous_labels())


def final_labels(s: Standins) -> DataFrame:
    return experiment.final_labels(s.previous_labels(), assigned(s), BANNER)


def labelled_customers(s: Standins) -> DataFrame:
    """Every customer with a purchase profile, flagged Y or N for the target week."""
    flags = purchase_labels(s).select("epsilon_id", "purchase_flag")
    profiled = purchase_profile(s).select("epsilon_id", "days_since_last_purchase", "total_purchases")
    joined = profiled.join(flags, "epsilon_id", "left")
    return features.with_target(features.default_label(joined, "purchase_flag"))


def scored_customers(s: Standins) -> DataFrame:
    """Labelled customers with the stand-in score, as (actual, score, predicted, recency)."""
    scores = s.predictions().select("epsilon_id", F.col("predicted_purchase_prob").alias("score"))
    return labelled_customers(s).join(scores, "epsilon_id").select(
        "epsilon_id",
        F.col("label").alias("actual"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "days_since_last_purchase",
    )
