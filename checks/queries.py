"""One query per operator or product, over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import fixed_queries, model_queries, products
from checks.standins import (
    BANNER,
    CALENDAR_START,
    EVENT_WEEK,
    FEATURE_WEEK,
    LOOK_BACK_DAYS,
    OFFER_YEARS,
    Standins,
)
from footfall.functions.weeks import previous_year_week, week_number, week_year
from footfall.operators import audit, metrics, sampling
from footfall.operators.calendar_join import join_weeks
from footfall.operators.impute import median_fill
from footfall.plans import experiment, profiles, promo, transactions
from footfall.session import cut_lineage, scratch_path
from footfall.sources import tables
from footfall.sources.offers import read_offer_years

Query = Callable[[Standins], DataFrame]


def plain(df: DataFrame, digits: int = 6) -> DataFrame:
    """Dates as text and doubles rounded, so that results compare across engines."""

    def shown(field: T.StructField) -> str:
        name = f"`{field.name}`"
        if isinstance(field.dataType, T.DateType):
            return f"CAST({name} AS STRING) AS {name}"
        if isinstance(field.dataType, T.DoubleType):
            return f"round({name}, {digits}) AS {name}"
        if isinstance(field.dataType, T.FloatType):
            return f"CAST({name} AS DOUBLE) AS {name}"
        return name

    return df.selectExpr(*[shown(f) for f in df.schema.fields])


def week_calendar(s: Standins) -> DataFrame:
    calendar = s.calendar()
    per_day = s.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.count("*").alias("orders")
    )
    per_week = (
        join_weeks(per_day, "day", calendar, CALENDAR_START, EVENT_WEEK.end)
        .groupBy("week_identifier")
        .agg(F.sum("orders").alias("orders"))
    )
    return calendar.join(per_week, "week_identifier", "left").withColumns(
        {
            "orders": F.coalesce("orders", F.lit(0)),
            "id_year": week_year("week_identifier"),
            "id_week": week_number("week_identifier"),
            "previous_year_week": previous_year_week("week_identifier"),
        }
    )


def purchase_profile_by_card(s: Standins) -> DataFrame:
    daily = profiles.daily_purchases(products.clean(s))
    by_card = profiles.purchase_profile(daily, FEATURE_WEEK.start, profiles.BY_CARD)
    return profiles.of_customers(by_card, products.accounts(s))


def point_profile_by_card(s: Standins) -> DataFrame:
    by_card = profiles.card_points(products.summary(s), FEATURE_WEEK.start)
    return profiles.point_profile(by_card, products.accounts(s), profiles.BY_CARD).drop("cardnumber")


def median_filled(s: Standins) -> DataFrame:
    gaps = products.purchase_profile(s).select("epsilon_id", *profiles.GAP_COLUMNS)
    return median_fill(cut_lineage(gaps), profiles.GAP_COLUMNS)


def binary_columns(s: Standins) -> DataFrame:
    def by_name(df: DataFrame) -> DataFrame:
        columns = [c for c, kind in df.dtypes if kind in ("int", "bigint", "double")]
        named = audit.named_binary(columns)
        return audit.binary_by_value(df, columns).select(
            "column_name",
            F.col("column_name").isin(named).cast("int").alias("by_name"),
            F.col("is_binary").alias("by_value"),
        )

    days = cut_lineage(products.customer_days(s))
    frames = [
        products.purchase_matrix(s, days),
        products.season_matrix(s, days),
        profiles.purchase_profile(days, FEATURE_WEEK.start),
    ]
    first, second, third = (by_name(df) for df in frames)
    return first.unionByName(second).unionByName(third)


def both_scores(s: Standins, metric: Callable[..., DataFrame]) -> DataFrame:
    scores = [F.col(c).cast("double").alias(c) for c in ("score_ties", "score_fine")]
    rows = s.scored().select("actual", *scores).unpivot("actual", ["score_ties", "score_fine"], "score", "p")
    return metric(rows, "actual", "p", ["score"])


def with_prediction(s: Standins) -> DataFrame:
    return s.scored().withColumn("predicted", (F.col("score_fine") >= 0.5).cast("int"))


def balanced_copies(s: Standins) -> DataFrame:
    """Lines with returned ones repeated one and a half times on average, counted back."""
    lines = s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").cast("int").alias("label")
    )
    copies = sampling.balanced_by_copies(lines, "label", "l_orderkey", 1.5)
    return copies.groupBy("l_orderkey", "l_linenumber", "l_partkey", "label").agg(F.count("*").alias("copies"))


def snapshot_roundtrip(s: Standins) -> DataFrame:
    """Customers written as two weekly snapshots, one of them replaced, and read back."""
    path = scratch_path(s.spark, "snapshots")
    customers = s.table("customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    even = customers.filter("c_custkey % 2 = 0")
    tables.write_snapshot(customers, path, "2001_327")
    tables.write_snapshot(customers.filter("c_custkey % 2 = 1"), path, "2001_329")
    tables.write_snapshots(even.withColumn(tables.SNAPSHOT, F.lit("2001_327")), path)
    weeks = [
        tables.read_snapshot(s.spark, path, week).withColumn("week_identifier", F.lit(week))
        for week in ("2001_327", "2001_329")
    ]
    return weeks[0].unionByName(weeks[1])


def queried_views(s: Standins) -> DataFrame:
    """Offer impressions through the SQL reader: mapping join, half-open dates, any channel, banner list."""
    seen = tables.read_query(
        s.spark,
        """
        SELECT m.customer_id_hashed AS epsilon_id, v.p_banner, v.p_trans_dateid AS view_date,
               count(*) AS impressions
        FROM {views} v JOIN {mapping} m ON v.customerid = m.epcl_id
        WHERE v.p_trans_dateid >= :first AND v.p_trans_dateid < :end AND v.p_banner IN ('B1')
          AND coalesce(v.program_website_view_date, v.program_app_view_date, v.email_view_date,
                       v.banner_website_view_date, v.banner_page_view_date, v.banner_app_view_date) IS NOT NULL
        GROUP BY m.customer_id_hashed, v.p_banner, v.p_trans_dateid
        """,
        {"views": s.views(), "mapping": s.id_mapping()},
        {"first": EVENT_WEEK.days_before(LOOK_BACK_DAYS), "end": EVENT_WEEK.start},
    )
    return seen


def offer_files_roundtrip(s: Standins) -> DataFrame:
    """Offers written as one CSV folder per year and ingested again."""
    folder = scratch_path(s.spark, "offers")
    raw = s.adhoc_offers()
    for year in OFFER_YEARS:
        of_year = raw.filter(F.year("Start Date") == year)
        of_year.write.option("header", True).csv(f"{folder}/{year}.csv")
    return read_offer_years(s.spark, folder, OFFER_YEARS)


def csv_sample_roundtrip(s: Standins) -> DataFrame:
    """The stratified CSV export of orders, read back."""
    path = scratch_path(s.spark, "sample")
    orders = s.table("orders").select("o_orderkey", "o_orderstatus")
    tables.export_sample_csv(orders, path, "o_orderkey", "o_orderstatus", 0.02)
    return s.spark.read.option("header", True).schema("o_orderkey long, o_orderstatus string").csv(path)


def feature_export_roundtrip(s: Standins) -> DataFrame:
    """Ids, features and label of the labelled customers, exported in bounded files and read back."""
    path = scratch_path(s.spark, "features")
    features = ["days_since_last_purchase", "total_purchases"]
    tables.export_features(products.labelled_customers(s), path, ["epsilon_id"], features, "purchase_flag")
    return tables.read_table(s.spark, path)


SQL_CHECKED: dict[str, tuple[Query, int]] = {
    "week_calendar": (week_calendar, 6),
    "clean_transactions": (lambda s: transactions.with_previous_date(products.clean(s)), 4),
    "interpurchase_gaps": (
        lambda s: transactions.purchase_gaps(products.clean(s)).select(
            "cardnumber", "banner", "lms_transaction_id", "tx_date", "gap_days"
        ),
        4,
    ),
    "purchase_profile": (products.purchase_profile, 4),
    "purchase_profile_by_card": (purchase_profile_by_card, 4),
    "point_summary": (lambda s: transactions.with_previous_date(products.summary(s)), 4),
    "point_profile": (products.point_profile, 4),
    "point_profile_by_card": (point_profile_by_card, 4),
    "recent_balance": (lambda s: transactions.recent_balance(products.summary(s)), 4),
    "purchase_history_range": (lambda s: products.purchase_history(s, by_range=True), 6),
    "purchase_history_daygrain": (products.purchase_history, 6),
    "purchase_history_matrix": (products.purchase_matrix, 6),
    "season_matrix": (products.season_matrix, 6),
    "adhoc_offers": (products.adhoc_offers, 6),
    "promo_weeks_overlap": (products.promo_history, 6),
    "promo_weeks_explode": (lambda s: products.promo_history(s, by_day=True), 6),
    "promo_year_totals": (
        lambda s: products.promo_history(s).groupBy("deal_yr").agg(F.sum("npp_flag").alias("flagged_weeks")),
        6,
    ),
    "promo_without_oldest": (
        lambda s: promo.without_oldest_weeks(products.promo_history(s), FEATURE_WEEK.identifier),
        6,
    ),
    "promo_matrix": (products.promo_matrix, 6),
    "purchase_labels": (products.purchase_labels, 6),
    "labelled_customers": (products.labelled_customers, 6),
    "customer_base": (products.customer_base, 6),
    "offer_views_by_week": (products.offer_views_by_week, 6),
    "transaction_base": (products.transaction_base, 4),
    "weekly_shop_view": (products.weekly_shop_view, 6),
    "statistic_features": (products.statistic_features, 6),
    "embedding_table": (products.embedding_table, 6),
    "feature_matrix": (products.feature_matrix, 4),
    "score_matrix": (products.score_matrix, 4),
    "feature_matrix_unprofiled": (products.feature_matrix_unprofiled, 4),
    "labelled_embeddings": (products.labelled_embeddings, 6),
    "null_audit": (lambda s: audit.null_audit(products.purchase_profile(s)), 6),
    "median_fill": (median_filled, 4),
    "class_balance": (lambda s: audit.class_balance(products.labelled_customers(s), "label"), 6),
    "binary_columns": (binary_columns, 6),
    "likelihood_labels": (products.likelihood_labels, 6),
    "test_control": (lambda s: experiment.test_control(products.assigned(s), BANNER), 6),
    "final_labels": (products.final_labels, 6),
    "group_counts": (lambda s: audit.group_counts(products.assigned(s), ["group_flag"]), 6),
    "banner_counts": (lambda s: audit.group_counts(s.previous_labels(), ["banner"]), 6),
    "stratified_split": (
        lambda s: sampling.stratified_split(
            s.table("customer").select("c_custkey", "c_mktsegment"), "c_custkey", "c_mktsegment"
        ),
        6,
    ),
    "stratified_sample": (
        lambda s: sampling.stratified_sample(
            s.table("orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus", 0.02
        ),
        6,
    ),
    "balanced_copies": (balanced_copies, 6),
    "roc_auc": (lambda s: both_scores(s, metrics.roc_auc), 6),
    "average_precision": (lambda s: both_scores(s, metrics.average_precision), 6),
    "optimal_threshold": (lambda s: metrics.optimal_threshold(s.scored(), "actual", "score_fine"), 6),
    "roc_curve": (lambda s: metrics.roc_curve(s.scored(), "actual", "score_fine"), 6),
    "pr_curve": (lambda s: metrics.pr_curve(s.scored(), "actual", "score_fine"), 6),
    "confusion_matrix": (lambda s: metrics.confusion_matrix(with_prediction(s), "actual", "predicted"), 6),
    "classification_report": (
        lambda s: metrics.classification_report(with_prediction(s), "actual", "predicted"),
        6,
    ),
    "threshold_sweep": (lambda s: metrics.threshold_sweep(s.scored(), "actual", "score_fine"), 6),
    "segment_metrics": (
        lambda s: metrics.segment_metrics(
            cut_lineage(products.scored_customers(s)), "actual", "score", "predicted", "days_since_last_purchase"
        ),
        6,
    ),
    "standard_scale": (model_queries.standard_scale, 4),
    "class_weights": (model_queries.weighted_rows, 6),
    "write_snapshot_roundtrip": (snapshot_roundtrip, 6),
    "queried_views": (queried_views, 6),
    "offer_files_roundtrip": (offer_files_roundtrip, 6),
    "csv_sample_roundtrip": (csv_sample_roundtrip, 6),
    "feature_export_roundtrip": (feature_export_roundtrip, 6),
}


def run(query: Query, digits: int) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: plain(query(Standins(spark, sf_dir)), digits)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fitted = {name: (query, 6) for name, query in model_queries.MODEL_QUERIES.items()}
    every = {**SQL_CHECKED, **fixed_queries.FIXED_QUERIES, **fitted}
    return {name: run(query, digits) for name, (query, digits) in every.items()}
