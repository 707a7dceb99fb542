"""The model half over fixed inputs, where results have SQL twins: no fit, or a fit SQL can repeat."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from checks import products
from checks.model_queries import KEY, NAMES
from checks.standins import BANNER, EMBEDDING_WIDTH, EVENT_WEEK, FEATURE_WEEK, TARGET_WEEK, Standins
from footfall.context import resolve_week
from footfall.models import attribution, performance, refit, scoring
from footfall.models.prepare import vector_stages
from footfall.operators import audit, sketches
from footfall.operators.calendar_join import join_weeks
from footfall.operators.shape import top
from footfall.plans import features, transactions
from footfall.plans.embeddings import widen
from footfall.session import cut_lineage, scratch_path
from footfall.sources import json_lines, tables

PERMUTED = ["balance_cents", "nation", "segment_length"]

#: Leaves of a forest's tree on two of three features: (value, [(feature, low, high, share), ...]).
LEAVES = [
    (0.2, [(0, -math.inf, 4000.0, 0.6)]),
    (0.3, [(0, 4000.0, math.inf, 0.4), (1, -math.inf, 10.0, 0.5)]),
    (0.9, [(0, 4000.0, math.inf, 0.4), (1, 10.0, math.inf, 0.5)]),
]


class LinearScorer(Transformer):
    """Probability of class 1 as a fixed linear function of the first three features."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array("features")
        p = (x[0] + x[1] * 20000 + x[2] * 30000 + 1_000_000) / 10_000_000
        return dataset.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def line_scores(s: Standins) -> DataFrame:
    """Order lines as held-out rows of a classifier: the stand-in score and its class at one half."""
    return s.scored().select(
        "actual",
        (F.col("score_fine") >= 0.5).cast("int").alias("predicted"),
        F.col("score_fine").alias("predicted_proba"),
    )


def performance_of_lines(s: Standins) -> DataFrame:
    """Record of a run whose feature means are nation keys."""
    share = F.col("n_nationkey") / 32.0
    means = s.table("nation").select(
        F.col("n_name").alias("feature"), share.alias("class_1"), (1 - share).alias("class_0")
    )
    shapley = means.unpivot(["feature"], ["class_1", "class_0"], "class", "mean_abs_shap_value")
    record = performance.performance_record(
        line_scores(s),
        shapley,
        "boosted_trees",
        BANNER,
        FEATURE_WEEK.identifier,
        dt.datetime(2001, 6, 30),
        PERMUTED,
        {"max_depth": 4, "learning_rate": 0.5},
    )
    return record.withColumn("feature_cols", F.concat_ws(",", "feature_cols"))


def compared_scores(s: Standins) -> DataFrame:
    """Two stand-in scores of the order lines compared on even and odd lines."""
    lines = s.table("lineitem").select(
        F.when(F.col("l_linenumber") % 2 == 0, "validation").otherwise("test").alias("split"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        F.col("l_discount").cast("double").alias("ties"),
        F.round(F.col("l_extendedprice") / 110000, 6).alias("fine"),
    )
    return scoring.compared(lines.unpivot(["split", "label"], ["ties", "fine"], "model", "p"))


def customer_vectors(s: Standins, *values) -> DataFrame:
    vector = array_to_vector(F.array(*[v.cast("double") for v in values]))
    label = (F.col("c_acctbal") + F.col("c_nationkey") * 150 > 5000).cast("int")
    return s.table("customer").select("c_custkey", label.alias("label"), vector.alias("features"))


def permutation_of_customers(s: Standins) -> DataFrame:
    """Permutation importance of a fixed linear score, by the same hash orders in both engines."""
    cents = F.round(F.col("c_acctbal") * 100)
    vectors = cut_lineage(customer_vectors(s, cents, F.col("c_nationkey"), F.length("c_mktsegment")))
    return attribution.permutation_importance(LinearScorer(), vectors, PERMUTED, "c_custkey", features_at_once=2)


def shapley_of_fixed_tree(s: Standins) -> DataFrame:
    vectors = customer_vectors(s, F.col("c_acctbal"), F.col("c_nationkey"), F.col("c_custkey"))
    leaves = attribution.as_leaves(s.spark, LEAVES)
    return attribution.leaf_summary(leaves, vectors, ["balance", "nation", "unused"], "c_custkey", False)


def saved_scaling(s: Standins) -> DataFrame:
    """The scaling stages fitted, saved, loaded and applied by the copy that was read back."""
    wide = widen(s.table("embeddings").withColumnRenamed("vec_id", KEY), EMBEDDING_WIDTH)
    fitted = Pipeline(stages=vector_stages(NAMES, wide.count())).fit(wide)
    folder = scratch_path(s.spark, "saved")
    tables.save_model(fitted, folder, "scaling", FEATURE_WEEK.identifier)
    loaded = tables.load_model(folder, "scaling", FEATURE_WEEK.identifier)
    scaled = loaded.transform(wide).select(KEY, vector_to_array("features").alias("z"))
    return scaled.select(
        F.col(KEY).alias("vec_id"), *[F.col("z")[i].alias(f"scaled_{i}") for i in range(EMBEDDING_WIDTH)]
    )


def stored_tables(s: Standins) -> DataFrame:
    """Orders through a replaced table, bounded part files and a log of two records sets."""
    path = scratch_path(s.spark, "stored")
    orders = s.table("orders").select("o_orderkey", "o_orderstatus")
    open_orders, filled = (orders.filter(F.col("o_orderstatus") == c) for c in ("O", "F"))
    tables.replace_table(orders, f"{path}/replaced")
    tables.replace_table(filled, f"{path}/replaced")
    tables.write_parts(orders, f"{path}/parts", 1000)
    tables.append_record(filled, f"{path}/log")
    tables.append_record(open_orders, f"{path}/log")
    parts = [
        tables.read_table(s.spark, f"{path}/{name}").withColumn("stored_as", F.lit(name))
        for name in ("replaced", "parts", "log")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def best_suppliers(s: Standins) -> DataFrame:
    """A top-40 report, ties told by name."""
    rows = s.table("supplier").select("s_name", F.floor(F.col("s_acctbal") / 500).alias("score"))
    return top(rows, "score", attribution.IMPORTANCE_ROWS, "s_name")


def null_audits(s: Standins) -> DataFrame:
    """NULL counts of the six tables a training matrix is made of."""
    frames = {
        "purchase_profile": products.purchase_profile(s),
        "point_profile": products.point_profile(s),
        "purchase_history": products.purchase_history(s),
        "promo_matrix": products.promo_matrix(s),
        "purchase_labels": products.purchase_labels(s),
        "embedding_table": products.embedding_table(s),
    }
    found = [audit.null_audit(df).withColumn("table_name", F.lit(name)) for name, df in frames.items()]
    stacked = found[0]
    for more in found[1:]:
        stacked = stacked.unionByName(more)
    return stacked


def exported_matrix(s: Standins) -> DataFrame:
    """The whole training matrix, exported in bounded files and read back."""
    path = scratch_path(s.spark, "matrix")
    matrix = products.feature_matrix(s)
    tables.export_features(
        matrix, path, ["epsilon_id", "epcl_profileid"], features.feature_columns(matrix), "purchase_flag"
    )
    return tables.read_table(s.spark, path)


def sampled_matrix(s: Standins) -> DataFrame:
    """The stratified CSV sample of the training matrix, read back."""
    path = scratch_path(s.spark, "sample")
    matrix = products.feature_matrix(s)
    kept = matrix.select("epsilon_id", *features.feature_columns(matrix), "purchase_flag")
    tables.export_sample_csv(kept, path, "epsilon_id", "purchase_flag", 0.02)
    return s.spark.read.option("header", True).schema(kept.schema).csv(path)


def upserted_log(s: Standins) -> DataFrame:
    """Orders put into a log of one row per customer, newest order kept, twice and in another order."""
    path = scratch_path(s.spark, "upserts")
    orders = s.table("orders").select("o_custkey", "o_orderkey", "o_totalprice")
    for part in ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1", "o_orderkey % 2 = 0"):
        tables.upsert_record(orders.filter(part), path, ["o_custkey"], "o_orderkey")
    return tables.read_table(s.spark, path)


def weeks_of_runs(s: Standins) -> DataFrame:
    """Bounds of single weeks, each read from the calendar as one row."""
    calendar = s.calendar()
    weeks = [resolve_week(calendar, w.identifier) for w in (FEATURE_WEEK, TARGET_WEEK, EVENT_WEEK)]
    bounds = [(w.identifier, w.start, w.end) for w in weeks]
    listed = s.spark.createDataFrame(bounds, "week_identifier string, start_date date, end_date date")
    days = s.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("day")).count()
    dated = join_weeks(days, "day", listed, FEATURE_WEEK.start, EVENT_WEEK.end)
    per_week = dated.groupBy("week_identifier").agg(F.sum("count").alias("orders"))
    return listed.join(per_week, "week_identifier", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))


def refitted_leaves(s: Standins) -> DataFrame:
    """Second-order values of a fixed tree's leaves: customers split by balance and nation, at a known margin."""
    leaf = F.when(F.col("c_acctbal") <= 4000, 0).when(F.col("c_nationkey") <= 10, 1).otherwise(2)
    rows = s.table("customer").select(
        leaf.alias("leaf"),
        (F.col("c_acctbal") + F.col("c_nationkey") * 150 > 5000).cast("int").alias("label"),
        (F.col("c_nationkey") / 10.0 - 1.0).alias("margin"),
        F.when(F.col("c_mktsegment") == "BUILDING", 2.0).otherwise(1.0).alias("weight"),
    )
    return refit.leaf_values(
        rows, "leaf", "label", "margin", "weight", 0.5, reg_lambda=3.0, reg_alpha=1.5, min_child_weight=2.0, max_delta_step=0.9
    )


def gap_sketch_quartiles(s: Standins) -> DataFrame:
    """Quartiles of the gaps between a card's purchases, from sketches kept by week, stored and merged."""
    gaps = transactions.purchase_gaps(products.clean(s))
    dated = join_weeks(gaps, "tx_date", s.calendar(), *products.look_back(FEATURE_WEEK))
    path = scratch_path(s.spark, "sketches")
    weekly = sketches.week_sketches(dated, ["cardnumber", "banner"], "week_identifier", "gap_days")
    tables.write_snapshots(weekly.withColumnRenamed("week_identifier", tables.SNAPSHOT), path)
    merged = sketches.merged_sketches(tables.read_table(s.spark, path), ["cardnumber", "banner"])
    return merged.withColumns(sketches.quantile_columns()).drop("sketch")


def json_records(s: Standins) -> DataFrame:
    """Suppliers written as JSON lines, every seventh cut short, and read with a declared schema."""
    path = scratch_path(s.spark, "json")
    line = F.to_json(F.struct("s_suppkey", "s_name", "s_nationkey"))
    cut = F.when(F.col("s_suppkey") % 7 == 0, F.substring(line, 1, 12)).otherwise(line)
    s.table("supplier").select(cut.alias("value")).write.text(path)
    read = json_lines.read_json(s.spark, path, "s_suppkey long, s_name string, s_nationkey int")
    return read.withColumn(json_lines.BROKEN, F.col(json_lines.BROKEN).isNotNull().cast("int")).groupBy(
        json_lines.BROKEN, "s_nationkey"
    ).agg(F.count("*").alias("records"), F.sum("s_suppkey").alias("keys"))


FIXED_QUERIES = {
    "performance_of_lines": (performance_of_lines, 6),
    "compared_scores": (compared_scores, 4),
    "permutation_of_customers": (permutation_of_customers, 6),
    "shapley_of_fixed_tree": (shapley_of_fixed_tree, 6),
    "saved_scaling": (saved_scaling, 4),
    "stored_tables": (stored_tables, 6),
    "best_suppliers": (best_suppliers, 6),
    "null_audits": (null_audits, 6),
    "exported_matrix": (exported_matrix, 4),
    "sampled_matrix": (sampled_matrix, 4),
    "refitted_leaves": (refitted_leaves, 6),
    "gap_sketch_quartiles": (gap_sketch_quartiles, 4),
    "json_records": (json_records, 4),
    "upserted_log": (upserted_log, 4),
    "weeks_of_runs": (weeks_of_runs, 4),
}
