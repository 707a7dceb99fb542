"""Which features a model relies on."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.operators.metrics import roc_auc
from footfall.operators.ordering import cut_points, hash_rank
from footfall.operators.shape import top
from footfall.session import cut_lineage, scratch_path

IMPORTANCE_ROWS = 40
SHAPLEY_ROWS = 20
SLICE = 32
BLOCK_ROWS = 16_384


def _feature_names(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(names)), "feature_index int, feature string")


def impurity_importance(
    spark: SparkSession, learner: Transformer, names: Sequence[str], k: int = IMPORTANCE_ROWS
) -> DataFrame:
    """The ``k`` features with the greatest impurity decrease, named in vector order."""
    values = [float(v) for v in learner.featureImportances.toArray()]
    rows = [(name, value) for name, value in zip(names, values, strict=True)]
    return top(spark.createDataFrame(rows, "feature string, importance double"), "importance", k, "feature")


def permutation_importance(
    learner: Transformer,
    vectors: DataFrame,
    names: Sequence[str],
    key: str,
    repeats: int = 5,
    k: int = IMPORTANCE_ROWS,
    features_at_once: int = SLICE,
) -> DataFrame:
    """Mean loss of ROC-AUC when one feature is shuffled among the rows.

    ``vectors`` has ``key``, ``label`` and ``features``; hand it a stored table. Each repeat is one
    permutation: rows ranked by a seeded hash take their value from the row of the same rank in
    another hash order. Scores are never stored: they go straight into the counts of their piece of the order, from which
    the AUC follows in one pass. Features are taken ``features_at_once``, so that a shuffle grows with the rows and
    not with rows times features. One AUC per feature and repeat reaches the driver.
    """
    spark = vectors.sparkSession
    rows = vectors.select(key, "label", vector_to_array("features").alias("x"))
    repeated = rows.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats)))).withColumn(
        "_draw", F.concat_ws("#", F.col(key).cast("string"), "repeat")
    )
    receivers = hash_rank(repeated, "_draw", ["repeat"], "receiver").drop("group_rows")
    donors = hash_rank(rows.select(key, F.col("x").alias("donor")), key, (), "donor").select("rank", "donor")

    def replaced(value, i):
        return F.when(i == F.col("feature_index"), F.get("donor", F.col("feature_index"))).otherwise(value)

    # the size Spark expects leaves out the repeats and the compression of the stored table: by it all rows were broadcast
    paired = cut_lineage(receivers.hint("shuffle_merge").join(donors, "rank").select("repeat", "label", "x", "donor"))
    chance = vector_to_array("probability")[1].alias("p")
    plain = cut_lineage(learner.transform(vectors).select("label", chance))
    cuts = cut_points(plain, ["p"])["p"]
    before = roc_auc(plain, "label", "p", cuts=cuts).scalar()

    def aucs(first: int, last: int) -> list:
        shuffled = (
            paired.repartition(spark.sparkContext.defaultParallelism)
            .withColumn("feature_index", F.explode(F.sequence(F.lit(first), F.lit(last))))
            .select("repeat", "feature_index", "label", array_to_vector(F.transform("x", replaced)).alias("features"))
        )
        rescored = learner.transform(shuffled).select("repeat", "feature_index", "label", chance)
        return roc_auc(rescored, "label", "p", ["repeat", "feature_index"], cuts=cuts).collect()

    found = [
        (r.repeat, r.feature_index, r.roc_auc)
        for first in range(0, len(names), features_at_once)
        for r in aucs(first, min(first + features_at_once, len(names)) - 1)
    ]
    after = spark.createDataFrame(found, "repeat int, feature_index int, roc_auc double")
    importance = (
        after.groupBy("feature_index")
        .agg(F.avg("roc_auc").alias("_mean_auc"))
        .withColumn("importance", before - F.col("_mean_auc"))
        .join(F.broadcast(_feature_names(spark, names)), "feature_index")
        .select("feature", "importance")
    )
    return top(importance, "importance", k, "feature")


def importance_summary(
    learner: Transformer, vectors: DataFrame, names: Sequence[str], key: str, k: int = SHAPLEY_ROWS
) -> DataFrame:
    """:func:`shapley_summary`'s columns for a learner without trees: permutation importance, alike for both classes.

    ``vectors`` is a stored table with ``label``.
    """
    ranked = permutation_importance(learner, vectors, names, key, k=k)
    classes = F.explode(F.array(F.lit("class_1"), F.lit("class_0")))
    return ranked.select("feature", classes.alias("class"), F.col("importance").alias("mean_abs_shap_value"))


LEAVES = "leaf_value double, feature array<int>, low array<double>, high array<double>, share array<double>"


def tree_leaves(learner: Transformer, spark: SparkSession) -> DataFrame:
    """Every leaf of a fitted tree ensemble as a row of ``LEAVES``.

    Read back from the stored model. The arrays list the leaf's conditions: it needs ``low < x <= high`` of a
    feature, and ``share`` is the part of training weight that met the feature's splits along the path. Values are
    log-odds for boosted trees and probabilities for forests. Trees are walked on the executors, one at a time;
    the depth of a tree bounds its nodes.
    """
    boosted = hasattr(learner, "treeWeights") and "GBT" in type(learner).__name__
    path = scratch_path(spark, "model")
    learner.write().overwrite().save(path)
    trees = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("tree"), F.lit(2.0 * boosted) * F.col("_3") + F.lit(1.0 - boosted) / learner.getNumTrees
    ).toDF("tree", "factor")
    node = F.col("nodeData")
    stats = node["impurityStats"]
    weight = stats[0] if boosted else F.aggregate(stats, F.lit(0.0), lambda total, x: total + x)
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("id"),
        node["leftChild"].alias("left"),
        node["rightChild"].alias("right"),
        node["split"]["featureIndex"].alias("feature"),
        F.get(node["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"),
        weight.alias("weight"),
        (node["prediction"] if boosted else stats[1] / weight).alias("prediction"),
    )
    return nodes.join(trees, "tree").groupBy("tree").applyInPandas(_leaves_of_tree, LEAVES)


def _leaves_of_tree(nodes: pd.DataFrame) -> pd.DataFrame:
    members = {n.id: n for n in nodes.itertuples()}
    leaves, pending = [], [(members[0], {})]
    while pending:
        node, conditions = pending.pop()
        if node.left < 0:
            bounds = [list(part) for part in zip(*conditions.values())] or [[], [], []]
            leaves.append((node.factor * node.prediction, list(conditions), *bounds))
            continue
        low, high, share = conditions.get(node.feature, (-np.inf, np.inf, 1.0))
        for index, edges in (
            (node.left, (low, min(high, node.threshold))),
            (node.right, (max(low, node.threshold), high)),
        ):
            child = members[index]
            pending.append((child, {**conditions, node.feature: (*edges, share * child.weight / node.weight)}))
    return pd.DataFrame(leaves, columns=["leaf_value", "feature", "low", "high", "share"])


def tree_paths(learner: Transformer, spark: SparkSession) -> list[tuple[float, list[tuple]]]:
    """The leaves of a small ensemble on the driver, to look at: (value, [(feature, low, high, share)])."""
    return [
        (r.leaf_value, list(zip(r.feature, r.low, r.high, r.share))) for r in tree_leaves(learner, spark).collect()
    ]


def as_leaves(spark: SparkSession, leaves: Sequence[tuple[float, Sequence[tuple]]]) -> DataFrame:
    """Leaves as :func:`tree_paths` lists them, as a table."""
    rows = [
        (float(value), *[[kind(c[i]) for c in conditions] for i, kind in enumerate((int, float, float, float))])
        for value, conditions in leaves
    ]
    return spark.createDataFrame(rows, LEAVES)


@lru_cache
def _quadrature(features: int) -> list[tuple[float, float]]:
    """Nodes and weights on [0, 1] that integrate a product of one factor less than ``features`` exactly."""
    nodes, weights = np.polynomial.legendre.leggauss((features + 1) // 2)
    return list(zip((nodes + 1) / 2, weights / 2))


def _add_leaf(x, phi, value: float, features, low, high, share) -> float:
    """Add one leaf's Shapley values of rows ``x`` to ``phi``; returns its part of the base value.

    Given the features in a set S, a leaf's share of the prediction is its value times, over the
    features of its path, 1 or 0 for those in S (condition met or not) and the training share for
    the others. The Shapley value of such a product has the closed form
    ``value * (met_j - share_j) * integral over t in [0, 1] of prod_{i != j} (share_i (1-t) + met_i t)``,
    which Gauss-Legendre nodes give exactly, as the integrand is a polynomial in t.
    """
    if not len(features):
        return value
    met = ((x[:, features] > low) & (x[:, features] <= high)).astype(float)
    total = np.zeros_like(met)
    for t, weight in _quadrature(len(features)):
        factors = share * (1 - t) + met * t
        total += weight * factors.prod(axis=1, keepdims=True) / factors
    phi[:, features] += value * (met - share) * total
    return value * share.prod()


def shapley_batches(leaves: list[tuple[float, list[tuple]]], width: int):
    """A batch function computing (base value, Shapley values) of a tree ensemble for rows ``x``."""
    prepared = [
        (value, *(np.array(part) for part in zip(*conditions))) if conditions else (value, [], [], [], [])
        for value, conditions in leaves
    ]

    def explain(x):
        phi = np.zeros((len(x), width))
        return sum(_add_leaf(x, phi, *leaf) for leaf in prepared), phi

    return explain


class _Block:
    """Rows held while the leaves of all trees pass by."""

    def __init__(self, width: int) -> None:
        self.parts: list[np.ndarray] = []
        self.x: np.ndarray | None = None
        self.base, self.width = 0.0, width

    def take(self, part: pd.DataFrame) -> None:
        """More of the block's rows, or more leaves once all rows are there."""
        is_row = part["x"].notna()
        self.parts.extend(part.loc[is_row, "x"])
        leaves = part[~is_row]
        if leaves.empty or not self.parts:
            return
        if self.x is None:
            self.x = np.stack(self.parts)
            self.phi = np.zeros((len(self.x), self.width))
        for leaf in leaves.itertuples():
            self.base += _add_leaf(self.x, self.phi, leaf.leaf_value, leaf.feature, leaf.low, leaf.high, leaf.share)

    def sums(self, log_odds: bool) -> pd.DataFrame:
        if self.x is None:
            return pd.DataFrame({"feature_index": [], "total": [], "rows": []})
        value = self.base + self.phi
        totals = (1.0 / (1.0 + np.exp(-value)) if log_odds else value).sum(axis=0)
        return pd.DataFrame({"feature_index": range(self.width), "total": totals, "rows": len(self.x)})


def shapley_summary(
    learner: Transformer,
    vectors: DataFrame,
    names: Sequence[str],
    key: str,
    k: int = SHAPLEY_ROWS,
) -> DataFrame:
    """Top features per class by the mean of ``base + shapley value`` as a probability, over all rows.

    Boosted trees add up log-odds, which a sigmoid turns into probabilities; forests average probabilities
    already. Class 0 is one minus class 1. Batches return sums per feature, never per-row values.
    """
    leaves = tree_leaves(learner, vectors.sparkSession)
    return leaf_summary(leaves, vectors, names, key, isinstance(learner, GBTClassificationModel), k)


def leaf_summary(
    leaves: DataFrame,
    vectors: DataFrame,
    names: Sequence[str],
    key: str,
    log_odds: bool,
    k: int = SHAPLEY_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """:func:`shapley_summary` of an ensemble given by its leaves, see :func:`tree_leaves`.

    Rows are spread over blocks by a hash of ``key``, about ``block_rows`` to a block at most, and every block meets
    every leaf: a block's rows come first in its partition, then the leaves stream past. A task holds one block and
    one batch of leaves, whatever the size of the model. A leaf travels once per block, that is once per
    ``block_rows`` rows it is evaluated for.
    """
    spark = vectors.sparkSession
    width = len(names)
    blocks = max(spark.sparkContext.defaultParallelism, -(-vectors.count() // block_rows))

    def block_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, at = None, None
        for batch in batches:
            for block, part in batch.groupby("block"):
                if block != at:
                    if held is not None:
                        yield held.sums(log_odds)
                    held, at = _Block(width), block
                held.take(part)
        if held is not None:
            yield held.sums(log_odds)

    rows = vectors.select(
        F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"), vector_to_array("features").alias("x")
    )
    streamed = leaves.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    per_feature = (
        rows.unionByName(streamed, allowMissingColumns=True)
        .repartitionById(blocks, "block")
        .sortWithinPartitions("block", F.col("leaf_value").asc_nulls_first())
        .mapInPandas(block_sums, "feature_index int, total double, rows long")
        .groupBy("feature_index")
        .agg((F.sum("total") / F.sum("rows")).alias("class_1"))
        .join(F.broadcast(_feature_names(spark, names)), "feature_index")
        .withColumn("class_0", 1 - F.col("class_1"))
        .unpivot(["feature"], ["class_1", "class_0"], "class", "mean_abs_shap_value")
    )
    parts = [
        top(per_feature.filter(F.col("class") == c), "mean_abs_shap_value", k, "feature")
        for c in ("class_1", "class_0")
    ]
    return parts[0].unionByName(parts[1])
