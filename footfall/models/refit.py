"""Second-order leaf values for boosted trees, which give the penalties of gradient boosting their meaning.

A tree's splits stay as they were fitted. Its leaf values become ``-G / (H + reg_lambda)``, with G and H the weighted sums of
the log-loss's first and second derivatives over the rows of the leaf, at the margin of the trees before it: one
group-by a tree. ``reg_alpha`` shrinks G, ``min_child_weight`` is the H below which a leaf adds nothing, ``max_delta_step``
bounds a value before the step size is applied.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType

from footfall.models.learners import BOOSTING_DEFAULTS
from footfall.session import cut_lineage, staging

# Penalties that change nothing but the denominator of a leaf.
PENALTIES = {"reg_lambda": 1.0, "reg_alpha": 0.0, "min_child_weight": 1.0, "max_delta_step": 0.0}
LEAVES = "_leaves"
#: Trees whose values are added to the margin by one expression before it is stored.
BLOCK = 20


def leaf_values(
    rows: DataFrame,
    leaf: str,
    label: str,
    margin: str,
    weight: str,
    step_size: float = 1.0,
    reg_lambda: float = PENALTIES["reg_lambda"],
    reg_alpha: float = PENALTIES["reg_alpha"],
    min_child_weight: float = PENALTIES["min_child_weight"],
    max_delta_step: float = PENALTIES["max_delta_step"],
) -> DataFrame:
    """Per leaf: rows, sums of gradients and Hessians, and the value it adds to the margin."""
    p = 1 / (1 + F.exp(-F.col(margin)))
    sums = rows.groupBy(leaf).agg(
        F.count("*").alias("rows"),
        F.sum(F.col(weight) * (p - F.col(label))).alias("gradient"),
        F.sum(F.col(weight) * p * (1 - p)).alias("hessian"),
    )
    shrunk = F.signum("gradient") * F.greatest(F.abs("gradient") - reg_alpha, F.lit(0.0))
    value = -F.try_divide(shrunk, F.col("hessian") + reg_lambda)
    if max_delta_step > 0:
        value = F.greatest(F.lit(-max_delta_step), F.least(F.lit(max_delta_step), value))
    enough = F.col("hessian") >= min_child_weight
    return sums.withColumn("value", F.when(enough, F.coalesce(value, F.lit(0.0)) * step_size).otherwise(0.0))


def _added(margin: Column, place: int, values: list[float]) -> Column:
    return margin + F.get(F.lit(values), F.get(LEAVES, F.lit(place)).cast("int"))


def refitted_values(
    learner: GBTClassificationModel, rows: DataFrame, settings: Mapping[str, object] | None = None
) -> list[list[float]]:
    """Leaf values of all trees, one after the other; ``rows`` have ``features``, ``label`` and ``weight``.

    A tree's sums, as many as it has leaves, reach the driver.
    """
    given = {**BOOSTING_DEFAULTS, **(settings or {})}
    penalties = {k: float(given.get(k, v)) for k, v in PENALTIES.items()}
    sizes = [(tree.numNodes + 1) // 2 for tree in learner.trees]
    found: list[list[float]] = []
    with staging(rows.sparkSession):
        told = learner.copy({learner.leafCol: LEAVES}).transform(rows)
        now = cut_lineage(
            told.select("label", "weight", vector_to_array(LEAVES).alias(LEAVES), F.lit(0.0).alias("margin"))
        )
        for place, size in enumerate(sizes):
            with_leaf = now.withColumn("leaf", F.get(LEAVES, F.lit(place)).cast("int"))
            sums = leaf_values(
                with_leaf, "leaf", "label", "margin", "weight", float(given["learning_rate"]), **penalties
            ).collect()
            values = [0.0] * size
            for row in sums:
                values[row.leaf] = row.value
            found.append(values)
            now = now.withColumn("margin", _added(F.col("margin"), place, values))
            if (place + 1) % BLOCK == 0:
                now = cut_lineage(now)
    return found


class LeafScores(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction`` from the leaves that a tree ensemble puts every row in."""

    values = Param(Params._dummy(), "values", "leaf values of every tree as text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, values: str = "[]"):
        super().__init__()
        self._set(**self._input_kwargs)

    def leaf_values(self) -> list[list[float]]:
        return json.loads(self.getOrDefault(self.values))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        stored = self.leaf_values()
        first = np.cumsum([0, *map(len, stored)])[:-1]
        flat = np.array([v for values in stored for v in values] or [0.0])

        @F.pandas_udf(DoubleType())
        def chance(leaves: pd.Series) -> pd.Series:
            if not len(leaves):
                return pd.Series([], dtype=float)
            margin = flat[np.stack(leaves.to_numpy()).astype(np.int64) + first].sum(axis=1)
            return pd.Series(1 / (1 + np.exp(-margin)))

        both = dataset.withColumn("_p", chance(vector_to_array(LEAVES)))
        return both.withColumns(
            {
                "probability": array_to_vector(F.array(1 - F.col("_p"), F.col("_p"))),
                "prediction": (F.col("_p") > 0.5).cast("double"),
            }
        ).drop("_p", LEAVES)


def refit(model: PipelineModel, rows: DataFrame, settings: Mapping[str, object] | None = None) -> PipelineModel:
    """A fitted pipeline that ends in boosted trees, its leaf values refitted on ``rows`` under the penalties."""
    *before, learner = model.stages
    vectors = PipelineModel(list(before)).transform(rows)
    values = refitted_values(learner, vectors, settings)
    silent = {learner.leafCol: LEAVES, learner.predictionCol: "", learner.probabilityCol: "", learner.rawPredictionCol: ""}
    return PipelineModel([*before, learner.copy(silent), LeafScores(values=json.dumps(values))])


def log_loss(scored: DataFrame, label: str, chance: str, weight: str) -> float:
    """Weighted mean log-loss: one number."""
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(chance)))
    loss = -(F.col(label) * F.log(p) + (1 - F.col(label)) * F.log(1 - p))
    found = scored.agg((F.sum(F.col(weight) * loss) / F.sum(weight)).alias("loss")).first().loss
    return math.nan if found is None else found
