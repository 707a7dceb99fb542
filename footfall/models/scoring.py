"""Applying fitted models and comparing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from footfall.operators.metrics import roc_auc
from footfall.session import cut_lineage


def score(
    model: PipelineModel, df: DataFrame, keep: Sequence[str], into: str = "predicted_purchase_prob"
) -> DataFrame:
    """``keep`` columns and the probability of class 1 for every row."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(into))


def held_out_predictions(model: PipelineModel, held_out: DataFrame, key: str = "epsilon_id") -> DataFrame:
    """Actual class, predicted class and probability of rows the model was not fitted on, by real id."""
    return model.transform(held_out).select(
        key,
        F.col("label").alias("actual"),
        F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("predicted_proba"),
    )


def model_comparison(models: Mapping[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """Validation and test ROC-AUC per model, best validation first.

    ``rows`` carry ``split`` and ``label``. The scores of all models are stored once and measured
    together.
    """
    scored = [
        score(model, rows.filter("split <> 'train'"), ["split", "label"], "p").withColumn("model", F.lit(name))
        for name, model in models.items()
    ]
    stacked = scored[0]
    for more in scored[1:]:
        stacked = stacked.unionByName(more)
    return compared(cut_lineage(stacked))


def compared(stacked: DataFrame) -> DataFrame:
    """ROC-AUC per model of stored ``model, split, label, p`` rows, best validation first."""
    return (
        roc_auc(stacked, "label", "p", ["model", "split"])
        .groupBy("model")
        .pivot("split", ["validation", "test"])
        .agg(F.round(F.first("roc_auc"), 4))
        .withColumnsRenamed({"validation": "validation_auc", "test": "test_auc"})
        .orderBy(F.col("validation_auc").desc(), "model")
    )


def best_model(comparison: DataFrame) -> str:
    """Name of the model with the greatest validation ROC-AUC: one value reaches the driver."""
    return comparison.orderBy(F.col("validation_auc").desc(), "model").first().model
