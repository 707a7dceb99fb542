"""The one-row record of a training run."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from footfall.operators.metrics import classification_report, optimal_threshold, roc_auc
from footfall.operators.shape import attach_one_row


def top_features_json(summary: DataFrame, which: str) -> DataFrame:
    """The ranked features of one class as a JSON list of records, best first."""
    record = F.struct("feature", "mean_abs_shap_value")
    ranked = F.sort_array(
        F.collect_list(F.struct(F.col("mean_abs_shap_value").alias("order"), record.alias("record"))), False
    )
    return summary.filter(F.col("class") == which).agg(
        F.to_json(F.transform(ranked, lambda r: r["record"])).alias("features")
    )


def performance_record(
    held_out: DataFrame,
    shapley: DataFrame,
    model_type: str,
    banner: str,
    week_identifier: str,
    trained_at: dt.datetime,
    feature_columns: Sequence[str],
    settings: Mapping[str, object],
) -> DataFrame:
    """Metrics, threshold, settings and top features of one model, 23 fields.

    ``held_out`` has ``actual``, ``predicted`` and ``predicted_proba``. With one class only there is no area
    under the curve and so no threshold: these fields are null.
    """
    report = classification_report(held_out, "actual", "predicted")
    with_auc = attach_one_row(report, roc_auc(held_out, "actual", "predicted_proba"))
    measured = attach_one_row(with_auc, optimal_threshold(held_out, "actual", "predicted_proba"), optional=True)
    ranked = F.col("roc_auc").isNotNull()
    return (
        measured.withColumns(
            {
                "optimal_threshold": F.when(ranked, F.col("optimal_threshold")),
                "optimal_f1": F.when(ranked, F.col("optimal_f1")),
                "model_type": F.lit(model_type),
                "banner": F.lit(banner),
                "train_timestamp": F.lit(trained_at.strftime("%Y-%m-%d %H:%M:%S")),
                "feature_cols": F.array(*[F.lit(c) for c in feature_columns]),
                "hyperparameters": F.lit(json.dumps(dict(settings), ensure_ascii=False)),
                "top_20_shap_features_class_1": top_features_json(shapley, "class_1").scalar(),
                "top_20_shap_features_class_0": top_features_json(shapley, "class_0").scalar(),
                "week_identifier": F.lit(week_identifier),
            }
        )
        .select(
            "model_type",
            "banner",
            "roc_auc",
            "precision_0",
            "recall_0",
            "f1_0",
            "support_0",
            "precision_1",
            "recall_1",
            "f1_1",
            "support_1",
            "accuracy",
            "support_total",
            "macro_f1",
            "weighted_f1",
            "train_timestamp",
            "feature_cols",
            "hyperparameters",
            "optimal_threshold",
            "optimal_f1",
            "top_20_shap_features_class_1",
            "top_20_shap_features_class_0",
            "week_identifier",
        )
        .na.fill(0, [c for c in report.columns if c != "class"])
    )
