"""From named feature columns to one scaled vector, fitted on the training rows only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from footfall.operators.audit import class_balance, named_binary


@dataclass(frozen=True)
class FeatureNames:
    """Feature columns in the order of the vector: numeric ones first, then 0/1 ones."""

    numeric: tuple[str, ...]
    binary: tuple[str, ...]

    @classmethod
    def of(cls, columns: Sequence[str]) -> FeatureNames:
        binary = set(named_binary(columns))
        return cls(
            tuple(c for c in columns if c not in binary), tuple(c for c in columns if c in binary)
        )

    @property
    def ordered(self) -> list[str]:
        return [*self.numeric, *self.binary]


def vector_stages(names: FeatureNames, rows: int) -> list[Estimator | Transformer]:
    """Standardise numeric columns, pass 0/1 columns through, assemble ``features``.

    Spark's scaler divides by the sample deviation; the constant factor turns that into the
    population deviation over the ``rows`` training rows. Constant columns become 0.
    """
    factor = math.sqrt(rows / (rows - 1)) if rows > 1 else 1.0
    return [
        VectorAssembler(inputCols=list(names.numeric), outputCol="_numeric"),
        StandardScaler(inputCol="_numeric", outputCol="_sample_scaled", withMean=True, withStd=True),
        ElementwiseProduct(
            scalingVec=Vectors.dense([factor] * len(names.numeric)),
            inputCol="_sample_scaled",
            outputCol="_scaled",
        ),
        VectorAssembler(inputCols=["_scaled", *names.binary], outputCol="features"),
    ]


def as_vectors(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Apply only the feature stages of a fitted model: ``keep`` columns and ``features``."""
    stages = PipelineModel(model.stages[:-1])
    return stages.transform(df).select(*keep, "features")


def with_class_weight(df: DataFrame, label: str = "label", weight: str = "weight") -> DataFrame:
    """Weigh positive rows by negatives over positives, so both classes count the same."""
    ratio = class_balance(df, label).select("scale_pos_weight").scalar()
    return df.withColumn(weight, F.when(F.col(label) == 1, ratio).otherwise(F.lit(1.0)))
