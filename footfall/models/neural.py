"""A neural net with row weights, batch normalisation and dropout, fitted by data-parallel gradient descent.

Rows are packed into chunks of about ``CHUNK`` by a hash of their key and stored once, a matrix a chunk. Every step
takes the chunks of one round of the epoch; each task sums the gradients of its chunks, the sums meet in ``LANES`` groups
and their total, as large as the net and independent of the rows, updates the weights on the driver (Adam).
Chunks normalise by their own mean and deviation and draw their own dropout from (seed, step, chunk), so
a fit does not depend on how rows are partitioned.
"""

from __future__ import annotations

import base64
import io
import json
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark import TaskContext, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from footfall.session import cut_lineage

# Layers, dropout after each, rows a chunk, epochs, epochs without gain before the end, step size.
HIDDEN_LAYERS = (128, 64, 32)
DROPOUT = (0.3, 0.2, 0.0)
CHUNK = 256
EPOCHS = 50
PATIENCE = 5
STEP_SIZE = 0.001
SEED = 42

#: Updates an epoch at most, groups the sums meet in, score bins of the area under the curve that ends a fit.
STEPS = 8
LANES = 16
BINS = 4096
MOMENTUM = 0.9
EPSILON = 1e-3

Weights = dict[str, np.ndarray]


@dataclass(frozen=True)
class Shape:
    """What a net is made of."""

    inputs: int
    hidden: tuple[int, ...] = HIDDEN_LAYERS
    dropout: tuple[float, ...] = DROPOUT
    normalise: bool = True

    def start(self, seed: int) -> Weights:
        """Glorot-uniform weights, zero offsets, unit scales."""
        chance, found, width = np.random.default_rng(seed), {}, self.inputs
        for i, units in enumerate((*self.hidden, 1)):
            limit = math.sqrt(6 / (width + units))
            found[f"w{i}"], found[f"b{i}"] = chance.uniform(-limit, limit, (width, units)), np.zeros(units)
            if self.normalise and i < len(self.hidden):
                found[f"scale{i}"], found[f"shift{i}"] = np.ones(units), np.zeros(units)
            width = units
        return found


def forward(shape: Shape, weights: Weights, means: Weights, x: np.ndarray) -> np.ndarray:
    """Log-odds of rows by a fitted net: no dropout, stored means and deviations."""
    a = x
    for i in range(len(shape.hidden)):
        a = np.maximum(a @ weights[f"w{i}"] + weights[f"b{i}"], 0.0)
        if shape.normalise:
            a = (a - means[f"mean{i}"]) / np.sqrt(means[f"var{i}"] + EPSILON) * weights[f"scale{i}"] + weights[f"shift{i}"]
    last = len(shape.hidden)
    return (a @ weights[f"w{last}"] + weights[f"b{last}"])[:, 0]


def gradient(
    shape: Shape, weights: Weights, x: np.ndarray, y: np.ndarray, w: np.ndarray, chance: np.random.Generator | None
) -> tuple[float, Weights, Weights]:
    """Weighted cross-entropy summed over a chunk, its gradient, and the chunk's means and variances times its rows.

    Without ``chance`` nothing is dropped.
    """
    n, kept, found, seen = len(x), [], {}, {}
    a = x
    for i in range(len(shape.hidden)):
        z = a @ weights[f"w{i}"] + weights[f"b{i}"]
        r = np.maximum(z, 0.0)
        hat = deviation = None
        out = r
        if shape.normalise:
            mean, var = r.mean(axis=0), r.var(axis=0)
            seen[f"mean{i}"], seen[f"var{i}"] = mean * n, var * n
            deviation = np.sqrt(var + EPSILON)
            hat = (r - mean) / deviation
            out = hat * weights[f"scale{i}"] + weights[f"shift{i}"]
        share = shape.dropout[i] if chance is not None else 0.0
        mask = None if share == 0.0 else (chance.random(out.shape) >= share) / (1 - share)
        kept.append((a, z, hat, deviation, mask))
        a = out if mask is None else out * mask
    last = len(shape.hidden)
    odds = (a @ weights[f"w{last}"] + weights[f"b{last}"])[:, 0]
    loss = float((w * (np.logaddexp(0.0, odds) - y * odds)).sum())
    delta = (w * (1 / (1 + np.exp(-odds)) - y))[:, None]
    found[f"w{last}"], found[f"b{last}"] = a.T @ delta, delta.sum(axis=0)
    back = delta @ weights[f"w{last}"].T
    for i in reversed(range(last)):
        before, z, hat, deviation, mask = kept[i]
        if mask is not None:
            back = back * mask
        if shape.normalise:
            found[f"scale{i}"], found[f"shift{i}"] = (back * hat).sum(axis=0), back.sum(axis=0)
            inner = back * weights[f"scale{i}"]
            back = (inner - inner.mean(axis=0) - hat * (inner * hat).mean(axis=0)) / deviation
        back = back * (z > 0)
        found[f"w{i}"], found[f"b{i}"] = before.T @ back, back.sum(axis=0)
        back = back @ weights[f"w{i}"].T
    return loss, found, seen


def _flat(parts: Weights) -> np.ndarray:
    return np.concatenate([parts[k].ravel() for k in sorted(parts)]) if parts else np.zeros(0)


def _unflat(values: np.ndarray, like: Weights) -> Weights:
    found, place = {}, 0
    for k in sorted(like):
        size = like[k].size
        found[k] = values[place : place + size].reshape(like[k].shape)
        place += size
    return found


def packed(rows: DataFrame, key: str, label: str, weight: str, chunk_rows: int = CHUNK) -> tuple[DataFrame, int]:
    """Rows with ``features`` as stored chunks ``chunk, n, x, y, w``, and how many chunks there are."""
    chunks = max(1, math.ceil(rows.count() / chunk_rows))

    def pack(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values("key", kind="stable")
        x = np.stack(batch["x"].to_numpy()).astype("<f8")
        return pd.DataFrame(
            {
                "chunk": batch["chunk"].iloc[:1].to_numpy(),
                "n": [len(batch)],
                "x": [x.tobytes()],
                "y": [batch["y"].to_numpy(dtype="<f8").tobytes()],
                "w": [batch["w"].to_numpy(dtype="<f8").tobytes()],
            }
        )

    named = rows.select(
        F.col(key).cast("string").alias("key"),
        vector_to_array("features").alias("x"),
        F.col(label).cast("double").alias("y"),
        F.col(weight).cast("double").alias("w"),
    )
    told = named.withColumn("chunk", F.pmod(F.xxhash64("key"), F.lit(chunks)))
    return cut_lineage(told.groupBy("chunk").applyInPandas(pack, "chunk long, n int, x binary, y binary, w binary")), chunks


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for chunk, n, x, y, w in zip(batch["chunk"], batch["n"], batch["x"], batch["y"], batch["w"]):
            yield int(chunk), np.frombuffer(x).reshape(n, -1), np.frombuffer(y), np.frombuffer(w)


def _total(sums: DataFrame) -> np.ndarray | None:
    """Sum of the arrays of all rows: in ``LANES`` groups first where there are many."""

    def add(batch: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in batch["total"]], axis=0)
        return pd.DataFrame({"lane": batch["lane"].iloc[:1].to_numpy(), "total": [total.tobytes()]})

    if sums.rdd.getNumPartitions() > LANES:
        sums = sums.groupBy("lane").applyInPandas(add, "lane int, total binary")
    rows = sorted(sums.collect(), key=lambda r: r.lane)
    return np.sum([np.frombuffer(r.total) for r in rows], axis=0) if rows else None


def _summed(frame: DataFrame, work: Callable[[Iterator], np.ndarray | None]) -> np.ndarray | None:
    def batches(found: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = work(_chunks(found))
        if total is not None:
            yield pd.DataFrame({"lane": [TaskContext.get().partitionId() % LANES], "total": [total.tobytes()]})

    return _total(frame.mapInPandas(batches, "lane int, total binary"))


def step_sums(frame: DataFrame, shape: Shape, weights: Weights, step: int, seed: int) -> tuple[float, float, Weights, Weights]:
    """(rows, loss, gradient, means and variances) summed over the chunks of a frame."""
    context = frame.sparkSession.sparkContext
    sent = context.broadcast(weights)

    def work(chunks: Iterator) -> np.ndarray | None:
        total = None
        for chunk, x, y, w in chunks:
            chance = np.random.default_rng((seed, step, chunk))
            loss, found, seen = gradient(shape, sent.value, x, y, w, chance)
            one = np.concatenate(([len(x), loss], _flat(found), _flat(seen)))
            total = one if total is None else total + one
        return total

    total = _summed(frame, work)
    sent.destroy()
    if total is None:
        return 0.0, 0.0, {}, {}
    n_weights = sum(v.size for v in weights.values())
    like = {f"{k}{i}": np.zeros(u) for i, u in enumerate(shape.hidden) for k in ("mean", "var") if shape.normalise}
    return float(total[0]), float(total[1]), _unflat(total[2 : 2 + n_weights], weights), _unflat(total[2 + n_weights :], like)


def binned_auc(frame: DataFrame, shape: Shape, weights: Weights, means: Weights) -> float:
    """Area under the curve over ``BINS`` bins of the probability, pairs in one bin counted as one half."""
    sent = frame.sparkSession.sparkContext.broadcast((weights, means))

    def work(chunks: Iterator) -> np.ndarray:
        counts = np.zeros((2, BINS))
        for _, x, y, _ in chunks:
            p = 1 / (1 + np.exp(-forward(shape, *sent.value, x)))
            places = np.minimum((p * BINS).astype(int), BINS - 1)
            np.add.at(counts, ((y > 0).astype(int), places), 1)
        return counts.ravel()

    total = _summed(frame, work)
    sent.destroy()
    negative, positive = total.reshape(2, BINS)
    pairs = negative.sum() * positive.sum()
    return float((positive * (np.cumsum(negative) - negative / 2)).sum() / pairs) if pairs else math.nan


def fit_weights(
    train: DataFrame,
    chunks: int,
    shape: Shape,
    validation: DataFrame | None = None,
    epochs: int = EPOCHS,
    step_size: float = STEP_SIZE,
    seed: int = SEED,
) -> tuple[Weights, Weights, list[tuple[float, float]]]:
    """Weights, stored means and variances, and (mean loss, validation area) of every epoch, of packed rows.

    With ``validation`` the fit ends after ``PATIENCE`` epochs without gain and the best epoch's weights
    are kept.
    """
    weights, means = shape.start(seed), {}
    first = {k: np.zeros_like(v) for k, v in weights.items()}
    second = {k: np.zeros_like(v) for k, v in weights.items()}
    steps, done, history = min(STEPS, chunks), 0, []
    best, best_area, best_epoch = (weights, means), -math.inf, 0
    for epoch in range(epochs):
        rows_seen = loss_seen = 0.0
        for part in range(steps):
            round_rows = train.filter(F.pmod("chunk", F.lit(steps)) == part) if steps > 1 else train
            rows, loss, found, seen = step_sums(round_rows, shape, weights, epoch * steps + part, seed)
            if not rows:
                continue
            done += 1
            rows_seen, loss_seen = rows_seen + rows, loss_seen + loss
            keep = 0.0 if not means else MOMENTUM
            means = {k: keep * means.get(k, 0.0) + (1 - keep) * v / rows for k, v in seen.items()}
            updated = {}
            for k, v in weights.items():
                g = found[k] / rows
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                ahead = first[k] / (1 - 0.9**done)
                updated[k] = v - step_size * ahead / (np.sqrt(second[k] / (1 - 0.999**done)) + 1e-7)
            weights = updated
        area = math.nan if validation is None else binned_auc(validation, shape, weights, means)
        history.append((loss_seen / rows_seen if rows_seen else math.nan, area))
        if validation is None or math.isnan(area):
            best = (weights, means)
        elif area > best_area:
            best, best_area, best_epoch = (weights, means), area, epoch
        elif epoch - best_epoch >= PATIENCE:
            break
    return *best, history


class NetModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted net: adds ``probability`` and ``prediction`` to rows with ``features``."""

    state = Param(Params._dummy(), "state", "shape, weights and means as text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, shape: Shape, weights: Weights, means: Weights) -> NetModel:
        raw = io.BytesIO()
        np.savez(raw, **weights, **means)
        made = {"shape": [shape.inputs, list(shape.hidden), list(shape.dropout), shape.normalise]}
        return cls(state=json.dumps({**made, "arrays": base64.b64encode(raw.getvalue()).decode()}))

    def net(self) -> tuple[Shape, Weights, Weights]:
        stored = json.loads(self.getOrDefault(self.state))
        inputs, hidden, dropout, normalise = stored["shape"]
        arrays = dict(np.load(io.BytesIO(base64.b64decode(stored["arrays"]))))
        means = {k: v for k, v in arrays.items() if k.startswith(("mean", "var"))}
        return (
            Shape(inputs, tuple(hidden), tuple(dropout), normalise),
            {k: v for k, v in arrays.items() if k not in means},
            means,
        )

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shape, weights, means = self.net()

        @F.pandas_udf(DoubleType())
        def chance(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(1 / (1 + np.exp(-forward(shape, weights, means, np.stack(x.to_numpy())))))

        p = chance(vector_to_array("features"))
        both = dataset.withColumn("_p", p)
        return both.withColumns(
            {
                "probability": array_to_vector(F.array(1 - F.col("_p"), F.col("_p")).cast(ArrayType(DoubleType()))),
                "prediction": (F.col("_p") > 0.5).cast("double"),
            }
        ).drop("_p")


class WeightedNet(Estimator):
    """Fits a :class:`NetModel` on ``features``, ``label`` and ``weight``; rows are told apart by ``key``.

    Rows flagged in ``validation_flag`` are not fitted on; they end the fit.
    """

    def __init__(
        self,
        key: str,
        hidden: Sequence[int] = HIDDEN_LAYERS,
        dropout: Sequence[float] = DROPOUT,
        normalise: bool = True,
        epochs: int = EPOCHS,
        step_size: float = STEP_SIZE,
        validation_flag: str | None = None,
        label: str = "label",
        weight: str = "weight",
    ) -> None:
        super().__init__()
        self.shape = Shape(0, tuple(hidden), tuple(dropout), normalise)
        self.key, self.epochs, self.step_size = key, epochs, step_size
        self.validation_flag, self.label, self.weight = validation_flag, label, weight

    def _fit(self, dataset: DataFrame) -> NetModel:
        fitted, held = dataset, None
        if self.validation_flag:
            fitted = dataset.filter(~F.col(self.validation_flag))
            held, _ = packed(dataset.filter(self.validation_flag), self.key, self.label, self.weight)
        chunked, chunks = packed(fitted, self.key, self.label, self.weight)
        first = chunked.select(F.length("x").alias("size"), "n").head()
        if first is None:
            raise ValueError("no rows to fit a net on")
        shape = replace(self.shape, inputs=first["size"] // 8 // first["n"])
        weights, means, _ = fit_weights(chunked, chunks, shape, held, self.epochs, self.step_size)
        return NetModel.of(shape, weights, means)
