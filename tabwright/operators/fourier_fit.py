"""Linear machines on random Fourier features that are not stored.

MLlib's machines keep all their training rows as blocks of doubles: 1 KB a row
for ``COMPONENTS`` features, many times the table. Here the rows are written
once as they are, a few to a record, and every pass draws the waves of a block
of rows anew and adds up loss and slope. Records stay small, as Spark holds
thousands of them at once for each task. The objectives are MLlib's: the hinge loss, or Huber's
with its scale among the unknowns, and half the squared weights times ``reg``.
The driver takes limited-memory quasi-Newton steps on one number a feature, over
standardised waves (and a standardised target for Huber's loss), which does not
change the optimum. A step that does not lower the objective enough is halved.
Classes are fitted one against the rest.

Decisions: the passes end after ``steps`` steps or when the objective falls by
less than ``TOL`` of it; the sums of a task are added in the order of the tasks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.fourier import projection
from tabwright.session import written

BLOCK_ROWS = 2_048
RECORD_BYTES = 1_024  # of a record of written rows, or one row where that is more
MEMORY = 10  # steps the quasi-Newton directions remember
TOL = 1e-6  # as MLlib's
HALVINGS = 30
HUBER = 1.35  # MLlib's epsilon


class Waves:
    """Waves of up to ``BLOCK_ROWS`` rows at a time; an answer holds until the next one.

    Angles are doubles, their cosines single precision, six times as fast and 6e-8 off.
    """

    def __init__(self, weights, shifts):
        self.weights, self.shifts = weights, shifts
        self.height = math.sqrt(2.0 / len(shifts))
        self.angles = np.empty((BLOCK_ROWS, len(shifts)))
        self.single = np.empty((BLOCK_ROWS, len(shifts)), np.float32)

    def __call__(self, x):
        angles, single = self.angles[: len(x)], self.single[: len(x)]
        np.matmul(x, self.weights, out=angles)
        angles += self.shifts
        if max(angles.max(), -angles.min()) > 64:  # too long for single precision
            angles -= 2 * math.pi * np.rint(angles / (2 * math.pi))
        np.cos(angles, out=single, dtype=np.float32, casting="same_kind")
        return np.multiply(single, self.height, out=angles, casting="same_kind")


def _records(rows: DataFrame) -> DataFrame:
    """Rows (x, y) as raw doubles, y last, as many to a record as ``RECORD_BYTES`` holds."""

    def pack(batches: Iterator) -> Iterator:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            table = np.column_stack([x, batch["y"].to_numpy(zero_copy_only=False)])
            each = max(1, RECORD_BYTES // (8 * table.shape[1]))
            records = [table[at : at + each].tobytes() for at in range(0, len(table), each)]
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["rows"])

    return written(rows.mapInArrow(pack, "rows binary"), "fourier-rows")


def _summed(records: DataFrame, weights, shifts, add):
    """Sum over blocks of all rows of the arrays ``add(waves, y)``; one row a task comes to the driver."""

    def kernel(batches: Iterator) -> Iterator:
        total, waves_of = None, Waves(weights, shifts)
        for batch in batches:
            table = np.frombuffer(b"".join(batch["rows"].to_pylist())).reshape(-1, len(weights) + 1)
            for at in range(0, len(table), BLOCK_ROWS):
                part = table[at : at + BLOCK_ROWS]
                found = add(waves_of(part[:, :-1]), part[:, -1])
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["cells"])

    return sum(np.frombuffer(r["cells"]) for r in records.mapInArrow(kernel, "cells binary").collect())


def hinge(margin, y, sigma):
    """(loss, its slope by the margin, nothing by a scale) of each row; ``y`` is 1 or -1."""
    short = 1 - y * margin
    return np.maximum(short, 0), np.where(short > 0, -y, 0.0), np.zeros(len(y))


def huber(margin, y, sigma):
    """(loss, its slope by the margin, its slope by the scale) of each row."""
    z = y - margin
    near = np.abs(z) <= sigma * HUBER
    loss = 0.5 * np.where(near, sigma + z * z / sigma, sigma + 2 * HUBER * np.abs(z) - sigma * HUBER**2)
    slope = np.where(near, -z / sigma, -HUBER * np.sign(z))
    return loss, slope, 0.5 * np.where(near, 1 - (z / sigma) ** 2, 1 - HUBER**2)


def minimise(value_and_slope, start, steps: int):
    """Limited-memory BFGS with halved steps; ``value_and_slope`` gives infinity outside its domain."""
    at = start
    value, slope = value_and_slope(at)
    pairs: list = []
    for _ in range(steps):
        if not np.abs(slope).max() > 0:
            break
        step, shares = -slope, []
        for s, g in reversed(pairs):
            shares.append(s @ step / (s @ g))
            step = step - shares[-1] * g
        if pairs:
            s, g = pairs[-1]
            step = step * (s @ g / (g @ g))
        else:
            step = step / max(np.linalg.norm(slope), 1.0)
        for (s, g), share in zip(pairs, reversed(shares)):
            step = step + s * (share - g @ step / (s @ g))
        fall = slope @ step
        for _ in range(HALVINGS):
            ahead = value_and_slope(at + step)
            if ahead[0] <= value + 1e-4 * fall:
                break
            step, fall = step / 2, fall / 2
        else:
            if not pairs:
                break
            pairs = []  # a kink: go on from the plain slope
            continue
        change = ahead[1] - slope
        if step @ change > 1e-12 * (change @ change):
            pairs = [*pairs, (step, change)][-MEMORY:]
        won = value - ahead[0]
        at, (value, slope) = at + step, ahead
        if won <= TOL * max(abs(value), 1e-300):
            break
    return at


def fit_waves(records: DataFrame, weights, shifts, reg: float, steps: int, target: float | None) -> list[float]:
    """Weight of each wave and the intercept: of class ``target`` against the rest, or of a number."""
    n_waves = len(shifts)

    def moments(waves, y):
        return np.r_[len(y), y.sum(), (y * y).sum(), waves.sum(axis=0), np.einsum("ij,ij->j", waves, waves)]

    n, y_sum, y_square, *sums = _summed(records, weights, shifts, moments)
    mean, square = np.array(sums[:n_waves]) / n, np.array(sums[n_waves:]) / n
    spread = np.sqrt(np.maximum(square - mean * mean, 0))
    inverse = np.where(spread > 1e-12, 1 / np.maximum(spread, 1e-300), 0.0)  # a constant wave has no weight
    middle, unit = 0.0, 1.0
    if target is None:
        middle = y_sum / n
        unit = float(np.sqrt(max(y_square / n - middle * middle, 0))) or 1.0
    loss_of = huber if target is None else hinge

    def value_and_slope(v):
        w, intercept = v[:n_waves], v[n_waves]
        sigma = v[n_waves + 1] if target is None else 1.0
        if sigma <= 0:
            return np.inf, v
        own = w * inverse
        offset = intercept - own @ mean

        def add(waves, y):
            goal = (y - middle) / unit if target is None else np.where(y == target, 1.0, -1.0)
            loss, by_margin, by_sigma = loss_of(waves @ own + offset, goal, sigma)
            return np.r_[loss.sum(), by_margin @ waves, by_margin.sum(), by_sigma.sum()]

        found = _summed(records, weights, shifts, add) / n
        slope = (found[1 : n_waves + 1] - mean * found[n_waves + 1]) * inverse
        # half the squared weights on the waves as they are, in units of the target
        value = found[0] + 0.5 * reg * unit * (own @ own)
        slope = slope + reg * unit * own * inverse
        return value, np.r_[slope, found[n_waves + 1 : len(v) + 1]]

    start = np.zeros(n_waves + 1 + (target is None))
    if target is None:
        start[-1] = 1.0
    v = minimise(value_and_slope, start, steps)
    own = v[:n_waves] * inverse
    return [*(own * unit).tolist(), float(middle + unit * (v[n_waves] - own @ mean))]


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Columns of the estimator and of its model."""

    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)


class WaveMachine(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Machine on Fourier features; ``settings`` as JSON: dim, gamma, seed, components, reg, steps, classes (0: a number)."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", settings=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> WaveModel:
        s = json.loads(self.getOrDefault(self.settings))
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )
        records = _records(rows)
        if records.isEmpty():
            raise ValueError("no rows to learn from")
        weights, shifts = projection(s["dim"], s["components"], s["gamma"], s["seed"])
        targets = [None] if not s["classes"] else [1.0] if s["classes"] <= 2 else [float(k) for k in range(s["classes"])]
        fitted = [fit_waves(records, weights, shifts, s["reg"], s["steps"], t) for t in targets]
        return WaveModel(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            settings=json.dumps(s),
            weights=json.dumps(fitted),
        )


class WaveModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Weights of the waves, the intercept last, as JSON; one row for a number or for two classes."""

    weights = Param(Params._dummy(), "weights", "weights as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", settings=None, weights=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = json.loads(self.getOrDefault(self.settings))
        weights, shifts = projection(s["dim"], s["components"], s["gamma"], s["seed"])
        fitted = np.array(json.loads(self.getOrDefault(self.weights)))

        @F.arrow_udf("array<double>")
        def margins(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, s["dim"])
            parts = [rows[at : at + BLOCK_ROWS] for at in range(0, len(rows), BLOCK_ROWS)]
            waves_of = Waves(weights, shifts)
            found = [waves_of(part) @ fitted[:, :-1].T + fitted[:, -1] for part in parts]
            flat = np.concatenate([np.zeros(0), *(f.ravel() for f in found)])
            offsets = np.arange(0, len(flat) + 1, len(fitted), dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

        scored = dataset.withColumn("_margins", margins(vector_to_array(F.col(self.getFeaturesCol()))))
        prediction = F.col("_margins")[0]
        if s["classes"]:
            if len(fitted) == 1:
                scored = scored.withColumn("_margins", F.array(-F.col("_margins")[0], F.col("_margins")[0]))
            scored = scored.withColumn("rawPrediction", array_to_vector("_margins"))
            # equal margins go to the lowest class
            prediction = (F.array_position("_margins", F.array_max("_margins")) - 1).cast("double")
        return scored.withColumn(self.getPredictionCol(), prediction).drop("_margins")
