"""Logistic regression whose penalty reaches the intercept, with squares or absolute values.

Every step is one pass: tasks add up loss, slope and curvature of their rows at
the current weights, a shuffle adds up the tasks row by row of the curvature
matrix, and the driver solves the penalised quadratic of that size: directly for
squares, by coordinate steps with a soft threshold for absolute values. A step
that does not lower the objective is halved. Classes are fitted one against the
rest; a row's score for a class is its share of the probabilities.

The matrix has a row per feature, so the features are limited, not the rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import written

MAX_FEATURES = 4_096
TOL = 1e-7  # of the optimality conditions, against those at zero weights
HALVINGS = 30
SWEEPS = 1_000  # of the coordinates in one quadratic


def _sums(rows: DataFrame, w, target: float):
    """(loss, slope, curvature) at weights ``w`` for the class ``target`` against the rest."""
    import numpy as np

    d = len(w)

    def add(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros((d + 1, d))  # curvature, then slope
        loss = 0.0
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            x = np.c_[x, np.ones(len(x))]
            y = batch["y"].to_numpy(zero_copy_only=False) == target
            margin = x @ w
            loss += np.logaddexp(0.0, np.where(y, -margin, margin)).sum()
            p = 1 / (1 + np.exp(-np.clip(margin, -700, 700)))
            total[:d] += (x * (p * (1 - p))[:, None]).T @ x
            total[d] += x.T @ (p - y)
        cells = [r.tobytes() for r in total] + [np.array([loss]).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array(range(d + 2), pa.int32()), pa.array(cells, pa.binary())], ["i", "cells"])

    def join(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: dict = {}
        for batch in batches:
            for i, cells in zip(batch["i"].to_pylist(), batch["cells"].to_pylist()):
                v = np.frombuffer(cells)
                held[i] = held[i] + v if i in held else v
        if held:
            cells = pa.array([v.tobytes() for v in held.values()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), cells], ["i", "cells"])

    kind = "i int, cells binary"
    found = rows.mapInArrow(add, kind).repartition("i").mapInArrow(join, kind)
    parts = {r["i"]: np.frombuffer(r["cells"]) for r in found.collect()}  # one row a feature
    return float(parts[d + 1][0]), parts[d].copy(), np.stack([parts[i] for i in range(d)])


def _violation(w, slope, l1: bool):
    """How far each weight is from its condition of the optimum."""
    import numpy as np

    if not l1:
        return np.abs(w + slope)
    return np.where(w != 0, np.abs(slope + np.sign(w)), np.maximum(np.abs(slope) - 1, 0))


def _step(w, slope, curvature, l1: bool):
    """The step to the optimum of the penalised quadratic."""
    import numpy as np

    if not l1:
        return np.linalg.solve(curvature + np.eye(len(w)), -(w + slope))
    after, pull = w.copy(), slope.copy()  # pull: slope of the quadratic at ``after``
    for _ in range(SWEEPS):
        moved = 0.0
        for j in range(len(w)):
            bend = curvature[j, j] + 1e-12
            free = after[j] - pull[j] / bend
            new = np.sign(free) * max(abs(free) - 1 / bend, 0.0)
            if new != after[j]:
                pull += curvature[:, j] * (new - after[j])
                moved = max(moved, abs(new - after[j]))
                after[j] = new
        if moved < 1e-10:
            break
    return after - w


def fit_one(rows: DataFrame, width: int, target: float, c: float, l1: bool, steps: int):
    """Weights, the intercept last, of one class against the rest."""
    import numpy as np

    w = np.zeros(width + 1)

    def at(v):
        loss, slope, curvature = _sums(rows, v, target)
        penalty = np.abs(v).sum() if l1 else v @ v / 2
        return penalty + c * loss, c * slope, c * curvature

    value, slope, curvature = at(w)
    first = _violation(w, slope, l1).max()
    for _ in range(steps):
        if _violation(w, slope, l1).max() <= TOL * max(first, 1e-300):
            break
        step = _step(w, slope, curvature, l1)
        for _ in range(HALVINGS):
            ahead = at(w + step)
            if ahead[0] < value:
                break
            step = step / 2
        else:
            break  # no step lowers the objective any more
        w, (value, slope, curvature) = w + step, ahead
    return w


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Columns of the estimator and of its model."""


class PenalisedLogistic(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Penalised logistic regression; ``settings`` as JSON: c, l1, steps, classes."""

    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", settings=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PenalisedModel:
        s = json.loads(self.getOrDefault(self.settings))
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")
        )
        rows = written(rows, "penalised-rows")
        width = rows.agg(F.max(F.size("x"))).first()[0]
        if width is None:
            raise ValueError("no rows to learn from")
        if width > MAX_FEATURES:
            raise ValueError(f"over {MAX_FEATURES} features: use the lbfgs solver")
        targets = [1.0] if s["classes"] <= 2 else [float(k) for k in range(s["classes"])]
        weights = [fit_one(rows, width, t, s["c"], s["l1"], s["steps"]).tolist() for t in targets]
        return PenalisedModel(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            weights=json.dumps(weights),
        )


class PenalisedModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Weights of each class, the intercept last, as JSON; one row for two classes."""

    weights = Param(Params._dummy(), "weights", "weights as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", weights=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        shares = []
        for *w, intercept in json.loads(self.getOrDefault(self.weights)):
            products = F.zip_with(x, F.array(*map(F.lit, w)), lambda a, b: a * b)
            margin = F.aggregate(products, F.lit(float(intercept)), lambda total, v: total + v)
            shares.append(1 / (1 + F.exp(-margin)))
        if len(shares) == 1:
            shares = [1 - shares[0], shares[0]]
        scored = dataset.withColumn("_shares", F.array(*shares))
        total = F.aggregate("_shares", F.lit(0.0), lambda a, v: a + v)
        top = F.array_position("_shares", F.array_max("_shares")) - 1  # equal shares go to the lowest class
        return (
            scored.withColumn("probability", array_to_vector(F.transform("_shares", lambda v: v / total)))
            .withColumn(self.getPredictionCol(), top.cast("double"))
            .drop("_shares")
        )
