"""Support vector machines with a Gaussian kernel, solved in the dual.

Rows are dealt into blocks; each block's task solves its own dual problem by
steps on pairs of coefficients and hands on the rows that carry weight. The
carriers of two blocks are solved together, and so on until one set is left.
All rows are then held against that solution: rows that violate it, and are not
in the set, go through the cascade again together with the set, until there is
no violator. The solution is then that of all rows, to the tolerance.

Where rows repeat, ``REPEATS`` times on average at least, equal ones are one row
whose weight may grow to as many times the limit of one: the same problem, as
only the sum of the weights of equal rows counts.

Classes are compared in pairs that vote. For regression the loss is zero inside
a tube of width ``epsilon``, so rows inside carry no weight.

The set of carriers is the model: every task that scores or solves holds it.
Where it would be too large the approximate kernel is the way to go.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import written

BLOCK_ROWS = 2_000
GAP = 1e-3  # largest violation of a solved block
VIOLATION = 2e-3  # of a row that goes through the cascade again
COLUMN_BYTES = 64 << 20  # kernel columns that a task keeps
REPEATS = 4  # rows to a different one from which equal rows are one
MAX_STEPS = 2_000_000
MAX_ROUNDS = 100

CARRIERS = "pair int, id long, x array<double>, y double, weight double, count long"


def gaussian(a, b, gamma: float):
    """Kernel of every row of ``a`` with every row of ``b``."""
    import numpy as np

    d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None]
    return np.exp(-gamma * np.maximum(d, 0.0))


class _Columns:
    """Kernel columns, the last ones kept."""

    def __init__(self, x, gamma: float):
        self.x, self.gamma, self.kept = x, gamma, {}
        self.limit = max(2, COLUMN_BYTES // (8 * max(len(x), 1)))

    def __getitem__(self, i: int):
        column = self.kept.pop(i, None)
        if column is None:
            if len(self.kept) >= self.limit:
                del self.kept[next(iter(self.kept))]
            column = gaussian(self.x, self.x[i : i + 1], self.gamma)[:, 0]
        self.kept[i] = column
        return column


def solve(x, y, c, gamma: float, epsilon: float | None, weights):
    """(weights, bias) of the dual problem of the rows, from feasible ``weights``.

    ``c`` is the limit of all weights or of each.
    A classifier has y of -1 and 1; with ``epsilon`` y is the number to fit. A
    row's weight is its coefficient in the decision function. Pairs are chosen by
    the second-order gain and moved to their best places inside the box, until
    no pair violates the conditions by more than ``GAP``.
    """
    import numpy as np

    n = len(x)
    c = np.broadcast_to(np.asarray(c, float), n)
    kernel = _Columns(x, gamma)
    if epsilon is None:
        sign, linear = y.astype(float), -np.ones(n)
        a = weights * sign
        row = np.arange(n)
    else:  # two coefficients a row, of opposite sign
        sign = np.r_[np.ones(n), -np.ones(n)]
        linear = np.r_[epsilon - y, epsilon + y]
        a = np.r_[np.maximum(weights, 0), np.maximum(-weights, 0)]
        row, c = np.r_[np.arange(n), np.arange(n)], np.r_[c, c]
    decision = np.zeros(n)
    for i in np.flatnonzero(weights):
        decision += weights[i] * kernel[i]
    slope = sign * decision[row] + linear
    tiny = 1e-12 * c
    for _ in range(MAX_STEPS):
        up = np.where(sign > 0, a < c - tiny, a > tiny)
        down = np.where(sign > 0, a > tiny, a < c - tiny)
        score = -sign * slope
        i = int(np.where(up, score, -np.inf).argmax())
        if not up[i]:
            break
        low = np.where(down, score, np.inf)
        if score[i] - low.min() < GAP:
            break
        column = kernel[row[i]]
        gap = score[i] - low
        curve = np.maximum(2 - 2 * column[row], 1e-12)  # a Gaussian kernel is 1 on the diagonal
        j = int(np.where(gap > 0, gap * gap / curve, -np.inf).argmax())
        step = gap[j] / curve[j]
        room_i = c[i] - a[i] if sign[i] > 0 else a[i]
        room_j = a[j] if sign[j] > 0 else c[j] - a[j]
        step = min(step, room_i, room_j)
        a[i] += sign[i] * step
        a[j] -= sign[j] * step
        slope += sign * step * (column - kernel[row[j]])[row]
    score = -sign * slope
    free = (a > tiny) & (a < c - tiny)
    if free.any():
        bias = float(score[free].mean())
    else:
        up = np.where(sign > 0, a < c - tiny, a > tiny)
        down = np.where(sign > 0, a > tiny, a < c - tiny)
        high = score[up].max() if up.any() else score.max()
        bias = float((high + (score[down].min() if down.any() else score.min())) / 2)
    a[a <= tiny] = 0.0
    return (a * sign if epsilon is None else a[:n] - a[n:]), bias


def _solved(group: DataFrame, c: float, gamma: float, epsilon: float | None, base: dict, keys: list[str]) -> DataFrame:
    """Carriers of every group of (pair, id, x, y, weight); those of ``base`` by pair join each group."""
    bias_too = [*CARRIERS.split(", "), "bias double"]

    def work(pdf):
        import numpy as np
        import pandas as pd

        pair = int(pdf["pair"].iloc[0])
        ids, y, w, count = pdf["id"].to_numpy(), pdf["y"].to_numpy(float), pdf["weight"].to_numpy(float), pdf["count"].to_numpy()
        x = np.stack(pdf["x"].to_numpy()).astype(float)
        if pair in base:
            held_id, held_x, held_y, held_w, held_count = base[pair]
            # the set itself is feasible; what the group brings starts from nothing
            fresh = ~np.isin(ids, held_id)
            ids, y = np.r_[held_id, ids[fresh]], np.r_[held_y, y[fresh]]
            w, x = np.r_[held_w, np.zeros(fresh.sum())], np.vstack([held_x, x[fresh]])
            count = np.r_[held_count, count[fresh]]
        else:
            # carriers of two blocks: each half is feasible, and a row may come from both
            ids, first = np.unique(ids, return_index=True)
            x, y, w, count = x[first], y[first], np.zeros(len(first)), count[first]
        w, bias = solve(x, y, c * count, gamma, epsilon, w)
        held = w != 0
        if not held.any():
            held[:1] = True  # the bias needs a row to travel with
        return pd.DataFrame(
            {"pair": np.int32(pair), "id": ids[held], "x": list(x[held]), "y": y[held], "weight": w[held], "count": count[held], "bias": bias}
        )

    return group.groupBy("pair", *keys).applyInPandas(work, ", ".join(bias_too))


def _cascade(rows: DataFrame, n: int, c: float, gamma: float, epsilon: float | None, base: dict) -> DataFrame:
    """Carriers of all ``rows`` and ``base``: blocks first, then pairs of blocks until one is left."""
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    found = written(_solved(dealt, c, gamma, epsilon, base, ["block"]), "support")
    while blocks > 1:
        merged = F.pmod(F.xxhash64("id"), F.lit(blocks))
        blocks = math.ceil(blocks / 2)
        # every block's set holds the base already; a row of the base would be dealt to one place, which is enough
        halves = found.drop("bias").withColumn("block", F.pmod(merged, F.lit(blocks)))
        found = written(_solved(halves, c, gamma, epsilon, base, ["block"]), "support")
    return found


def _carriers(found: DataFrame) -> dict:
    """(ids, x, y, weights, counts, bias) by pair: the model."""
    import numpy as np

    table = found.toArrow()  # carriers only
    pairs = table["pair"].to_numpy()
    x = np.stack(table["x"].to_pylist()) if len(pairs) else np.empty((0, 0))
    columns = [table[name].to_numpy() for name in ("id", "y", "weight", "count", "bias")]
    out = {}
    for pair in np.unique(pairs).tolist():
        at = np.flatnonzero(pairs == pair)
        ids, y, weight, count, bias = (column[at] for column in columns)
        out[pair] = (ids, x[at], y, weight, count, float(bias[0]))
    return out


def _violators(rows: DataFrame, model: dict, gamma: float, epsilon: float | None) -> DataFrame:
    """Rows that break the conditions of the solution and are not among its carriers."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            y = batch["y"].to_numpy(zero_copy_only=False)
            pairs, ids = batch["pair"].to_numpy(), batch["id"].to_numpy()
            out = np.zeros(batch.num_rows, bool)
            for pair, (held, hx, _, weight, _, bias) in model.items():
                at = np.flatnonzero((pairs == pair) & ~np.isin(ids, held))
                for part in np.array_split(at, max(1, len(at) * len(held) // 4_000_000)):
                    value = gaussian(x[part], hx, gamma) @ weight + bias
                    wrong = y[part] * value < 1 - VIOLATION if epsilon is None else np.abs(y[part] - value) > epsilon + VIOLATION
                    out[part] = wrong
            yield batch.filter(pa.array(out))

    return rows.mapInArrow(work, CARRIERS)


def fit_dual(rows: DataFrame, c: float, gamma: float, epsilon: float | None = None) -> dict:
    """Carriers and bias by pair of (pair, id, x, y), over all rows; ids are unique in a pair."""
    table = written(
        rows.select("pair", "id", "x", "y", F.lit(0.0).alias("weight"), F.lit(1).cast("long").alias("count")), "support-rows"
    )
    size = table.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("pair", "x", "y")).alias("different")).first()
    if not size["n"]:
        raise ValueError("no rows to learn from")
    if size["n"] >= REPEATS * size["different"]:
        equal = table.groupBy("pair", "x", "y").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("count"))
        table = written(equal.select("pair", "id", "x", "y", F.lit(0.0).alias("weight"), "count"), "support-equal")
    todo, n = table, table.count()
    model: dict = {}
    for _ in range(MAX_ROUNDS):
        base = {pair: held[:5] for pair, held in model.items()}
        model |= _carriers(_cascade(todo, n, c, gamma, epsilon, base))
        todo = written(_violators(table, model, gamma, epsilon), "support-violators")
        n = todo.count()
        if not n:
            return {pair: (*held[:4], held[5]) for pair, held in model.items()}
    raise RuntimeError("rows still violate the solution; the approximate kernel may serve")


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Columns of the estimator and of its model."""


class DualSupport(Estimator, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Exact kernel machine; with ``epsilon`` a regression."""

    c = Param(Params._dummy(), "c", "largest weight of a row", TypeConverters.toFloat)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    epsilon = Param(Params._dummy(), "epsilon", "half the width of the tube", TypeConverters.toFloat)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", c=1.0, gamma=1.0, epsilon=None, classes=2):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SupportModel:
        rows = dataset.select(
            vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("label")
        )
        rows = written(rows.withColumn("id", F.monotonically_increasing_id()), "support-source")
        epsilon = self.getOrDefault(self.epsilon) if self.isSet(self.epsilon) else None
        k = max(2, self.getOrDefault(self.classes))
        if epsilon is not None:
            pairs = rows.select(F.lit(0).alias("pair"), "id", "x", F.col("label").alias("y"))
        else:
            # a row takes part in the pairs of its class with every other
            others = F.transform(
                F.sequence(F.lit(0), F.lit(k - 1)),
                lambda b: F.struct(
                    (F.least("label", b) * k + F.greatest("label", b)).cast("int").alias("pair"),
                    b.alias("other"),
                    F.when(F.col("label") > b, 1.0).otherwise(-1.0).alias("y"),
                ),
            )
            other = F.explode(others).alias("o")
            pairs = rows.select("id", "x", "label", other).filter("o.other != label").select("o.pair", "id", "x", "o.y")
        model = fit_dual(pairs, self.getOrDefault(self.c), self.getOrDefault(self.gamma), epsilon)
        held = {
            "gamma": self.getOrDefault(self.gamma),
            "classes": 0 if epsilon is not None else k,
            "pairs": {str(p): {"x": x.tolist(), "weight": w.tolist(), "bias": b} for p, (_, x, _, w, b) in model.items()},
        }
        return SupportModel(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            carriers=json.dumps(held),
        )


class SupportModel(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """Carriers, weights and biases as JSON. ``decision`` holds a value a pair of classes, or the number."""

    carriers = Param(Params._dummy(), "carriers", "the model as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", carriers=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def description(self) -> dict:
        return json.loads(self.getOrDefault(self.carriers))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = self.description
        gamma, k = held["gamma"], held["classes"]
        pairs = sorted((int(p), v) for p, v in held["pairs"].items())

        @F.arrow_udf("array<double>")
        def decide(x):
            import numpy as np
            import pyarrow as pa

            table = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            out = np.zeros((len(table), len(pairs) + 1))
            votes = np.zeros((len(table), max(k, 1)))
            for at, (pair, v) in enumerate(pairs):
                hx, weight = np.array(v["x"]), np.array(v["weight"])
                for part in np.array_split(np.arange(len(table)), max(1, len(table) * len(hx) // 4_000_000)):
                    out[part, at + 1] = gaussian(table[part], hx, gamma) @ weight + v["bias"]
                if k:
                    winner = np.where(out[:, at + 1] > 0, pair % k, pair // k)
                    votes[np.arange(len(table)), winner] += 1
            out[:, 0] = votes.argmax(1) if k else out[:, 1]
            offsets = np.arange(0, out.size + 1, out.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(out.ravel()))

        scored = dataset.withColumn("_decided", decide(vector_to_array(F.col(self.getFeaturesCol()))))
        return (
            scored.withColumn(self.getPredictionCol(), F.col("_decided")[0])
            .withColumn("decision", F.slice("_decided", 2, len(pairs)))
            .drop("_decided")
        )
