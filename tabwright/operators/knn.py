"""Exact nearest neighbours between two tables, and the models that vote on them.

No pair of rows is ever emitted. Training rows are placed in the cell of their
nearest pivot; a query first searches the cells around it for k rows, and that
distance then rules out every cell the triangle inequality puts further away.
Cells are cut into blocks of bounded size, so a cell holding a third of the rows
is many blocks; a block answers with at most k rows per query. Which blocks a
query visits never depends on a cap, so the neighbours are exact.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions.schema import quoted
from tabwright.session import written

MAX_PIVOTS = 256
TRAIN_BLOCK = 8192
QUERY_BLOCK = 4096
SLACK = 1e-9


def feature_array(df: DataFrame, features: str | Sequence[str]) -> Column:
    """array<double> of a vector or array column, or of several number columns."""
    if not isinstance(features, str):
        return F.array(*[F.col(quoted(f)).cast("double") for f in features])
    if isinstance(df.schema[features].dataType, VectorUDT):
        return vector_to_array(F.col(quoted(features)))
    return F.col(quoted(features)).cast("array<double>")


def _distances(rows: np.ndarray, point: np.ndarray, metric: str) -> np.ndarray:
    diff = rows - point
    return np.abs(diff).sum(axis=1) if metric == "manhattan" else np.sqrt((diff * diff).sum(axis=1))


def _pivot_distances(rows: np.ndarray, pivots: np.ndarray, metric: str) -> np.ndarray:
    return np.stack([_distances(rows, p, metric) for p in pivots], axis=1)


def _manhattan_candidates(queries: np.ndarray, train: np.ndarray, k: int):
    """For each query the training rows that may be among its k nearest, by sums in single precision and their error."""
    with np.errstate(over="ignore", invalid="ignore"):
        rough_train, rough_queries = train.astype(np.float32), queries.astype(np.float32)
        room, ones = np.empty_like(rough_train), np.ones(train.shape[1], np.float32)
        # roundings of the inputs, the differences and their sum
        error = (train.shape[1] + 8) * 2.0**-23 * (np.abs(train).sum(axis=1).max() + np.abs(queries).sum(axis=1))
        for query, slack in zip(rough_queries, error):
            np.abs(np.subtract(rough_train, query, out=room), out=room)
            rough = (room @ ones).astype(float)
            sound = np.isfinite(slack) and np.isfinite(rough).all()
            # too small for single precision is off by at most its least step
            limit = np.partition(rough, k - 1)[k - 1] + 2 * slack + 1e-30
            yield np.flatnonzero(rough <= limit) if sound else np.arange(len(train))


def _block_neighbours(queries, train, ids, k: int, metric: str):
    """(query row, train row, distance) of the k nearest in one block, ties to the lower id."""
    for start in range(0, len(queries), 256):
        part = queries[start : start + 256]
        if len(train) <= k:
            near = [np.arange(len(train))] * len(part)
        elif metric == "manhattan":
            near = _manhattan_candidates(part, train, k)
        else:
            # the product form picks candidates; distances are then taken from differences
            qq, tt = (part * part).sum(axis=1), (train * train).sum(axis=1)
            rough = qq[:, None] + tt[None, :] - 2.0 * part @ train.T
            limit = np.partition(rough, k - 1, axis=1)[:, k - 1]
            limit = limit + SLACK * (qq + tt.max()) + SLACK
            near = [np.flatnonzero(rough[i] <= limit[i]) for i in range(len(part))]
        for i, candidates in enumerate(near):
            d = _distances(train[candidates], part[i], metric)
            if len(d) > k:
                kept = d <= np.partition(d, k - 1)[k - 1]
                candidates, d = candidates[kept], d[kept]
            best = np.lexsort((ids[candidates], d))[:k]
            yield start + i, candidates[best], d[best]


def _matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1)


def _search_blocks(queries: DataFrame, train: DataFrame, k: int, metric: str) -> DataFrame:
    """At most k (qid, tid, distance) per query and block."""
    id_type = pa.int64()

    def block(left: pa.Table, right: pa.Table) -> pa.Table:
        found_q, found_t, found_d = [], [], []
        if left.num_rows and right.num_rows:
            q, t = _matrix(left["qx"], left.num_rows), _matrix(right["tx"], right.num_rows)
            qid, tid = left["qid"].to_numpy(), right["tid"].to_numpy()
            for i, rows, d in _block_neighbours(q, t, tid, k, metric):
                found_q.append(np.full(len(rows), qid[i]))
                found_t.append(tid[rows])
                found_d.append(d)
        empty = np.array([])
        return pa.table(
            {
                "qid": pa.array(np.concatenate(found_q) if found_q else empty, id_type),
                "tid": pa.array(np.concatenate(found_t) if found_t else empty, id_type),
                "distance": pa.array(np.concatenate(found_d) if found_d else empty, pa.float64()),
            }
        )

    keys = ["cell", "t_chunk", "q_chunk"]
    return (
        queries.groupBy(*keys)
        .cogroup(train.groupBy(*keys))
        .applyInArrow(block, "qid long, tid long, distance double")
    )


def _best(candidates: DataFrame, k: int) -> DataFrame:
    """The k nearest per query; Catalyst limits each group before the shuffle."""
    order = Window.partitionBy("qid").orderBy("distance", "tid")
    return candidates.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _visit(visits: DataFrame, placed: DataFrame, sizes: dict[int, int], k: int, metric: str) -> DataFrame:
    """Search the cells named by ``visits`` (qid, qx, cell), in blocks bounded on both sides."""
    asked = {r["cell"]: r["n"] for r in visits.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    top = max(sizes) + 1
    t_chunks = F.array(*[F.lit(math.ceil(sizes.get(c, 0) / TRAIN_BLOCK) or 1) for c in range(top)])
    q_chunks = F.array(*[F.lit(math.ceil(asked.get(c, 0) / QUERY_BLOCK)) for c in range(top)])
    n_t, n_q = F.get(t_chunks, F.col("cell")), F.get(q_chunks, F.col("cell"))
    numbers = F.transform(F.sequence(F.lit(1), n_t), lambda i: i - 1)
    left = visits.withColumn("q_chunk", F.pmod(F.xxhash64("qid"), n_q).cast("int")).withColumn(
        "t_chunk", F.explode(numbers)
    )
    right = (
        placed.filter(n_q > 0)
        .withColumn("t_chunk", F.pmod(F.xxhash64("tid"), n_t).cast("int"))
        .withColumn("q_chunk", F.explode(F.transform(F.sequence(F.lit(1), n_q), lambda i: i - 1)))
    )
    return _search_blocks(left, right, k, metric)


def nearest_neighbors(
    queries: DataFrame,
    train: DataFrame,
    k: int,
    features: str | Sequence[str] = "features",
    id_col: str = "id",
    metric: str = "euclidean",
) -> DataFrame:
    """(qid, tid, distance, rank) of the k nearest training rows of every query row.

    ``id_col`` is a whole number unique within each table. Equal distances are
    ordered by training id.
    """
    if metric not in ("euclidean", "manhattan"):
        raise ValueError(f"unknown metric {metric!r}")
    key = F.col(quoted(id_col)).cast("long")
    q = queries.select(key.alias("qid"), feature_array(queries, features).alias("qx"))
    t = train.select(key.alias("tid"), feature_array(train, features).alias("tx"))

    n_train = t.count()
    if n_train == 0:
        return q.select("qid", F.lit(None).cast("long").alias("tid"), F.lit(None).cast("double").alias("distance"), F.lit(0).alias("rank")).limit(0)
    n_pivots = max(1, min(MAX_PIVOTS, math.isqrt(n_train) // 4))
    # at most MAX_PIVOTS rows, chosen by a digest of the id
    chosen = t.orderBy(F.xxhash64("tid"), "tid").limit(n_pivots).select("tx").collect()
    pivots = np.unique(np.array([r["tx"] for r in chosen], dtype=float), axis=0)

    @F.pandas_udf("cell int, reach double")
    def place(x: pd.Series) -> pd.DataFrame:
        d = _pivot_distances(np.stack(x.to_numpy()), pivots, metric)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "reach": d[np.arange(len(d)), cell]})

    placed = t.withColumn("_p", place("tx")).select("tid", "tx", "_p.cell", "_p.reach")
    placed = written(placed, "knn-train")
    cells = {
        r["cell"]: (r["n"], r["radius"])
        for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("radius")).collect()
    }
    sizes = {c: n for c, (n, _) in cells.items()}
    n_of = np.array([cells.get(c, (0, 0.0))[0] for c in range(len(pivots))])
    radius = np.array([cells.get(c, (0, 0.0))[1] for c in range(len(pivots))])
    wanted = min(k, n_train)

    @F.pandas_udf("array<int>")
    def first_cells(x: pd.Series) -> pd.Series:
        d = _pivot_distances(np.stack(x.to_numpy()), pivots, metric)
        out = []
        for order in d.argsort(axis=1, kind="stable"):
            enough = np.searchsorted(np.cumsum(n_of[order]), wanted) + 1
            out.append([int(c) for c in order[:enough] if n_of[c]])
        return pd.Series(out)

    @F.pandas_udf("array<int>")
    def further_cells(x: pd.Series, bound: pd.Series, seen: pd.Series) -> pd.Series:
        d = _pivot_distances(np.stack(x.to_numpy()), pivots, metric)
        gap = np.maximum(d - radius, (d - d.min(axis=1, keepdims=True)) / 2)
        limit = bound.to_numpy()[:, None] * (1 + SLACK) + SLACK
        reach = (gap <= limit) & (n_of > 0)
        return pd.Series(
            [[int(c) for c in np.flatnonzero(row) if c not in set(s)] for row, s in zip(reach, seen)]
        )

    start = q.withColumn("seen", first_cells("qx"))
    near = _visit(start.select("qid", "qx", F.explode("seen").alias("cell")), placed, sizes, k, metric)
    near = written(_best(near, k).select("qid", "tid", "distance"), "knn-near")
    bounds = near.groupBy("qid").agg(F.max("distance").alias("bound"))
    rest = start.join(bounds, "qid").select(
        "qid", "qx", F.explode(further_cells("qx", "bound", "seen")).alias("cell")
    )
    rest = written(rest, "knn-rest")
    far = _visit(rest, placed, sizes, k, metric)
    return _best(near.unionByName(far), k)


def knn_predict(
    queries: DataFrame,
    train: DataFrame,
    label: str,
    k: int = 5,
    features: str | Sequence[str] = "features",
    id_col: str = "id",
    metric: str = "euclidean",
    weights: str = "uniform",
    task: str = "classification",
) -> DataFrame:
    """(id, prediction): the vote, or the mean, of the k nearest labels.

    ``distance`` weighs by 1/d; a query that meets training rows at distance 0
    listens to those alone. A tied vote goes to the lowest label.
    """
    if weights not in ("uniform", "distance"):
        raise ValueError(f"unknown weights {weights!r}")
    found = nearest_neighbors(queries, train, k, features, id_col, metric)
    labels = train.select(F.col(quoted(id_col)).cast("long").alias("tid"), F.col(quoted(label)).alias("label"))
    found = found.join(labels, "tid")
    if weights == "distance":
        touching = F.min("distance").over(Window.partitionBy("qid")) == 0
        d = F.col("distance")
        weight = F.when(touching, (d == 0).cast("double")).otherwise(1 / F.nullif(d, F.lit(0.0)))
    else:
        weight = F.lit(1.0)
    found = found.withColumn("weight", weight)
    if task == "regression":
        w = F.col("weight")
        answer = found.groupBy("qid").agg(
            (F.sum(w * F.col("label").cast("double")) / F.sum(w)).alias("prediction")
        )
    else:
        votes = found.groupBy("qid", "label").agg(F.sum("weight").alias("votes"))
        highest = Window.partitionBy("qid").orderBy(F.col("votes").desc(), "label")
        answer = (
            votes.withColumn("_r", F.row_number().over(highest))
            .filter("_r = 1")
            .select("qid", F.col("label").alias("prediction"))
        )
    return answer.withColumnRenamed("qid", id_col)
