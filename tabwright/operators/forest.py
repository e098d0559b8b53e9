"""Forests without a depth limit.

MLlib grows the top of all trees together, until a node holds about
``NODE_ROWS`` rows. The rows of every open node then go to one task, which
grows it to the end with exact cuts; a node that is still too large is split
once more by a tree of its own before that. A table of at most ``NODE_ROWS``
rows needs no top. Where rows repeat, ``REPEATS`` times on average at least,
equal rows of a node travel as one with the number of their draws, and only
different rows count for these limits.

Rows are drawn for each tree by a digest of the row, with the counts that
drawing with replacement gives. Nodes try a random choice of features, as many
as asked for that are not constant there. The result does not depend on the
partitioning, given the top.

A forest of up to ``HELD_NODES`` nodes is sent to all tasks that score. The
subtrees of a larger one stay in their table: rows go to the subtrees they are
in, and the answers of a row's trees are added up in the order of the trees.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.regression import (
    DecisionTreeRegressionModel,
    DecisionTreeRegressor,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import written

NODE_ROWS = 20_000
OVERSIZED = 4  # times as many rows make a node split once more
REPEATS = 4  # rows to a different one from which equal rows travel as one
TOP_DEPTH = 20
SPLIT_DEPTH = 8
HELD_NODES = 500_000  # nodes that the driver and every scoring task hold; a larger forest meets the rows by joins
MEETING_ROWS = 50_000  # rows that meet a subtree in one task, about
# Shares of rows drawn at most 0, 1, 2, ... times.
DRAWN = [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582, 0.99991676, 0.99998975]

SUBTREES = "tree int, leaf long, feature binary, cut binary, left binary, right binary, value binary, nodes long, depth int"


def grow(x, y, weight, classes: int, tries: int, min_split: int, min_leaf: int, max_depth: int, seed, count=None):
    """Arrays (feature, cut, left, right, value, depth) of a tree grown to the end; ``classes`` 0 is a regression.

    ``count`` tells how many rows each stands for, one where it is not given.
    """
    import numpy as np

    count = np.ones(len(y), np.int64) if count is None else count
    rng = np.random.default_rng(seed)
    feature, cut, left, right, value, depths = [-1], [0.0], [0], [0], [None], [0]
    todo = [(np.arange(len(y)), 0)]
    onehot = np.eye(classes)[y.astype(int)] * weight[:, None] if classes else None
    while todo:
        rows, node = todo.pop()
        w, target = weight[rows], y[rows]
        value[node] = onehot[rows].sum(0) / w.sum() if classes else np.array([(w * target).sum() / w.sum()])
        m = int(count[rows].sum())
        if m < max(min_split, 2 * min_leaf, 2) or (max_depth and depths[node] >= max_depth) or (target == target[0]).all():
            continue
        best, tried = None, 0
        for j in rng.permutation(x.shape[1]).tolist():
            if tried >= tries and best is not None:
                break
            v = x[rows, j]
            order = np.argsort(v, kind="stable")
            ordered = v[order]
            if not ordered[0] < ordered[-1]:
                continue
            tried += 1
            places = np.flatnonzero(ordered[1:] > ordered[:-1]) + 1
            before = np.cumsum(count[rows][order])[places - 1]
            places = places[(before >= min_leaf) & (m - before >= min_leaf)]
            if not len(places):
                continue
            total = np.cumsum(w[order])
            lw, rw = total[places - 1], total[-1] - total[places - 1]
            sums = np.cumsum(onehot[rows][order], axis=0) if classes else np.cumsum((w * target)[order])[:, None]
            low, high = sums[places - 1], sums[-1] - sums[places - 1]
            score = (low * low).sum(1) / lw + (high * high).sum(1) / rw
            at = int(score.argmax())
            if best is None or score[at] > best[0]:
                a, b = ordered[places[at] - 1], ordered[places[at]]
                middle = a + (b - a) / 2
                best = (score[at], j, a if middle >= b else middle)
        if best is None:
            continue
        _, j, threshold = best
        goes = x[rows, j] <= threshold
        feature[node], cut[node], left[node], right[node] = j, threshold, len(feature), len(feature) + 1
        for side in (rows[goes], rows[~goes]):
            todo.append((side, len(feature)))
            for column, empty in ((feature, -1), (cut, 0.0), (left, 0), (right, 0), (value, None), (depths, depths[node] + 1)):
                column.append(empty)
    return np.array(feature, np.int32), np.array(cut), np.array(left, np.int32), np.array(right, np.int32), np.array(value), max(depths)


def _leaf_of(tree, x):
    """The leaf of every row in the arrays of a grown tree."""
    import numpy as np

    feature, cut, left, right, _ = tree
    node = np.zeros(len(x), np.int64)
    live = np.arange(len(x)) if feature[0] >= 0 else np.empty(0, np.int64)
    while len(live):
        at = node[live]
        node[live] = np.where(x[live, feature[at]] <= cut[at], left[at], right[at])
        live = live[feature[node[live]] >= 0]
    return node


def _arrays(row: dict, width: int) -> tuple:
    """Arrays (feature, cut, left, right, value) of a row of subtrees; ``width`` numbers a value."""
    import numpy as np

    kinds = (np.int32, np.float64, np.int32, np.int32, np.float64)
    arrays = [np.frombuffer(row[c], kind) for c, kind in zip(("feature", "cut", "left", "right", "value"), kinds)]
    return (*arrays[:4], arrays[4].reshape(-1, width))


def _shape(node, numbers):
    """A tree of MLlib's as nested (feature, cut or categories, left, right), and numbers of its leaves from left to right as its ``leafCol``."""
    if node.getClass().getSimpleName() == "LeafNode":
        return next(numbers)
    split = node.split()
    continuous = split.getClass().getSimpleName() == "ContinuousSplit"
    test = split.threshold() if continuous else list(split.leftCategories())
    return (split.featureIndex(), test, _shape(node.leftChild(), numbers), _shape(node.rightChild(), numbers))


def _numbers(shape, x):
    """The number of the leaf of every row in a tree given by :func:`_shape`."""
    import numpy as np

    out = np.zeros(len(x), np.int64)
    todo = [(shape, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop()
        if not len(rows):
            continue
        if not isinstance(node, tuple):
            out[rows] = node
            continue
        feature, test, left, right = node
        goes = np.isin(x[rows, feature], test) if isinstance(test, list) else x[rows, feature] <= test
        todo += [(left, rows[goes]), (right, rows[~goes])]
    return out


class _Tops:
    """The trees' tops: which node of which tree a row is in."""

    def __init__(self, trees: int, forest=None, splits=()):
        self.trees, self.forest, self.splits = trees, forest, list(splits)  # (tree, node, first new node, model)
        self.shapes: list = []  # of the models of ``splits``, as far as they were read

    def place(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``_vector``) and ``_nodes``, the node in each tree."""
        if self.forest is None:
            return df.withColumn("_nodes", F.array_repeat(F.lit(0).cast("long"), self.trees))
        quiet = {"predictionCol": "", "featuresCol": "_vector", "leafCol": "_leaf"}
        if self.forest.hasParam("rawPredictionCol"):
            quiet |= {"rawPredictionCol": "", "probabilityCol": ""}
        df = self.forest.copy({self.forest.getParam(k): v for k, v in quiet.items()}).transform(df)
        df = df.withColumn("_nodes", F.transform(vector_to_array("_leaf"), lambda v: v.cast("long"))).drop("_leaf")
        if not self.splits:
            return df
        self.shapes += [_shape(model._java_obj.rootNode(), itertools.count()) for _, _, _, model in self.splits[len(self.shapes) :]]
        moves = [(*split[:3], shape) for split, shape in zip(self.splits, self.shapes)]

        # one step for all splits: a column for each would name the one before it twice
        @F.arrow_udf("array<long>")
        def move(x, nodes):
            import numpy as np
            import pyarrow as pa

            table = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            places = nodes.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1).copy()
            for tree, node, first, shape in moves:
                at = np.flatnonzero(places[:, tree] == node)
                places[at, tree] = first + _numbers(shape, table[at])
            offsets = np.arange(0, places.size + 1, places.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(places.ravel()))

        return df.withColumn("_nodes", move(vector_to_array("_vector"), F.col("_nodes")))


def _drawn(tree, seed: int):
    """How often a row is drawn for a tree."""
    u = F.pmod(F.xxhash64("id", tree, F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    times = F.lit(len(DRAWN))
    for n, share in reversed(list(enumerate(DRAWN))):
        times = F.when(u < share, n).otherwise(times)
    return times


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Columns of the estimator and of its model."""


class DeepForest(Estimator, _Shared, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random forest with ``settings`` as JSON: trees, classes (0: regression), min_split, min_leaf, max_depth (0: none)."""

    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", seed=None, settings=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _top(self, rows: DataFrame, n: int, s: dict) -> tuple[_Tops, int]:
        """MLlib's part of the trees and its depth."""
        if n <= NODE_ROWS:
            return _Tops(s["trees"]), 0
        depth = min(TOP_DEPTH, math.ceil(math.log2(n / NODE_ROWS)) + 1, s["max_depth"] or TOP_DEPTH)
        make = RandomForestClassifier if s["classes"] else RandomForestRegressor
        forest = make(
            featuresCol="_vector",
            labelCol="y",
            numTrees=s["trees"],
            maxDepth=depth,
            minInstancesPerNode=max(s["min_leaf"], s["min_split"]),
            featureSubsetStrategy="sqrt" if s["classes"] else "all",
            seed=self.getSeed(),
        ).fit(rows)
        return _Tops(s["trees"], forest), depth

    def _members(self, tops: _Tops, rows: DataFrame) -> DataFrame:
        """(tree, leaf, id, x, y, _vector, w): the rows drawn for each tree, by the node they are in."""
        placed = tops.place(rows).select("id", "x", "y", "_vector", F.posexplode("_nodes").alias("tree", "leaf"))
        return placed.withColumn("w", _drawn(F.col("tree"), self.getSeed())).filter("w > 0")

    def _together(self, members: DataFrame, repeats: bool) -> DataFrame:
        """(tree, leaf, x, y, w, count, id) of members, equal ones of a node as one if ``repeats``; their id says nothing then."""
        if not repeats:
            return members.select("tree", "leaf", "x", "y", "w", F.lit(1).cast("long").alias("count"), "id")
        sums = F.sum("w").cast("long").alias("w"), F.count(F.lit(1)).alias("count")
        return members.groupBy("tree", "leaf", "x", "y").agg(*sums).withColumn("id", F.lit(0).cast("long"))

    def _split_oversized(self, tops: _Tops, rows: DataFrame, repeats: bool, s: dict) -> None:
        """Give nodes with far more rows than a task should grow a tree of their own, until none can be split."""
        if tops.forest is None:
            return
        settled: set = set()
        first = 1 << 32
        while True:
            members = self._members(tops, rows)
            sizes = self._together(members, repeats).groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > OVERSIZED * NODE_ROWS)
            large = [r for r in sizes.collect() if (r["tree"], r["leaf"]) not in settled]  # few nodes are so large
            if not large:
                return
            for r in large:
                make = DecisionTreeClassifier if s["classes"] else DecisionTreeRegressor
                node = members.filter((F.col("tree") == r["tree"]) & (F.col("leaf") == r["leaf"]))
                learner = make(
                    featuresCol="_vector", labelCol="y", weightCol="w", maxDepth=SPLIT_DEPTH, minInstancesPerNode=max(s["min_leaf"], s["min_split"])
                )
                model = learner.fit(node)
                if model.depth == 0:
                    settled.add((r["tree"], r["leaf"]))
                    continue
                tops.splits.append((r["tree"], r["leaf"], first, model))
                first += 1 << 20

    def _fit(self, dataset: DataFrame) -> DeepForestModel:
        s = json.loads(self.getOrDefault(self.settings))
        features = F.col(self.getFeaturesCol())
        rows = dataset.select(features.alias("_vector"), vector_to_array(features).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        rows = written(rows.withColumn("id", F.monotonically_increasing_id()), "forest-rows")
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("x", "y")).alias("different")).first()
        if not size["n"]:
            raise ValueError("no rows to learn from")
        repeats = size["n"] >= REPEATS * size["different"]
        tops, depth = self._top(rows, size["different"] if repeats else size["n"], s)
        self._split_oversized(tops, rows, repeats, s)
        seed, left_depth = self.getSeed(), s["max_depth"] and max(s["max_depth"] - depth, 0)
        closed = bool(s["max_depth"]) and left_depth == 0

        def finish(pdf):
            import numpy as np
            import pandas as pd

            x, y = np.stack(pdf["x"].to_numpy()), pdf["y"].to_numpy()
            order = np.lexsort((y, *x.T)) if repeats else np.argsort(pdf["id"].to_numpy())
            x, y, w, count = x[order], y[order], pdf["w"].to_numpy(float)[order], pdf["count"].to_numpy()[order]
            tree, leaf = int(pdf["tree"].iloc[0]), int(pdf["leaf"].iloc[0])
            tries = max(1, math.isqrt(x.shape[1])) if s["classes"] else x.shape[1]
            least = count.sum() + 1 if closed else s["min_split"]
            *arrays, deepest = grow(x, y, w, s["classes"], tries, least, s["min_leaf"], left_depth, [seed, tree, leaf], count)
            return pd.DataFrame(
                [(tree, leaf, *[a.tobytes() for a in arrays], len(arrays[0]), deepest)], columns=[c.split(" ")[0] for c in SUBTREES.split(", ")]
            )

        members = self._together(self._members(tops, rows), repeats)
        grown = written(members.groupBy("tree", "leaf").applyInPandas(finish, SUBTREES), "forest-trees")
        model = DeepForestModel(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            settings=self.getOrDefault(self.settings),
        )
        model.tops, model.grown = tops, grown
        return model


class DeepForestModel(Model, _Shared, MLWritable, MLReadable):
    """A grown forest. ``grown`` is the table of subtrees. Classifiers also give ``probability``."""

    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", settings=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.tops: _Tops | None = None
        self.grown: DataFrame | None = None

    def subtrees(self) -> dict:
        """Arrays (feature, cut, left, right, value) by (tree, node of the top)."""
        return {(r["tree"], r["leaf"]): _arrays(r, self._width) for r in self.grown.toArrow().to_pylist()}

    @property
    def _width(self) -> int:
        return max(json.loads(self.getOrDefault(self.settings))["classes"], 1)

    def _with_shares(self, placed: DataFrame) -> DataFrame:
        """``placed`` (with ``_vector`` and ``_nodes``) and ``_shares`` by a model that every task holds."""
        held = placed.sparkSession.sparkContext.broadcast(self.subtrees())
        k = self._width

        @F.arrow_udf("array<double>")
        def answer(x, nodes):
            import numpy as np
            import pyarrow as pa

            table = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            places = nodes.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            total, votes = np.zeros((len(table), k)), np.zeros(len(table))
            for tree in range(places.shape[1]):
                for leaf in np.unique(places[:, tree]).tolist():
                    grown = held.value.get((tree, leaf))
                    if grown is not None:  # a node no row was drawn for has no say
                        at = np.flatnonzero(places[:, tree] == leaf)
                        total[at] += grown[4][_leaf_of(grown, table[at])]
                        votes[at] += 1
            total /= np.maximum(votes, 1)[:, None]
            offsets = np.arange(0, total.size + 1, k, dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(total.ravel()))

        return placed.withColumn("_shares", answer(vector_to_array("_vector"), F.col("_nodes"))).drop("_vector", "_nodes")

    def _with_met_shares(self, placed: DataFrame) -> DataFrame:
        """The same where rows meet the subtrees they are in, and no task holds more than some subtrees."""
        k = self._width
        rows = written(placed.withColumn("_row", F.monotonically_increasing_id()), "forest-scored")
        each = rows.select(F.col("_row").alias("row"), vector_to_array("_vector").alias("x"), F.posexplode("_nodes").alias("tree", "leaf"))
        most = each.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
        slices = math.ceil(most / MEETING_ROWS)
        each = each.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int"))
        grown = self.grown.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
        keys = ["tree", "leaf", "slice"]

        def meet(left, right):
            import pyarrow as pa

            if not left.num_rows or not right.num_rows:  # a node no row was drawn for has no say
                return pa.table([pa.array([], t) for t in types], names)
            x = left["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(left.num_rows, -1)
            tree = _arrays(right.slice(0, 1).to_pylist()[0], k)
            shares = pa.array(tree[4][_leaf_of(tree, x)].tolist(), types[2])
            return pa.table([left["row"].combine_chunks(), left["tree"].combine_chunks().cast(types[1]), shares], names)

        import pyarrow as pa

        names, types = ["row", "tree", "shares"], [pa.int64(), pa.int32(), pa.list_(pa.float64())]
        met = each.groupBy(*keys).cogroup(grown.groupBy(*keys)).applyInArrow(meet, "row long, tree int, shares array<double>")
        said = met.groupBy(F.col("row").alias("_row")).agg(F.array_sort(F.collect_list(F.struct("tree", "shares"))).alias("_said"))
        total = F.aggregate(
            "_said", F.array_repeat(F.lit(0.0), k), lambda acc, s: F.zip_with(acc, s["shares"], lambda a, b: a + b)
        )
        none = F.array_repeat(F.lit(0.0), k)
        shares = F.coalesce(F.transform(total, lambda v: v / F.size("_said")), none)
        return rows.join(said, "_row", "left").withColumn("_shares", shares).drop("_row", "_said", "_vector", "_nodes")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        placed = self.tops.place(dataset.withColumn("_vector", F.col(self.getFeaturesCol())))
        small = (self.grown.agg(F.sum("nodes")).first()[0] or 0) <= HELD_NODES
        scored = self._with_shares(placed) if small else self._with_met_shares(placed)
        if not json.loads(self.getOrDefault(self.settings))["classes"]:
            return scored.withColumn(self.getPredictionCol(), F.col("_shares")[0]).drop("_shares")
        top = F.array_position("_shares", F.array_max("_shares")) - 1  # equal shares go to the lowest class
        return (
            scored.withColumn("probability", array_to_vector("_shares"))
            .withColumn(self.getPredictionCol(), top.cast("double"))
            .drop("_shares")
        )

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: DeepForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        tops = self.model.tops
        splits = [(t, node, first) for t, node, first, _ in tops.splits]
        extra = {"trees": tops.trees, "topped": tops.forest is not None, "splits": splits}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)
        self.model.grown.write.parquet(f"{path}/grown")
        if tops.forest is not None:
            tops.forest.write().save(f"{path}/top")
        for at, (_, _, _, model) in enumerate(tops.splits):
            model.write().save(f"{path}/split-{at}")


class _Reader(MLReader):
    def load(self, path: str) -> DeepForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = DeepForestModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        classify = json.loads(model.getOrDefault(model.settings))["classes"] > 0
        whole, single = (
            (RandomForestClassificationModel, DecisionTreeClassificationModel)
            if classify
            else (RandomForestRegressionModel, DecisionTreeRegressionModel)
        )
        forest = whole.load(f"{path}/top") if metadata["topped"] else None
        splits = [(*s, single.load(f"{path}/split-{at}")) for at, s in enumerate(metadata["splits"])]
        model.tops = _Tops(metadata["trees"], forest, splits)
        model.grown = self.sparkSession.read.parquet(f"{path}/grown")
        return model
