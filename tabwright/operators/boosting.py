"""Boosted trees from gradient and curvature histograms.

Rows are binned once and written with one byte a feature. A round grows one
tree, or with a softmax one tree per class on a shared state of probabilities.
Every pass over the rows adds up, for each wanted node, feature and bin, the
gradients, the curvatures and the rows; tasks add up their own rows, a shuffle
adds up the tasks. Only the smaller child of a split is summed from rows, its
sibling is the parent minus it, and both are searched for their best split where
the sums lie, so the driver sees one candidate per node and partition. Where the
sums of all tasks are few (``NEAR_BYTES``), the driver adds and searches them
itself, with the same whole numbers and so the same trees.

Where rows repeat, ``REPEATS`` times on average at least, equal ones travel as
one with their number. They have the same key, so a round draws all or none of
them, and whole numbers add up to the same sums.

Growth is best first: leaves wait in a queue by gain until ``num_leaves`` or the
depth is reached. One pass serves all leaves that may still be split, so a tree
takes about as many passes as it has levels, with the splits that one leaf at a
time would have given.

Gradients become whole numbers of a fixed scale before they are summed, so sums,
splits and leaf values do not depend on the partitioning, a lost executor
included. Sums of a pass are kept by Spark and recomputed if lost; scores of the
rows are written anew every ``STRETCH`` rounds and follow from the trees since.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import written

BINS = 254
FEW = 254  # values of a feature that each get a bin of their own
SKETCH_ACCURACY = 10_000
COLUMNS_AT_ONCE = 64  # features in one sketching aggregate
ROWS_PER_PART = 500_000
HISTOGRAM_BYTES = 128 << 20  # sums that one task holds in a pass
NEAR_BYTES = 1 << 20  # sums of a node, over all tasks and outputs, that the driver adds up itself
STRETCH = 8
REPEATS = 4  # rows to a different one from which equal rows travel as one
SUM_BITS, ROW_BITS = 62, 38  # of a total, and of one row's gradient at most

ROWS = "key long, y double, count long, bins binary, scores binary"
HISTOGRAMS = "output int, node long, feature int, sums binary"
CANDIDATES = (
    "output int, node long, feature int, bin int, gain double, best boolean, "
    "g long, h long, n long, left_g long, left_h long, left_n long, sums binary"
)


@dataclass
class BoostPlan:
    """What a fit needs to know."""

    objective: str = "binary"  # binary, softmax or squared
    outputs: int = 1
    rounds: int = 100
    learning_rate: float = 0.1
    max_depth: int = 0  # 0: no limit
    num_leaves: int = 0  # 0: no limit
    l2: float = 1.0
    min_gain: float = 0.0
    min_curvature: float = 1.0
    min_rows: int = 1
    subsample: float = 1.0
    column_share: float = 1.0
    second_order: bool = True
    prior: bool = True
    seed: int = 42


@dataclass
class Tree:
    """Nodes in arrays; a leaf has no feature. Rows whose bin is at most ``cut`` go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, cut: int, gain: float) -> tuple[int, int]:
        at = len(self.feature)
        for _ in range(2):
            for column, empty in ((self.feature, -1), (self.cut, 0), (self.left, 0), (self.right, 0), (self.value, 0.0), (self.gain, 0.0)):
                column.append(empty)
        self.feature[node], self.cut[node], self.gain[node] = feature, cut, gain
        self.left[node], self.right[node] = at, at + 1
        return at, at + 1

    def places(self, table):
        """The leaf of every row of a matrix of bins, or of values if ``cut`` holds thresholds."""
        import numpy as np

        feature, cut = np.array(self.feature), np.array(self.cut)
        left, right = np.array(self.left), np.array(self.right)
        node = np.zeros(len(table), np.int64)
        live = np.arange(len(table)) if feature[0] >= 0 else np.empty(0, np.int64)
        while len(live):
            at = node[live]
            goes_left = table[live, feature[at]] <= cut[at]
            node[live] = np.where(goes_left, left[at], right[at])
            live = live[feature[node[live]] >= 0]
        return node


# ---- bins ------------------------------------------------------------------------------------


def bin_edges(rows: DataFrame, width: int) -> list[list[float]]:
    """Ascending edges of each of ``width`` features; a value belongs to the first edge it does not exceed.

    Features of up to ``FEW`` values are cut halfway between neighbours, others
    at quantiles of a sketch. A feature with missing values has a last edge that
    parts them from all others.
    """
    value = [F.when(~F.isnan(F.col("x")[j]), F.col("x")[j]) for j in range(width)]
    marks = [k / (BINS + 1) for k in range(1, BINS + 1)]
    edges: list[list[float]] = []
    few: list[int] = []
    tops: list[list[float]] = []
    for start in range(0, width, COLUMNS_AT_ONCE):
        chosen = range(start, min(width, start + COLUMNS_AT_ONCE))
        figures = [
            F.struct(
                F.approx_count_distinct(value[j]),
                F.percentile_approx(value[j], marks, SKETCH_ACCURACY),
                F.when(F.count(value[j]) < F.count(F.lit(1)), F.max(value[j])),
            ).alias(f"f{j}")
            for j in chosen
        ]
        found = rows.agg(*figures).first()
        for j in chosen:
            n, cuts, last = found[f"f{j}"]
            few += [j] if n <= FEW * 1.2 else []
            tops.append([] if last is None else [last])
            edges.append(sorted({*(cuts or ()), *tops[j]}))
    if few:
        pairs = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), value[j].alias("v")) for j in few]))
        # a sketch that is far too low would let more values through; those features keep their quantiles
        listed = rows.select(pairs.alias("p")).select("p.j", "p.v").filter("v IS NOT NULL").groupBy("j", "v").count()
        values: dict[int, list[float]] = {}
        for r in listed.select("j", "v").collect():  # about FEW values a feature
            values.setdefault(r["j"], []).append(r["v"])
        for j, seen in values.items():
            if len(seen) <= FEW:
                seen.sort()
                edges[j] = [a + (b - a) / 2 for a, b in zip(seen, seen[1:])] + tops[j]
    return edges


def binned(rows: DataFrame, edges: list[list[float]], start: list[float], n: int) -> DataFrame:
    """(key, y, count, bins, scores): one byte a feature, and the scores the boosting starts from."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        cuts = [np.array(e) for e in edges]
        for batch in batches:
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
            out = np.empty(x.shape, np.uint8)
            for j, cut in enumerate(cuts):
                out[:, j] = np.searchsorted(cut, x[:, j], side="left")
            scores = np.tile(np.array(start), (batch.num_rows, 1)).tobytes()
            width = 8 * len(start)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["key"],
                    batch["y"],
                    batch["count"],
                    pa.array([r.tobytes() for r in out], pa.binary()),
                    pa.array([scores[:width]] * batch.num_rows, pa.binary()),
                ],
                ["key", "y", "count", "bins", "scores"],
            )

    dealt = rows.coalesce(max(1, math.ceil(n / ROWS_PER_PART)))
    return written(dealt.mapInArrow(work, ROWS), "boost-bins")


# ---- passes over the rows --------------------------------------------------------------------


def _matrix(batch, width: int):
    import numpy as np

    return np.frombuffer(b"".join(batch["bins"].to_pylist()), np.uint8).reshape(batch.num_rows, width)


def _scores(batch, bins, plan: BoostPlan, stretch: list[list[Tree]]):
    import numpy as np

    scores = np.frombuffer(b"".join(batch["scores"].to_pylist()), np.float64).reshape(batch.num_rows, plan.outputs).copy()
    for trees in stretch:
        for k, tree in enumerate(trees):
            scores[:, k] += plan.learning_rate * np.array(tree.value)[tree.places(bins)]
    return scores


def probabilities(scores, objective: str):
    """Class probabilities of a matrix of scores."""
    import numpy as np

    if objective == "binary":
        up = np.exp(-np.abs(scores[:, 0]))
        one = np.where(scores[:, 0] >= 0, 1 / (1 + up), up / (1 + up))
        return np.stack([1 - one, one], 1)
    shifted = np.exp(scores - scores.max(1, keepdims=True))
    return shifted / shifted.sum(1, keepdims=True)


def _slopes(scores, y, plan: BoostPlan):
    """Gradients and curvatures of the loss, one column an output."""
    import numpy as np

    if plan.objective == "squared":
        return scores - y[:, None], np.ones_like(scores)
    p = probabilities(scores, plan.objective)
    if plan.objective == "binary":
        p = p[:, 1:]
        return p - y[:, None], p * (1 - p)
    return p - (y[:, None] == np.arange(plan.outputs)), p * (1 - p)


def _sampled(keys, plan: BoostPlan, turn: int):
    """Rows of a round's sample, by their key."""
    import numpy as np

    if plan.subsample >= 1:
        return None
    mix = (plan.seed * 1_000_003 + turn) * 0x9E3779B97F4A7C15 % (1 << 64)
    h = keys.astype(np.uint64) ^ np.uint64(mix)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    h ^= h >> np.uint64(33)
    return (h >> np.uint64(11)).astype(np.float64) / float(1 << 53) < plan.subsample


def _columns_of(plan: BoostPlan, turn: int, output: int, width: int) -> list[int]:
    """Features of one tree."""
    import numpy as np

    if plan.column_share >= 1:
        return list(range(width))
    rng = np.random.default_rng([plan.seed, turn, output])
    return sorted(rng.choice(width, max(1, round(plan.column_share * width)), replace=False).tolist())


def _row_sums(rows: DataFrame, plan: BoostPlan, stretch, growing: list[Tree], wanted, columns, sizes, scale: tuple[float, float], turn: int):
    """(output, node, feature, sums) of the ``wanted`` nodes, one row a task, node and feature."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = {}
        for k, node in wanted:
            total[k, node] = [np.zeros((3, sizes[j]), np.int64) for j in columns[k]]
        by_output: dict[int, list[int]] = {}
        for k, node in wanted:
            by_output.setdefault(k, []).append(node)
        for batch in batches:
            if not batch.num_rows:
                continue
            bins = _matrix(batch, len(sizes))
            y = batch["y"].to_numpy(zero_copy_only=False)
            g, h = _slopes(_scores(batch, bins, plan, stretch), y, plan)
            g, h = np.rint(g * scale[0]), np.rint(h * scale[1])
            count = batch["count"].to_numpy(zero_copy_only=False)
            single = (count == 1).all()
            drawn = _sampled(batch["key"].to_numpy(zero_copy_only=False), plan, turn)
            for k, nodes in by_output.items():
                place = growing[k].places(bins)
                if drawn is not None:
                    place = np.where(drawn, place, -1)
                for node in nodes:
                    here = np.flatnonzero(place == node)
                    if not len(here):
                        continue
                    gk, hk, nk = g[here, k], h[here, k], count[here]
                    for slot, j in enumerate(columns[k]):
                        b = bins[here, j]
                        sums = total[k, node][slot]
                        if not single:
                            for at, one in enumerate((gk, hk, np.ones_like(gk))):
                                np.add.at(sums[at], b, one.astype(np.int64) * nk)
                            continue
                        # float sums of whole numbers below 2**53 are exact
                        sums[0] += np.bincount(b, gk, sizes[j]).astype(np.int64)
                        sums[1] += np.bincount(b, hk, sizes[j]).astype(np.int64)
                        sums[2] += np.bincount(b, minlength=sizes[j])
        out = [(k, node, j, s.tobytes()) for (k, node), held in total.items() for j, s in zip(columns[k], held)]
        types = [pa.int32(), pa.int64(), pa.int32(), pa.binary()]
        cells = [pa.array(list(c), t) for c, t in zip(zip(*out), types)]
        yield pa.RecordBatch.from_arrays(cells, ["output", "node", "feature", "sums"])

    return rows.mapInArrow(work, HISTOGRAMS)


def _best_cut(sums, plan: BoostPlan, scale: tuple[float, float]) -> tuple[int, float]:
    """(bin, gain) of the best cut of one feature at one node; gain -1 where none is allowed."""
    import numpy as np

    left = np.cumsum(sums, axis=1)[:, :-1]
    if not left.shape[1]:
        return 0, -1.0
    g, h, n = sums.sum(1)
    right = np.array([[g], [h], [n]]) - left
    allowed = (left[2] >= plan.min_rows) & (right[2] >= plan.min_rows)
    if plan.second_order:
        least = plan.min_curvature * scale[1]
        allowed &= (left[1] >= least) & (right[1] >= least)
        weights = [left[1] / scale[1], right[1] / scale[1], h / scale[1]]
    else:
        weights = [left[2].astype(float), right[2].astype(float), float(n)]
    l2 = plan.l2 if plan.second_order else 0.0

    def score(gradient, weight):
        return (gradient / scale[0]) ** 2 / np.maximum(weight + l2, 1e-300)

    gain = 0.5 * (score(left[0], weights[0]) + score(right[0], weights[1]) - score(g, weights[2])) - plan.min_gain
    gain = np.where(allowed, gain, -1.0)
    best = int(gain.argmax())
    return best, float(gain[best])


def _searched(held: dict, parents: dict, pairs: dict, plan: BoostPlan, scale: tuple[float, float]) -> list[list]:
    """Rows of ``CANDIDATES`` for sums by (output, node, feature); siblings are their parent minus what was summed.

    ``pairs`` tells for each summed node (output, node) its parent and sibling.
    """
    import numpy as np

    for k, node, j in list(held):
        parent, sibling = pairs[k, node]
        if sibling is not None:
            held[k, sibling, j] = parents[k, parent, j] - held[k, node, j]
    best: dict = {}
    out: list[list] = []
    for (k, node, j), sums in sorted(held.items()):
        cut, gain = _best_cut(sums, plan, scale)
        if (k, node) not in best or gain > out[best[k, node]][4]:
            best[k, node] = len(out)
        totals, left = sums.sum(1).tolist(), sums[:, : cut + 1].sum(1).tolist()
        out.append([k, node, j, cut, gain, False, *totals, *left, np.ascontiguousarray(sums).tobytes()])
    for at in best.values():
        out[at][5] = True
    return out


def _added(held: dict, table) -> None:
    """Add the sums of an Arrow table to those held."""
    import numpy as np

    for k, node, j, sums in zip(*[table[c].to_pylist() for c in ("output", "node", "feature", "sums")]):
        sums = np.frombuffer(sums, np.int64).reshape(3, -1)
        held[k, node, j] = held[k, node, j] + sums if (k, node, j) in held else sums


class _NearSums:
    """Sums of passes on the driver, for models whose sums of all tasks are at most ``NEAR_BYTES``."""

    def __init__(self):
        self.parents: dict = {}

    def answers(self, partial: DataFrame, pairs: dict, plan: BoostPlan, scale: tuple[float, float]) -> list[dict]:
        held: dict = {}
        _added(held, partial.toArrow())
        found = _searched(held, self.parents, pairs, plan, scale)
        for (k, _), (parent, sibling) in pairs.items():
            if sibling is not None:  # both children are known now
                for key in [key for key in self.parents if key[:2] == (k, parent)]:
                    del self.parents[key]
        self.parents |= held
        names = [c.split(" ")[0] for c in CANDIDATES.split(", ")]
        return [dict(zip(names, r)) for r in found if r[5]]

    def close(self) -> None:
        self.parents.clear()


class _FarSums:
    """Sums of passes kept by Spark; the driver sees the best cut of each node and partition."""

    def __init__(self):
        self.pool: list[tuple[set, DataFrame]] = []

    def answers(self, partial: DataFrame, pairs: dict, plan: BoostPlan, scale: tuple[float, float]) -> list[dict]:
        def work(batches: Iterator) -> Iterator:
            import pyarrow as pa

            held: dict = {}
            for batch in batches:
                _added(held, batch)
            parents = {key: held.pop(key) for key in list(held) if key[:2] not in pairs}
            out = _searched(held, parents, pairs, plan, scale)
            if out:
                types = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.bool_(), *[pa.int64()] * 6, pa.binary()]
                names = [c.split(" ")[0] for c in CANDIDATES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)], names)

        needed = {(k, p): node for (k, node), (p, s) in pairs.items() if s is not None}
        found = partial.withColumn("pair", F.col("node"))
        place = F.concat_ws(":", "output", "node")
        for nodes, df in self.pool:
            here = sorted(nodes & set(needed))
            if here:
                summed = F.create_map(*[F.lit(v) for k, p in here for v in (f"{k}:{p}", needed[k, p])])
                parents = df.select("output", "node", "feature", "sums").withColumn("pair", summed[place].cast("long"))
                found = found.unionByName(parents.filter(F.col("pair").isNotNull()))
        # a parent meets the child that was summed
        dealt = found.repartition("output", "pair", "feature").drop("pair")
        kept = dealt.mapInArrow(work, CANDIDATES).persist(StorageLevel.MEMORY_AND_DISK)
        self.pool.append(({(k, v) for (k, n), (_, s) in pairs.items() for v in (n, s) if v is not None}, kept))
        return [r.asDict() for r in kept.filter("best").drop("sums").collect()]

    def close(self) -> None:
        for _, df in self.pool:
            df.unpersist()


class _Growth:
    """One tree that grows best first."""

    def __init__(self, plan: BoostPlan, scale: tuple[float, float]):
        self.plan, self.scale = plan, scale
        self.tree = Tree()  # every split that was looked at
        self.depth = {0: 0}
        self.found: dict[int, dict] = {}
        self.wanted: list[int] = [0]
        self.chosen: set[int] = set()
        self.leaves = 1
        self.queue: list[tuple[float, int]] = []
        self.done = False

    def open(self, node: int) -> bool:
        """A node whose own split may be worth looking for."""
        plan, n = self.plan, self.sums[node][2]
        return not (plan.max_depth and self.depth[node] >= plan.max_depth) and n >= 2 * plan.min_rows

    def learn(self, rows: list[dict]) -> None:
        """Take in the best cuts of nodes, split as far as they allow, and name the nodes to look at next."""
        for r in rows:
            self.found[r["node"]] = r
        if not hasattr(self, "sums"):
            root = self.found[0]
            self.sums = {0: (root["g"], root["h"], root["n"])}
            self._offer(0)
        plan = self.plan
        while self.queue and (not plan.num_leaves or self.leaves < plan.num_leaves):
            node = self.queue[0][1]
            if node not in self.chosen and self.tree.feature[node] < 0:
                break  # its children are not known yet
            heapq.heappop(self.queue)
            self.chosen.add(node)
            self.leaves += 1
            for child in (self.tree.left[node], self.tree.right[node]):
                self._offer(child)
        room = plan.num_leaves - self.leaves if plan.num_leaves else len(self.queue)
        self.wanted = []
        for _, node in heapq.nsmallest(room, self.queue):
            if self.tree.feature[node] < 0:
                self._split(node)
        if not self.wanted and self.queue and room > 0:
            self.learn([])  # the children of these need no look
        self.done = not self.wanted

    def _offer(self, node: int) -> None:
        cut = self.found.get(node)
        if cut is not None and cut["gain"] > 0 and self.open(node):
            heapq.heappush(self.queue, (-cut["gain"], node))

    def _split(self, node: int) -> None:
        r = self.found[node]
        left, right = self.tree.split(node, r["feature"], r["bin"], r["gain"])
        part = (r["left_g"], r["left_h"], r["left_n"])
        self.sums[left], self.sums[right] = part, tuple(a - b for a, b in zip(self.sums[node], part))
        self.depth[left] = self.depth[right] = self.depth[node] + 1
        self.wanted += [c for c in (left, right) if self.open(c)]

    def requests(self) -> list[tuple[int, int | None, int | None]]:
        """(node to sum, its parent, sibling to subtract) for what is wanted; a root has no parent."""
        if self.wanted == [0]:
            return [(0, None, None)]
        parent = {}
        for node, (a, b) in enumerate(zip(self.tree.left, self.tree.right)):
            if self.tree.feature[node] >= 0:
                parent[a] = parent[b] = node
        out, seen = [], set()
        for node in self.wanted:
            p = parent[node]
            if p in seen:
                continue
            seen.add(p)
            a, b = self.tree.left[p], self.tree.right[p]
            small, large = (a, b) if self.sums[a][2] <= self.sums[b][2] else (b, a)
            both = small in self.wanted and large in self.wanted
            if both:
                out.append((small, p, large))
            elif small in self.wanted:
                out.append((small, None, None))
            else:
                out.append((small, p, large))
        return out

    def finished(self) -> Tree:
        """The tree of the chosen splits, with its leaf values."""
        out, todo = Tree(), [(0, 0)]
        while todo:
            node, at = todo.pop()
            if node in self.chosen:
                a, b = out.split(at, self.tree.feature[node], self.tree.cut[node], self.tree.gain[node])
                todo += [(self.tree.right[node], b), (self.tree.left[node], a)]
            else:
                out.value[at] = self._leaf(*self.sums[node])
        return out

    def _leaf(self, g: int, h: int, n: int) -> float:
        plan = self.plan
        l2 = plan.l2 if plan.second_order else 0.0
        value = -(g / self.scale[0]) / max(h / self.scale[1] + l2, 1e-16)
        if plan.objective == "softmax" and not plan.second_order:
            value *= (plan.outputs - 1) / plan.outputs
        return value


def _grow_round(
    rows: DataFrame, plan: BoostPlan, stretch, sizes: list[int], scale: tuple[float, float], turn: int, near: bool
) -> list[Tree]:
    """The trees of one round, all outputs pass by pass together."""
    columns = {k: _columns_of(plan, turn, k, len(sizes)) for k in range(plan.outputs)}
    growths = [_Growth(plan, scale) for _ in range(plan.outputs)]
    kept = _NearSums() if near else _FarSums()
    try:
        while any(not g.done for g in growths):
            asked = [(k, *r) for k, g in enumerate(growths) if not g.done for r in g.requests()]
            answers: list[dict] = []
            for part in _fitting(asked, columns, sizes):
                pairs = {(k, node): (parent, sibling) for k, node, parent, sibling in part}
                trees = [g.tree for g in growths]
                partial = _row_sums(rows, plan, stretch, trees, sorted(pairs), columns, sizes, scale, turn)
                answers += kept.answers(partial, pairs, plan, scale)
            for k, g in enumerate(growths):
                if not g.done:
                    g.learn(_best_of(answers, k, set(g.wanted)))
    finally:
        kept.close()
    return [g.finished() for g in growths]


def _best_of(answers: list[dict], output: int, wanted: set) -> list[dict]:
    """The best cut of each wanted node over all partitions; equal gains go to the first feature."""
    best: dict[int, dict] = {}
    for r in answers:
        if r["output"] == output and r["node"] in wanted:
            now = best.get(r["node"])
            if now is None or (-r["gain"], r["feature"]) < (-now["gain"], now["feature"]):
                best[r["node"]] = r
    return list(best.values())


def _fitting(asked: list, columns: dict, sizes: list[int]) -> Iterator[list]:
    """``asked`` in runs whose sums a task can hold together."""
    run, held = [], 0
    for request in asked:
        size = sum(24 * sizes[j] for j in columns[request[0]])
        if run and held + size > HISTOGRAM_BYTES:
            yield run
            run, held = [], 0
        run.append(request)
        held += size
    if run:
        yield run


def _with_scores(rows: DataFrame, plan: BoostPlan, stretch, width: int) -> DataFrame:
    """The rows with the trees of a stretch added to their scores, written."""

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                scores = _scores(batch, _matrix(batch, width), plan, stretch)
                yield pa.RecordBatch.from_arrays(
                    [batch["key"], batch["y"], batch["count"], batch["bins"], pa.array([s.tobytes() for s in scores], pa.binary())],
                    ["key", "y", "count", "bins", "scores"],
                )

    return written(rows.mapInArrow(work, ROWS), "boost-scores")


def _exact_mean(rows: DataFrame, n: int, low: float, high: float) -> float:
    """Mean of y from whole numbers, whatever the order of the rows."""
    step = max(high - low, 1e-300) / 2**ROW_BITS
    whole = F.round((F.col("y") - low) / step).cast("long").cast("decimal(38,0)")
    return low + float(rows.agg(F.sum(whole)).first()[0]) / n * step


def boost(rows: DataFrame, plan: BoostPlan) -> dict:
    """Fit to ``rows`` (x array<double>, y double): start scores and the trees of all rounds, with thresholds for cuts."""
    keyed = rows.withColumn("key", F.xxhash64("x", "y"))
    shape = rows.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.size("x")).alias("width"),
        F.min("y").alias("low"),
        F.max("y").alias("high"),
        F.approx_count_distinct(F.xxhash64("x", "y")).alias("different"),
    ).first()
    if not shape["n"]:
        raise ValueError("no rows to learn from")
    n, width = shape["n"], shape["width"]
    start = [0.0] * plan.outputs
    if plan.objective == "squared":
        start = [_exact_mean(rows, n, shape["low"], shape["high"])]
    elif plan.prior:
        counts = {int(r["y"]): r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # classes
        share = [max(counts.get(k, 0), 1e-9) / n for k in range(max(plan.outputs, 2))]
        start = [math.log(share[1] / share[0])] if plan.objective == "binary" else [math.log(s) for s in share]
    spread = 1.0 if plan.objective != "squared" else 4 * max(shape["high"] - shape["low"], 1e-300)
    bits = min(ROW_BITS, SUM_BITS - math.ceil(math.log2(n + 1)))
    scale = (2.0**bits / spread, 2.0**bits)  # of gradients and of curvatures
    edges = bin_edges(keyed, width)
    sizes = [len(e) + 1 for e in edges]
    if n >= REPEATS * shape["different"]:
        counted = keyed.groupBy("key", "x", "y").agg(F.count(F.lit(1)).alias("count"))
        held = shape["different"]
    else:
        counted, held = keyed.withColumn("count", F.lit(1).cast("long")), n
    table = binned(counted, edges, start, held).persist(StorageLevel.MEMORY_AND_DISK)
    tasks = math.ceil(held / ROWS_PER_PART)
    near = 24 * sum(sizes) * plan.outputs * tasks <= NEAR_BYTES
    stretch: list[list[Tree]] = []
    trees: list[list[Tree]] = []
    for turn in range(plan.rounds):
        trees.append(_grow_round(table, plan, stretch, sizes, scale, turn, near))
        stretch.append(trees[-1])
        if len(stretch) == STRETCH and turn + 1 < plan.rounds:
            scored = _with_scores(table, plan, stretch, width)
            table.unpersist()
            table, stretch = scored.persist(StorageLevel.MEMORY_AND_DISK), []
    table.unpersist()
    for tree in (t for turn in trees for t in turn):
        tree.cut = [edges[j][b] if j >= 0 else 0.0 for j, b in zip(tree.feature, tree.cut)]
    return {
        "objective": plan.objective,
        "learning_rate": plan.learning_rate,
        "start": start,
        "trees": [[asdict(t) for t in turn] for turn in trees],
    }


# ---- estimator -------------------------------------------------------------------------------


class _Shared(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """Columns of the estimator and of its model."""


class HistogramBooster(Estimator, _Shared, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees; ``plan`` holds the settings of :class:`BoostPlan` but the seed as JSON."""

    plan = Param(Params._dummy(), "plan", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", seed=None, plan=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        plan = BoostPlan(**json.loads(self.getOrDefault(self.plan)), seed=self.getSeed())
        x = vector_to_array(F.col(self.getFeaturesCol()))
        rows = dataset.select(x.alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        return BoostedTrees(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            trees=json.dumps(boost(rows, plan)),
        )


class BoostedTrees(Model, _Shared, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted booster: its trees as JSON. Classifiers also give ``probability``."""

    trees = Param(Params._dummy(), "trees", "start scores and trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", trees=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def description(self) -> dict:
        """Objective, start scores, and per round and output the arrays of a tree."""
        return json.loads(self.getOrDefault(self.trees))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        held = self.description
        trees = [[Tree(**t) for t in turn] for turn in held["trees"]]
        objective, start, rate = held["objective"], held["start"], held["learning_rate"]

        @F.arrow_udf("array<double>")
        def answer(x):
            import numpy as np
            import pyarrow as pa

            table = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            scores = np.tile(np.array(start), (len(table), 1))
            for turn in trees:
                for k, tree in enumerate(turn):
                    scores[:, k] += rate * np.array(tree.value)[tree.places(table)]
            if objective != "squared":
                scores = probabilities(scores, objective)
            offsets = np.arange(0, scores.size + 1, scores.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))

        scored = dataset.withColumn("_boosted", answer(vector_to_array(F.col(self.getFeaturesCol()))))
        if objective == "squared":
            return scored.withColumn(self.getPredictionCol(), F.col("_boosted")[0]).drop("_boosted")
        # equal probabilities go to the lowest class
        top = F.array_position("_boosted", F.array_max("_boosted")) - 1
        return (
            scored.withColumn("probability", array_to_vector("_boosted"))
            .withColumn(self.getPredictionCol(), top.cast("double"))
            .drop("_boosted")
        )
