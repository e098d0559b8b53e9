"""Near-duplicate vectors through a forest of random projection trees.

Equal vectors are one class. Every tree splits a node along a random direction
at the median; vectors within a band around the cut go to both sides. A trunk
ends in boughs of at most ``NODE`` classes, which one task takes: it grows
``TREES`` trees over the bough down to leaves of at most ``LEAF`` classes, compares
the members of a leaf by cosine in double precision, verifies them against the
threshold and unites them. So a vector travels once per bough, not once per
leaf, and a bough answers with fewer rows than it has classes. There are as many
trunks as their depth asks for to miss at most ``MISSED`` of the pairs at the threshold.

Links are counted inside the united groups, where all of them lie: a group of at
most ``NODE`` classes is compared whole, tile by tile. In a larger one a pair
counts in the smallest leaf of a forest over the group that its classes share,
so trees add up without gathering pairs.

The upper levels of all trunks are fitted on one bounded sample of ``SAMPLE``
vectors, about, and sent to the tasks; a node that is still too large is split
level by level at the median of an aggregate. A node that hardly shrinks (its
vectors are too much alike) is compared tile by tile.

Decisions: a vector that is missing, empty, zero, or holds a missing or
non-finite component links with nothing; vectors of different length never
link; an overflow to infinity is avoided by scaling each vector by its largest
component; keys may repeat or be missing, a group is named by its smallest; an
empty table gives an empty result, other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import groups, parts_for
from tabwright.llm.components import components
from tabwright.llm.ngram_join import link_nodes, roots_of, tile_links, tiled
from tabwright.operators.order import hot_key_join
from tabwright.session import written

THRESHOLD = 0.9
TREES = 12
LEAF = 256
SPILL = 0.02  # half width of the band around a cut of a trunk, for vectors of length one
BOUGH_SPILL = 0.03  # the same below the trunks, where a copy is only a number
LOST = 0.08  # share of the pairs at cosine 0.9 that a cut parts, in 64 dimensions, between an even and a dense cloud
MISSED = 0.01  # of the pairs at the threshold, by all trunks
SAMPLE = 50_000  # vectors that the upper levels are fitted on, about
NODE = 10_000  # vectors that one task splits to their leaves
BLOCK = 1_024  # side of the comparisons in a leaf that could not be split
PART_BYTES = 32 << 20
LEAST = 64  # vectors from which a cut is fitted
LEVELS = 40
SHRINK = 0.9  # a node of which both parts hold more than this share is compared as it is


def direction(node: int, size: int):
    """The random direction of a node, known to every task by its number."""
    import numpy as np

    d = np.random.default_rng(node & 0x7FFFFFFFFFFFFFFF).standard_normal(size)
    return d / np.linalg.norm(d)


def child(node: int, side: int) -> int:
    """Number of a part of a node."""
    x = (node * 2 + side + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return (x ^ (x >> 31)) >> 1


def trunks_for(total: int, node: int, missed: float = MISSED) -> int:
    """Trunks that together miss at most ``missed`` of the pairs at the threshold."""
    depth = max(0, math.ceil(math.log2(max(total, 1) / node)))
    parted = 1 - (1 - LOST) ** depth
    return max(1, math.ceil(math.log(missed) / math.log(parted))) if parted else 1


def fit_cuts(
    node: int, vectors, levels: int, expected: float, leaf: int, cuts: dict[int, float], spill: float = SPILL
) -> None:
    """Add the cut of a node and its parts; ``expected`` is how many rows of the table the node holds."""
    import numpy as np

    if not levels or len(vectors) < min(LEAST, 2 * leaf) or expected <= leaf:
        return
    along = vectors @ direction(node, vectors.shape[1])
    cut = float(np.median(along))
    left, right = along <= cut + spill, along >= cut - spill
    if min(left.mean(), right.mean()) > SHRINK:
        return
    cuts[node] = cut
    for side, part in ((0, left), (1, right)):
        fit_cuts(child(node, side), vectors[part], levels - 1, expected * part.mean(), leaf, cuts, spill)


def unit(vectors):
    """Vectors of length one, by way of their largest component."""
    import numpy as np

    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _stacked(column):
    """Double-precision matrix of a column of equal-length lists."""
    import numpy as np

    flat = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1)


def routed(vectors, start: int, cuts: dict[int, float], spill: float = SPILL) -> list[tuple[int, object]]:
    """Leaves below a node, each with the rows of ``vectors`` that reach it."""
    import numpy as np

    out, work = [], [(start, np.arange(len(vectors)))]
    while work:
        node, rows = work.pop()
        if node not in cuts:
            out.append((node, rows))
            continue
        along = vectors[rows] @ direction(node, vectors.shape[1])
        for side, part in ((0, along <= cuts[node] + spill), (1, along >= cuts[node] - spill)):
            if part.any():
                work.append((child(node, side), rows[part]))
    return out


def _placed(found: list, nodes):
    """Rows (path, node) of routed rows."""
    import numpy as np
    import pyarrow as pa

    paths = np.concatenate([np.full(len(rows), path, np.int64) for path, rows in found])
    nodes = nodes.combine_chunks() if hasattr(nodes, "combine_chunks") else nodes
    return pa.RecordBatch.from_arrays(
        [pa.array(paths), nodes.take(pa.array(np.concatenate([rows for _, rows in found])))], names=["path", "node"]
    )


def _route(handle, trees: int):
    """Send each vector down the upper levels of all trees."""

    def kernel(batches: Iterator) -> Iterator:
        for batch in batches:
            if batch.num_rows:
                vectors = unit(_stacked(batch["vector"]))
                found = [leaf for tree in range(1, trees + 1) for leaf in routed(vectors, tree, handle.value)]
                yield _placed(found, batch["node"])

    return kernel


def _finish(leaf: int):
    """Split whole nodes to their leaves; rows come sorted by path."""

    def kernel(batches: Iterator) -> Iterator:
        for table in groups(batches, ["path"]):
            vectors, path = unit(_stacked(table["vector"])), table["path"][0].as_py()
            cuts: dict[int, float] = {}
            fit_cuts(path, vectors, LEVELS, float(len(vectors)), leaf, cuts)
            yield _placed(routed(vectors, path, cuts), table["node"].combine_chunks())

    return kernel


def _project(batches: Iterator) -> Iterator:
    """Place of each vector along the direction of its node; rows come sorted by path."""
    import pyarrow as pa

    for table in groups(batches, ["path"]):
        vectors = unit(_stacked(table["vector"]))
        along = vectors @ direction(table["path"][0].as_py(), vectors.shape[1])
        yield pa.RecordBatch.from_arrays(
            [table["path"].combine_chunks(), table["node"].combine_chunks(), pa.array(along)], names=["path", "node", "along"]
        )


def leaves(classes: DataFrame, trees: int = TREES, leaf: int = LEAF, sample: int = SAMPLE, node: int = NODE) -> DataFrame:
    """Rows (path, node, m): every class (node, vector) in its leaves of every tree, m classes in a leaf."""
    spark = classes.sparkSession
    total = classes.count()
    draw = F.pmod(F.xxhash64("node", F.lit("forest")), F.lit(1 << 30))
    drawn = classes.filter(draw < int(min(1.0, sample / max(total, 1)) * (1 << 30))).select("vector").toArrow()
    cuts: dict[int, float] = {}
    if drawn.num_rows:
        vectors = unit(_stacked(drawn["vector"]))
        for tree in range(1, trees + 1):
            fit_cuts(tree, vectors, LEVELS, float(total), leaf, cuts)
    handle = spark.sparkContext.broadcast(cuts)  # fewer cuts than sampled vectors
    placed = classes.select("node", "vector").mapInArrow(_route(handle, trees), "path long, node long")
    placed = placed.withColumn("was", F.lit(None).cast("long"))
    done = []
    while True:
        placed = written(placed, "forest-open")
        sizes = placed.groupBy("path").agg(F.count(F.lit(1)).alias("m"), F.max("was").alias("was"))
        sizes = written(sizes.withColumn("ready", (F.col("m") <= leaf) | F.coalesce(F.col("m") > SHRINK * F.col("was"), F.lit(False))), "forest-sizes")
        done.append(placed.select("path", "node").join(sizes.filter("ready").select("path", "m"), "path"))
        middle = sizes.filter(~F.col("ready") & (F.col("m") <= node)).select("path")
        large = sizes.filter(~F.col("ready") & (F.col("m") > node)).select("path", "m")
        if not middle.isEmpty():
            rows = placed.select("path", "node").join(middle, "path", "left_semi").join(classes, "node")
            parts = written(
                rows.select("path", "node", "vector")
                .repartition(F.col("path"))
                .sortWithinPartitions("path")
                .mapInArrow(_finish(leaf), "path long, node long"),
                "forest-finished",
            )
            done.append(parts.join(parts.groupBy("path").agg(F.count(F.lit(1)).alias("m")), "path"))
        if large.isEmpty():
            break
        rows = placed.select("path", "node").join(large.select("path"), "path", "left_semi").join(classes, "node")
        along = written(
            rows.select("path", "node", "vector").sortWithinPartitions("path").mapInArrow(_project, "path long, node long, along double"),
            "forest-along",
        )
        medians = along.groupBy("path").agg(F.percentile_approx("along", 0.5, 1000).alias("cut")).join(large, "path")
        sides = F.array(
            F.when(F.col("along") <= F.col("cut") + SPILL, F.lit(0)), F.when(F.col("along") >= F.col("cut") - SPILL, F.lit(1))
        )
        placed = (
            along.join(medians, "path")
            .withColumn("side", F.explode(F.array_compact(sides)))
            .select(F.shiftrightunsigned(F.xxhash64("path", "side"), 1).alias("path"), "node", F.col("m").alias("was"))
        )
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    return every.filter("m > 1").select("path", "node", "m")


def near_pairs(left, right, threshold: float):
    """Rows (a of ``left``, b of ``right``) whose cosine reaches the threshold, each side as (vectors, of length one)."""
    import numpy as np

    (v, u), (w, t) = left, right
    a, b = np.nonzero(u @ t.T >= threshold - 1e-9)
    with np.errstate(over="ignore", invalid="ignore"):
        exact = np.einsum("ij,ij->i", v[a], w[b]) / (np.linalg.norm(v[a], axis=1) * np.linalg.norm(w[b], axis=1))
    scaled = ~np.isfinite(exact)
    if scaled.any():
        exact[scaled] = np.einsum("ij,ij->i", u[a[scaled]], t[b[scaled]])
    keep = exact >= threshold
    return a[keep], b[keep]


def _linked(threshold: float):
    """Pairs among the members of a tile."""

    def linked(table):
        vectors = _stacked(table["vector"])
        side = (vectors, unit(vectors))
        a, b = near_pairs(side, side, threshold)
        return a[a < b], b[a < b]

    return linked


def _compare(threshold: float):
    """Links of each member of a tile that count there, and what unites the members."""

    def kernel(batches: Iterator) -> Iterator:
        for table in groups(batches, ["path", "i", "j"]):
            if table.num_rows > 1:
                out = tile_links(table, _linked(threshold))
                if out is not None:
                    yield out

    return kernel


def united(vectors, lengths_one, rows, threshold: float):
    """Fewest pairs of ``rows`` that unite what links among them, block by block."""
    import numpy as np

    first, second = [], []
    for i in range(0, len(rows), BLOCK):
        for j in range(i, len(rows), BLOCK):
            x, y = rows[i : i + BLOCK], rows[j : j + BLOCK]
            a, b = near_pairs((vectors[x], lengths_one[x]), (vectors[y], lengths_one[y]), threshold)
            first.append(i + a)
            second.append(j + b)
        root = roots_of(len(rows), np.concatenate(first), np.concatenate(second))
        first, second = [np.flatnonzero(root != np.arange(len(rows)))], [root[root != np.arange(len(rows))]]
    return rows[first[0]], rows[second[0]]


def _grow(threshold: float, trees: int, leaf: int):
    """Rows (node, other) that unite what links in the leaves of a bough; rows come sorted by path."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table in groups(batches, ["path"]):
            vectors, path = _stacked(table["vector"]), table["path"][0].as_py()
            u, n = unit(vectors), len(vectors)
            found = []
            for tree in range(trees):
                start, cuts = child(path, tree + 2), {}
                fit_cuts(start, u, LEVELS, float(n), leaf, cuts, BOUGH_SPILL)
                found += [rows for _, rows in routed(u, start, cuts, BOUGH_SPILL)] if cuts else []
            if not found or sum(len(r) ** 2 for r in found) >= n * n:  # one leaf costs less than the trees
                found = [np.arange(n)]
            pairs = [united(vectors, u, rows, threshold) for rows in found if len(rows) > 1]
            if pairs:
                root = roots_of(n, *(np.concatenate(side) for side in zip(*pairs)))
                at = np.flatnonzero(root != np.arange(n))
                node = table["node"].combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [node.take(pa.array(at)), node.take(pa.array(root[at]))], names=["node", "other"]
                )

    return kernel


def _unite(threshold: float):
    """Rows (node, other) that unite what links in a tile."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table in groups(batches, ["path", "i", "j"]):
            a, b = _linked(threshold)(table)
            root = roots_of(table.num_rows, a, b)
            at = np.flatnonzero(root != np.arange(table.num_rows))
            node = table["node"].combine_chunks()
            yield pa.RecordBatch.from_arrays([node.take(pa.array(at)), node.take(pa.array(root[at]))], names=["node", "other"])

    return kernel


def _count(threshold: float):
    """Rows (node, links) of the members of a tile."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for table in groups(batches, ["path", "i", "j"]):
            a, b = _linked(threshold)(table)
            block = table["block"].to_numpy()
            if table["i"][0].as_py() != table["j"][0].as_py():
                a, b = a[block[a] != block[b]], b[block[a] != block[b]]
            copies = table["copies"].to_numpy().astype(np.int64)
            links = np.zeros(len(block), np.int64)
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            yield pa.RecordBatch.from_arrays([table["node"].combine_chunks(), pa.array(links)], names=["node", "links"])

    return kernel


def _by_tile(members: DataFrame, kernel, schema: str) -> DataFrame:
    return (
        tiled(members)
        .repartition(F.col("path"), F.col("i"), F.col("j"))
        .sortWithinPartitions("path", "i", "j")
        .mapInArrow(kernel, schema)
    )


def united_groups(own: DataFrame, size: int, threshold: float, trees: int, leaf: int, node: int) -> DataFrame:
    """Rows (node, root) of the classes (node, vector) that link with another one."""
    total, spark = own.count(), own.sparkSession
    boughs = written(leaves(own, trunks_for(total, node), node, node=node), "forest-boughs")
    whole, stuck = boughs.filter(F.col("m") <= node), boughs.filter(F.col("m") > node)
    about = whole.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("path").alias("paths")).first()
    slots = min(about["paths"], 4 * spark.sparkContext.defaultParallelism)
    found = (
        whole.select("path", "node")
        .join(own, "node")
        .repartition(max(1, slots, parts_for(about["n"] * (16 + 8 * size), PART_BYTES)), "path")
        .sortWithinPartitions("path")
        .mapInArrow(_grow(threshold, trees, leaf), "node long, other long")
    )
    if not stuck.isEmpty():
        found = found.unionByName(_by_tile(stuck.join(own, "node"), _unite(threshold), "node long, other long"))
    found = written(found, "forest-united")
    return components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), "forest")


def counted(own: DataFrame, roots: DataFrame, threshold: float, trees: int, leaf: int, node: int) -> DataFrame:
    """Rows (node, links) of the classes (node, vector, copies) in ``roots``."""
    sizes = roots.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    large = written(sizes.filter(F.col("m") > node).select("root"), "forest-large")
    small = sizes.filter(F.col("m") <= node)
    members = roots.join(small, "root").withColumnRenamed("root", "path").join(own, "node")
    links = _by_tile(members, _count(threshold), "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))
    if large.isEmpty():
        return links
    rest = written(own.join(roots.join(large, "root", "left_semi"), "node", "left_semi"), "forest-rest")
    placed = written(leaves(rest.select("node", "vector"), trees, leaf, node=node), "forest-leaves")
    lists = placed.groupBy("node").agg(F.sort_array(F.collect_list("path")).alias("leaves"))
    full = placed.join(lists, "node").join(rest, "node")
    return links.unionByName(link_nodes(full, _compare(threshold), "long", "forest")[0])


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    trees: int = TREES,
    leaf: int = LEAF,
    node: int = NODE,
) -> DataFrame:
    """One row per row of ``vectors``: key, n_links, component_id, kept."""
    rows = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    if rows.schema["vector"].dataType.elementType.simpleString() not in ("float", "double"):
        rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    usable = (
        F.col("vector").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("vector", lambda x: x != 0)
    )
    # negative zero is zero, so that equal vectors have equal bytes
    same = F.unhex(F.sha2(F.to_json(F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))), 256))
    rows = rows.withColumn("cid", F.when(F.coalesce(usable, F.lit(False)), same))
    grouped = (
        rows.filter(F.col("cid").isNotNull())
        .groupBy("cid", F.size("vector").alias("size"))
        .agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    )
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()), "forest-classes")
    spark = vectors.sparkSession
    links = spark.createDataFrame([], "node long, links long")
    roots = spark.createDataFrame([], "node long, root long")
    # a forest for each length: lengths are few
    for size in [r["size"] for r in classes.select("size").distinct().collect()]:
        own = classes.filter(F.col("size") == size).select("node", "vector", "copies")
        together = united_groups(own.select("node", "vector"), size, threshold, trees, leaf, node)
        links = links.unionByName(counted(own, together, threshold, trees, leaf, node))
        roots = roots.unionByName(together)
    named = roots.join(classes, "node").groupBy("root").agg(F.min("first").alias("component"))
    found = written(
        classes.drop("vector", "size")
        .join(links, "node", "left")
        .join(roots.join(named, "root").select("node", "component"), "node", "left")
        .select(
            "cid",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "first").alias("component"),
            "copies",
        ),
        "forest-results",
    )
    return hot_key_join(rows.select("key", "cid"), found, "cid", "copies", "left").select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("cid").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"),
        (F.col("cid").isNull() | F.col("key").eqNullSafe(F.col("component"))).alias("kept"),
    )
