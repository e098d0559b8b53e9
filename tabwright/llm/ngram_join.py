"""Jaccard join of word shingles by chosen paths.

A text is the set of its five-word shingles (all its words where it has fewer).
Texts with equal sets form a class and are treated once. Each class is walked
down several random trees: at a node it follows a shingle chosen as the smallest
under the node's hash, so two classes go the same way with the probability of
their Jaccard similarity. Buckets of at most ``BUCKET`` classes are compared by
brute force; larger ones are split again, on two chosen shingles at once, down
to ``DEPTH`` levels, and what is still large is compared tile by tile. ``RUNS``
trees bring the recall of a pair at the threshold above ``RECALL``.

A linked pair is counted in the smallest bucket that its classes share, so
results from several trees add up without being gathered. Tiles answer with one
row per class: the number of rows linked and a link to one neighbour, never
with all pairs.

Set sizes and intersections are exact on 64-bit shingle hashes cut to 32 bits
within a pair.

Decisions: words are runs of other characters than ASCII white space, unchanged;
a missing text, or one without a word, links with nothing and is alone; rows
with equal shingle sets are linked; keys may repeat or be missing, then a group
is named by its smallest key, and by none if all are missing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import finished, groups, slices, text_of, word_hashes
from tabwright.llm.components import components
from tabwright.operators.order import hot_key_join
from tabwright.session import written

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.9999
BRANCH = 2  # shingles followed below the first level
DEPTH = 3
BUCKET = 2048
TILE = 512
SLICE_BYTES = 1 << 20


def runs_for(threshold: float, recall: float, depth: int = DEPTH) -> int:
    """Trees that find a pair at the threshold with the given probability, also if its buckets split to the last level."""
    survive = threshold * (1 - (1 - threshold) ** BRANCH) ** (depth - 1)
    return math.ceil(math.log(1 - recall) / math.log(1 - survive))


def shingle_set(words, n: int):
    """Sorted distinct 64-bit hashes of n consecutive words; of all words where there are fewer."""
    import numpy as np

    if not len(words):
        return words
    n = min(n, len(words))
    h = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ words[i : len(words) - n + 1 + i]
        h ^= h >> np.uint64(31)
    return np.unique(finished(h))


def _describe(n_words: int, runs: int):
    def kernel(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        rng = np.random.default_rng(20240607)
        per_run = 1 + BRANCH * (DEPTH - 1)
        mult = rng.integers(0, 1 << 63, (runs * per_run, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                classes, sizes, sets, chosen = [], [], [], []
                for text in part["_text"].to_pylist():
                    words, _, _ = word_hashes(text.encode("utf-8", "surrogatepass"))
                    own = shingle_set(words, n_words)
                    classes.append(hashlib.md5(own.tobytes()).digest() if len(own) else None)
                    sizes.append(len(own))
                    sets.append(np.unique((own >> np.uint64(32)).astype(np.uint32)).tobytes())
                    if not len(own):
                        chosen.append([])
                        continue
                    best = np.full(len(mult), np.iinfo(np.uint64).max, np.uint64)
                    for i in range(0, len(own), 4096):  # bounded memory for long texts
                        mixed = own[i : i + 4096] * mult
                        best = np.minimum(best, (mixed ^ (mixed >> np.uint64(32))).min(axis=1))
                    chosen.append(best.view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part["_key"],
                        pa.array(classes, pa.binary()),
                        pa.array(sizes, pa.int64()),
                        pa.array(sets, pa.binary()),
                        pa.array(chosen, pa.list_(pa.int64())),
                    ],
                    names=["key", "cid", "n", "shingles", "chosen"],
                )

    return kernel


def intersections(sets: list):
    """Matrix of common elements of all pairs of sorted arrays."""
    import numpy as np

    sizes = [len(s) for s in sets]
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, count = np.unique(element, return_inverse=True, return_counts=True)
    shared = count[column] > 1
    column, owner = column[shared], owner[shared]
    numbers = np.cumsum(np.bincount(column, minlength=1) > 0) - 1 if len(column) else np.zeros(0, int)
    column = numbers[column] if len(column) else column
    out = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, width, 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        grid = np.zeros((len(sets), min(4096, width - start)), np.float32)
        grid[owner[a:b], column[a:b] - start] = 1
        out += grid @ grid.T
    return out


def owned(pairs_a, pairs_b, leaves, path: int):
    """Which pairs share no smaller bucket than ``path``; ``leaves`` is padded with distinct fillers."""
    import numpy as np

    keep = np.zeros(len(pairs_a), bool)
    for i in range(0, len(pairs_a), 8192):
        a, b = leaves[pairs_a[i : i + 8192]], leaves[pairs_b[i : i + 8192]]
        same = (a[:, :, None] == b[:, None, :]).any(axis=2)
        least = np.where(same & (a >= 0), a, np.iinfo(np.int64).max).min(axis=1)
        keep[i : i + 8192] = least == path
    return keep


def roots_of(n: int, a, b):
    """Smallest member of each member's component under the pairs (a, b)."""
    import numpy as np

    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            return root


def padded_leaves(lists: list):
    """Bucket numbers of each member in one matrix; -1 stands for none in the rows, so it never counts as shared."""
    import numpy as np

    out = np.full((len(lists), max(map(len, lists))), -1, np.int64)
    for i, values in enumerate(lists):
        out[i, : len(values)] = values
    return out


def tile_links(table, linked):
    """Rows (node, other, links) of one tile; ``linked`` gives the pairs among its members."""
    import numpy as np
    import pyarrow as pa

    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    block = table["block"].to_numpy()
    a, b = linked(table)
    if i != j:
        across = block[a] != block[b]
        a, b = a[across], b[across]
    if not len(a):
        return None
    leaves = padded_leaves(table["leaves"].to_pylist())
    mine = owned(a, b, leaves, table["path"][0].as_py())
    copies = table["copies"].to_numpy().astype(np.int64)
    links = np.zeros(len(block), np.int64)
    np.add.at(links, a[mine], copies[b[mine]])
    np.add.at(links, b[mine], copies[a[mine]])
    root = roots_of(len(block), a, b)
    at = np.flatnonzero(np.bincount(np.r_[a, b], minlength=len(block)) > 0)
    node = table["node"].combine_chunks()
    return pa.RecordBatch.from_arrays(
        [node.take(pa.array(at)), node.take(pa.array(root[at])), pa.array(links[at])], names=["node", "other", "links"]
    )


def _compare(threshold: float):
    def linked(table):
        import numpy as np

        sets = [np.frombuffer(s, np.uint32) for s in table["shingles"].to_pylist()]
        n = np.array([len(s) for s in sets], np.float64)
        both = intersections(sets).astype(np.float64)
        similar = both >= threshold * (n[:, None] + n[None, :] - both) - 1e-9
        return np.nonzero(np.triu(similar, 1))

    def kernel(batches: Iterator) -> Iterator:
        for table in groups(batches, ["path", "i", "j"]):
            if table.num_rows > 1:
                out = tile_links(table, linked)
                if out is not None:
                    yield out

    return kernel


def tiled(members: DataFrame, tile: int = TILE) -> DataFrame:
    """Members of buckets (path, m) copied to the tiles of their bucket: blocks i and j of it meet in (path, i, j)."""
    blocks = F.ceil(F.col("m") / tile).cast("long")
    own = F.pmod(F.xxhash64("node", F.lit(7)), blocks)
    return (
        members.withColumn("block", own)
        .withColumn("other_block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("i", F.least("block", "other_block"))
        .withColumn("j", F.greatest("block", "other_block"))
        .drop("other_block", "m")
    )


def bucketed(classes: DataFrame, steps: DataFrame, runs: int, bucket: int) -> DataFrame:
    """Buckets (path, node, m) with two members or more; no two have the same members."""
    rows = steps.select("node", F.posexplode(F.slice("chosen", 1, runs)).alias("run", "s"))
    level = rows.select(F.shiftrightunsigned(F.xxhash64("run", "s"), 1).alias("path"), "run", "node").distinct()
    done = []
    for depth in range(1, DEPTH + 1):
        level = written(level, "join-level")
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
        sized = level.join(sizes, "path")
        if depth == DEPTH:
            done.append(sized)
            break
        done.append(sized.filter(F.col("m") <= bucket))
        large = sized.filter(F.col("m") > bucket).select("path", "run", "node")
        if large.isEmpty():
            break
        first = runs + (depth - 1) * BRANCH * runs
        level = (
            large.join(steps, "node")
            .withColumn("s", F.explode(F.slice("chosen", F.lit(first + 1) + F.col("run") * BRANCH, F.lit(BRANCH))))
            .select(F.shiftrightunsigned(F.xxhash64("path", "s"), 1).alias("path"), "run", "node")
            .distinct()
        )
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    every = written(every.select("path", "node", "m"), "join-buckets")
    # trees often gather the same members: one bucket of each such set is enough
    same = every.groupBy("path", "m").agg(
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")
    )
    kept = same.groupBy("m", "x", "y").agg(F.min("path").alias("path")).select("path")
    return every.join(kept, "path", "left_semi")


def link_nodes(members: DataFrame, kernel, kind: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Run a tile kernel: (node, links) summed over the tiles, and (node, root)."""
    found = written(
        tiled(members)
        .repartition(F.col("path"), F.col("i"), F.col("j"))
        .sortWithinPartitions("path", "i", "j")
        .mapInArrow(kernel, f"node {kind}, other {kind}, links long"),
        f"{label}-found",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")), label)
    return links, roots


def join(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per row of ``docs``: key, class_id (smallest key with the same shingles), n_links (rows linked to it,
    copies included), component_id (smallest key reachable by links), kept (the row that names its component)."""
    return _joined(docs, key, text, threshold, words, recall, bucket).drop("cid", "root")


def _joined(
    docs: DataFrame,
    key: str,
    text: str,
    threshold: float = THRESHOLD,
    words: int = WORDS,
    recall: float = RECALL,
    bucket: int = BUCKET,
) -> DataFrame:
    """:func:`join` with ``cid``, the class of equal shingles, and ``root``, the class that stands for the component."""
    runs = runs_for(threshold, recall)
    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    described = written(
        rows.mapInArrow(
            _describe(words, runs), f"key {kind}, cid binary, n long, shingles binary, chosen array<long>"
        ),
        "join-sets",
    )
    full = described.filter("n > 0")
    classes = written(
        full.groupBy(F.col("cid").alias("node")).agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies")),
        "join-classes",
    )
    steps = full.select(F.col("cid").alias("node"), "chosen")
    buckets = written(bucketed(classes, steps, runs, bucket), "join-buckets")
    leaves = buckets.groupBy("node").agg(F.sort_array(F.collect_list("path")).alias("leaves"))  # runs * BRANCH**DEPTH at most
    sets = (
        full.select(F.col("cid").alias("node"), "shingles")
        .join(leaves.select("node"), "node", "left_semi")
        .dropDuplicates(["node"])
    )
    members = buckets.join(leaves.join(classes.select("node", "copies"), "node").join(sets, "node"), "node")
    links, roots = link_nodes(members, _compare(threshold), "binary", "join")
    named = roots.join(classes, "node").groupBy("root").agg(F.min("first").alias("component"))
    found = written(
        classes.join(links, "node", "left")
        .join(roots.join(named, "root").select("node", "component", "root"), "node", "left")
        .select(
            F.col("node").alias("cid"),
            "first",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("component", "first").alias("component"),
            F.coalesce("root", "node").alias("root"),
            "copies",
        ),
        "join-results",
    )
    return hot_key_join(described.select("key", "cid"), found, "cid", "copies", "left").select(
        F.col("key").alias(key),
        F.when(F.col("cid").isNull(), F.col("key")).otherwise(F.col("first")).alias("class_id"),
        F.coalesce("links", F.lit(0).cast("long")).alias("n_links"),
        F.when(F.col("cid").isNull(), F.col("key")).otherwise(F.col("component")).alias("component_id"),
        (F.col("cid").isNull() | F.col("key").eqNullSafe(F.col("component"))).alias("kept"),
        "cid",
        "root",
    )


def representatives(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, one of each group of near copies, with all columns.

    Rows that share their key with others are told apart by their shingles, and
    one of each key and group stays. Texts without a word are no copies.
    """
    kept = written(_joined(docs, key, text).select(F.col(key).alias("_llm_key"), "cid", "root", "kept"), "join-kept")
    counts = kept.groupBy("_llm_key").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("k")).filter("k > 0")
    counts = written(counts, "join-keys")
    same = F.col(key).eqNullSafe(F.col("_llm_key"))
    stay = docs.join(counts.filter("n = 1"), same, "left_semi")
    shared = counts.filter("n > 1").select("_llm_key")
    if shared.isEmpty():
        return stay
    rows = written(docs.join(shared, same, "left_semi").withColumn("_llm_row", F.monotonically_increasing_id()), "join-shared")
    texts = rows.select(F.col("_llm_row").alias("_key"), text_of(text).alias("_text"))
    described = texts.mapInArrow(
        _describe(WORDS, 1), "key long, cid binary, n long, shingles binary, chosen array<long>"
    ).select(F.col("key").alias("_llm_row"), "cid")
    told = rows.select("_llm_row", F.col(key).alias("_key")).join(described, "_llm_row")
    standing = kept.filter("kept AND cid IS NOT NULL").select("_llm_key", "cid", "root").distinct()
    one = (
        told.join(standing, F.col("_key").eqNullSafe(F.col("_llm_key")) & (told["cid"] == standing["cid"]))
        .groupBy("_llm_key", "root")
        .agg(F.min("_llm_row").alias("_llm_row"))
        .select("_llm_row")
    )
    bare = told.filter("cid IS NULL").select("_llm_row")
    return stay.unionByName(rows.join(one.unionByName(bare), "_llm_row", "left_semi").drop("_llm_row"))
