"""Ranked lexical search: exact inner products, pruned by balls over sparse document vectors.

A document is the vector of what each term adds to a score: the term's weight
times its damped count, whole numbers both. An item asks for the sum over its
terms, so a score is an inner product with zeros and ones. Only terms of the
items at hand are kept, which leaves the products as they are.

Documents are placed by their leading terms, so that neighbours are alike, and
each run of ``BLOCK_DOCS`` of them becomes a ball tree: a node knows the
centroid of its documents and a radius that holds them all, rounded up. For an
item no document of a node can score above ``centroid . item + radius * |item|``;
nodes are visited from the highest bound down until no bound reaches the k-th
best score, and the documents of a leaf are scored exactly in 64-bit integers.
A node whose bound equals the k-th best score is still visited, so ties are
settled by key. A hashed share of the documents is searched first; the k-th
best scores found there are lower bounds for all other trees.

Decisions: a missing text has no terms, neither has a missing item. Every row
of both tables counts, repeated rows too: equal documents rank beside each
other, and an item that occurs twice gets its answer twice. Keys of documents
are whole numbers; missing ones come first among equal scores. Items without a
document that scores above 0, and empty tables, give no rows. Only the keys and
texts are read, so other columns cannot clash. Items are taken in blocks of
about ``ITEMS_AT_ONCE``, each of which reads the documents once; what travels
to the workers are the terms of one block, and what one worker holds are the
texts of a slice or the vectors of a block of documents.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwright.llm.common import parts_for, slices, text_of
from tabwright.session import written

TOP = 50
ITEMS_AT_ONCE = 1_000
ITEM_BYTES = 16 << 20
BLOCK_DOCS = 4_096
LEAF_DOCS = 64
SLICE_BYTES = 2 << 20
FIRST_SHARE = 8  # one document in so many is searched first
PART_DOCS = 20_000
SLACK = 1e-9  # relative rounding allowed to bounds

# ASCII letters and digits, and every byte of other characters.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def terms_of(text: str) -> list[bytes]:
    """Terms of a text as UTF-8, A-Z in lower case."""
    return TERM.findall(text.encode().lower())


# ---- items -----------------------------------------------------------------------------------


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[DataFrame, list[tuple[int, list[bytes]]]]]:
    """(item rows, [(number, distinct terms)]) of each block; the terms of one block are on the driver at a time."""
    rows = items.select(F.col(item_id).alias("item_id"), text_of(text).alias("text"))
    rows = written(rows.withColumn("q", F.monotonically_increasing_id()), "search-items")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    blocks = max(parts_for(size["n"], ITEMS_AT_ONCE), parts_for(size["b"] or 0, ITEM_BYTES))
    for block in range(blocks):
        part = rows.filter(F.pmod(F.xxhash64("q"), F.lit(blocks)) == block)
        found = [(r["q"], sorted(set(terms_of(r["text"])))) for r in part.toLocalIterator()]
        yield part.select("q", "item_id"), [(q, terms) for q, terms in found if terms]


# ---- documents -------------------------------------------------------------------------------


def term_counts(docs: DataFrame, vocabulary, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, terms, counts): all terms of a document, and its counts of the terms in ``vocabulary``."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        number = vocabulary.value.get
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "text"):
                sizes, terms, counts = [], [], []
                for value in part["text"].to_pylist():
                    found = terms_of(value)
                    held = Counter(map(number, found))
                    held.pop(None, None)
                    sizes.append(len(found))
                    terms.append(np.fromiter(held.keys(), np.int32, len(held)).tobytes())
                    counts.append(np.fromiter(held.values(), np.int64, len(held)).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                    ["doc_id", "n", "terms", "counts"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(work, "doc_id long, n long, terms binary, counts binary")


def document_frequencies(counted: DataFrame, size: int) -> list[int]:
    """Documents that hold each of ``size`` terms; every task adds up its own."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        total = np.zeros(size, np.int64)
        for batch in batches:
            joined = b"".join(batch["terms"].to_pylist())
            total += np.bincount(np.frombuffer(joined, np.int32), minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], ["term", "df"])

    found = counted.select("terms").mapInArrow(work, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = [0] * size
    for r in found.collect():  # at most one row a term of the block
        out[r["term"]] = r["df"]
    return out


def document_vectors(counted: DataFrame, weights, n_docs: int, n_terms: int) -> DataFrame:
    """(doc_id, first, second, terms, adds): what each term adds to a score, and the two terms that add most."""

    def work(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        weight = weights.value
        for batch in batches:
            raw, tf_raw = batch["terms"].to_pylist(), batch["counts"].to_pylist()
            lengths = np.fromiter((len(x) // 4 for x in raw), np.int64, len(raw))
            terms = np.frombuffer(b"".join(raw), np.int32)
            tf = np.frombuffer(b"".join(tf_raw), np.int64)
            n = np.repeat(batch["n"].to_numpy(zero_copy_only=False), lengths)
            m = 50 + (50 * n * n_docs) // n_terms
            adds = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))
            ends = np.cumsum(lengths)
            first, second = np.full(len(raw), -1, np.int32), np.full(len(raw), -1, np.int32)
            out_terms, out_adds = [], []
            for i, (start, end) in enumerate(zip((ends - lengths).tolist(), ends.tolist())):
                t, a = terms[start:end], adds[start:end]
                out_terms.append(t.tobytes())
                out_adds.append(a.tobytes())
                if len(t):
                    order = np.lexsort((t, -a))[:2]
                    first[i] = t[order[0]]
                    second[i] = t[order[-1]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(first), pa.array(second), pa.array(out_terms, pa.binary()), pa.array(out_adds, pa.binary())],
                ["doc_id", "first", "second", "terms", "adds"],
            )

    return counted.mapInArrow(work, "doc_id long, first int, second int, terms binary, adds binary")


# ---- trees -----------------------------------------------------------------------------------


class BallTree:
    """Balls over the sparse vectors of one block of documents, stored in the order of the leaves."""

    def __init__(self, starts, terms, adds, leaf: int = LEAF_DOCS):
        import numpy as np

        self.columns, local = np.unique(terms, return_inverse=True)
        self.local, self.adds, self.starts = local.astype(np.int64), adds, starts
        self.values = adds.astype(np.float64)
        self.squares = self._row_sums(self.values * self.values, self.starts)
        self.centres, self.radii, self.ranges, self.children = [], [], [], []
        self.order = np.arange(len(starts) - 1)
        self._grow(0, len(self.order), leaf)
        self._reorder()
        self.centres, self.radii = np.vstack(self.centres), np.array(self.radii)

    @staticmethod
    def _row_sums(values, starts):
        import numpy as np

        return np.add.reduceat(values, starts[:-1])  # every row has an entry; each is summed by itself

    def _gather(self, rows):
        """(places of all entries of ``rows``, first entry of each row)."""
        import numpy as np

        sizes = self.starts[rows + 1] - self.starts[rows]
        starts = np.r_[0, np.cumsum(sizes)]
        places = np.repeat(self.starts[rows] - starts[:-1], sizes) + np.arange(starts[-1])
        return places, starts

    def _grow(self, begin: int, end: int, leaf: int) -> int:
        import numpy as np

        rows = self.order[begin:end]
        places, starts = self._gather(rows)
        columns, values = self.local[places], self.values[places]
        centre = np.bincount(columns, weights=values, minlength=len(self.columns)) / len(rows)
        squares = self.squares[rows]

        def distances(point):
            dots = self._row_sums(point[columns] * values, starts)
            return np.maximum(squares - 2 * dots + point @ point, 0.0)

        away = distances(centre)
        scale = float(squares.max()) + float(centre @ centre)
        node = len(self.radii)
        self.centres.append(centre)
        self.radii.append(math.sqrt(float(away.max()) + SLACK * scale) * (1 + SLACK))
        self.ranges.append((begin, end))
        self.children.append(None)
        if len(rows) > leaf:
            a = self._point(rows[int(away.argmax())])
            from_a = distances(a)
            b = self._point(rows[int(from_a.argmax())])
            # halves, so that equal documents cannot make the tree deep
            nearer = np.argsort(from_a - distances(b), kind="stable")
            self.order[begin:end] = rows[nearer]
            middle = (begin + end) // 2
            self.children[node] = (self._grow(begin, middle, leaf), self._grow(middle, end, leaf))
        return node

    def _point(self, row):
        import numpy as np

        out = np.zeros(len(self.columns))
        held = slice(int(self.starts[row]), int(self.starts[row + 1]))
        out[self.local[held]] = self.values[held]
        return out

    def _reorder(self) -> None:
        places, starts = self._gather(self.order)
        self.local, self.adds, self.starts = self.local[places], self.adds[places], starts

    def search(self, terms, k: int, floor: int):
        """(places in ``order``, scores) of all documents that may be among the k best and score at least ``floor``."""
        import numpy as np

        at = np.searchsorted(self.columns, terms)
        held = at[(at < len(self.columns)) & (self.columns[np.minimum(at, len(self.columns) - 1)] == terms)]
        if not len(held):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        bounds = (self.centres[:, held].sum(1) + math.sqrt(len(held)) * self.radii) * (1 + SLACK) + 1
        asked = np.zeros(len(self.columns), np.int64)
        asked[held] = 1
        least, best = max(floor, 1), np.empty(0, np.int64)
        heap, found, scores = [(-bounds[0], 0)], [], []
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if self.children[node] is not None:
                for child in self.children[node]:
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            begin, end = self.ranges[node]
            first, last = int(self.starts[begin]), int(self.starts[end])
            exact = self._row_sums(asked[self.local[first:last]] * self.adds[first:last], self.starts[begin : end + 1] - first)
            good = np.flatnonzero(exact >= least)
            if len(good):
                found.append(begin + good)
                scores.append(exact[good])
                best = np.r_[best, exact[good]]
                if len(best) >= k:
                    best = np.partition(best, len(best) - k)[len(best) - k :]
                    least = max(least, int(best.min()))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        places, values = np.concatenate(found), np.concatenate(scores)
        good = values >= least
        return self.order[places[good]], values[good]


def best_in_blocks(vectors: DataFrame, asked, floors, k: int) -> DataFrame:
    """(q, doc_id, score): the k best documents of every block of ``vectors`` for every item of ``asked``."""

    def answers(rows: list) -> Iterator:
        import numpy as np
        import pyarrow as pa

        table = pa.Table.from_batches(rows)
        raw = table["terms"].to_pylist()
        terms = np.frombuffer(b"".join(raw), np.int32)
        adds = np.frombuffer(b"".join(table["adds"].to_pylist()), np.int64)
        if not len(terms):
            return
        starts = np.r_[0, np.cumsum(np.fromiter((len(x) // 4 for x in raw), np.int64, len(raw)))]
        tree = BallTree(starts, terms, adds)
        keys = table["doc_id"].combine_chunks()
        absent = np.asarray(keys.is_null())
        plain = keys.fill_null(0).to_numpy(zero_copy_only=False)
        q_out, key_out, score_out = [], [], []
        for q, wanted in asked.value:
            places, scores = tree.search(wanted, k, floors.get(q, 0))
            if len(places) > k:
                order = np.lexsort((plain[places], ~absent[places], -scores))[:k]
                places, scores = places[order], scores[order]
            if len(places):
                q_out.append(np.full(len(places), q, np.int64))
                key_out.append(places)
                score_out.append(scores)
        if q_out:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(q_out)),
                    keys.take(pa.array(np.concatenate(key_out))),
                    pa.array(np.concatenate(score_out)),
                ],
                ["q", "doc_id", "score"],
            )

    def work(batches: Iterator) -> Iterator:
        held, size = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, BLOCK_DOCS - size)
                batch = batch.slice(part.num_rows)
                held.append(part)
                size += part.num_rows
                if size == BLOCK_DOCS:
                    yield from answers(held)
                    held, size = [], 0
        if held:
            yield from answers(held)

    return vectors.select("doc_id", "terms", "adds").mapInArrow(work, "q long, doc_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The k best rows of each item with their rank, equal scores by ascending key."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, asked: list[tuple[int, list[bytes]]], doc_id: str, text: str, k: int) -> DataFrame | None:
    import numpy as np

    sc = docs.sparkSession.sparkContext
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, terms in asked for t in terms}))}
    counted = written(term_counts(docs, sc.broadcast(vocabulary), doc_id, text), "search-counts")
    total = counted.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    if not n_docs:
        return None
    df = document_frequencies(counted, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df], np.int64)
    vectors = document_vectors(counted.filter(F.octet_length("terms") > 0), sc.broadcast(weights), n_docs, n_terms)
    turn = F.xxhash64("doc_id", "terms", "adds")
    placed = vectors.repartitionByRange(parts_for(n_docs, PART_DOCS), "first", "second", turn)
    first = F.pmod(turn, F.lit(FIRST_SHARE)) == 0
    placed = written(placed.withColumn("early", first).sortWithinPartitions("first", "second", turn), "search-vectors")
    items = sc.broadcast([(q, np.array([vocabulary[t] for t in terms], np.int32)) for q, terms in asked])
    early = written(best_of(best_in_blocks(placed.filter("early"), items, {}, k), k).drop("rank"), "search-early")
    # one row an item of the block: the k-th best score so far, where there are k
    last = early.groupBy("q").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).filter(F.col("n") >= k)
    floors = {r["q"]: r["least"] for r in last.collect()}
    return early.unionByName(best_in_blocks(placed.filter("NOT early"), items, floors, k))


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = TOP,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item with a score above 0."""
    parts = []
    for keys, asked in item_blocks(items, item_id, item_text):
        found = _search_block(docs, asked, doc_id, text, k) if asked else None
        if found is not None:
            ranked = best_of(found, k)
            parts.append(ranked.join(keys, "q").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    if not parts:
        kind = items.schema[item_id].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, parts)
