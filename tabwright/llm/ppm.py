"""Language-model scores by prediction by partial matching, and a word baseline.

The model is a byte-context trie of ``ORDER`` levels, learned from the training
texts. At a context the seen bytes share what the escape leaves (method C: as
many escapes as distinct bytes); an escape goes to the next shorter context
without the bytes the longer one has seen, at last to a uniform share of the
bytes never seen. A text is scored with an end mark (a byte that UTF-8 never
uses), and its ASCII capitals as small letters.

Every context that training texts hold is a node, so the trie grows with the
corpus and no task gets it whole. Texts are dealt to blocks; a block lists its
distinct grams (a context and its byte) with their training counts. Grams meet
by the nearest three bytes of their context: all their contexts of three and
more bytes are there, those of up to two bytes are broadcast (at most 256**3
counts). A byte seen after a context is also seen after each shorter one, so a
node needs only its count, its number of bytes, and what these bytes count in
the next shorter context. Each block gets back the finished log-probabilities
of its own grams.

The word baseline goes the same way: each block adds up its distinct words, the
counts of all blocks meet at the word, and each block gets back the totals of
its own words only.

Decisions: a missing text is empty and consists of its end alone; rows without a
key are never held out; with no training text every token is unknown and every
byte has the same probability; equal rows count as often as they occur.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import parts_for, slices, text_of, total_bytes
from tabwright.session import written

ORDER = 5
LOW = 2  # longest contexts that are broadcast
CELL_GRAMS = 2 << 20
BLOCK_BYTES = 32 << 20
SLICE_BYTES = 2 << 20
START, END = 0xFE, 0xFF  # never in UTF-8
SYMBOLS = 256


def held_out(key: str = "doc_id", folds: int = 7, fold: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % folds == fold, F.lit(False))


def marked(texts: list[bytes]):
    """All texts in a row, each led by ``ORDER`` start marks and closed by an end mark, and the places that are scored."""
    import numpy as np

    data = np.frombuffer(b"".join([b"\xfe" * ORDER + t + b"\xff" for t in texts]), np.uint8)
    sizes = np.array([len(t) + ORDER + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    scored = np.ones(len(data), bool)
    for i in range(ORDER):
        scored[starts + i] = False
    return data, np.flatnonzero(scored), sizes - ORDER


def contexts(data, places):
    """The ``ORDER`` bytes before each place as one number, the nearest byte lowest."""
    import numpy as np

    code = np.zeros(max(len(data) - ORDER, 0), np.int64)
    for at in range(ORDER):
        code <<= 8
        code |= data[at : at + len(code)]
    return code[places - ORDER]


def _count_grams(batches: Iterator) -> Iterator:
    """Distinct grams of each block with their number in training texts."""
    import numpy as np
    import pyarrow as pa

    blocks: dict[int, list] = {}

    def merged(parts):
        k, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return k, np.bincount(at, weights=np.concatenate([p[1] for p in parts]), minlength=len(k)).astype(np.int64)

    for batch in batches:
        for part in slices(batch, SLICE_BYTES, "_text"):
            texts: dict = {}
            for t, block, train in zip(part["_text"].to_pylist(), part["_block"].to_pylist(), part["_train"].to_pylist()):
                texts.setdefault((block, train), []).append(t.encode("utf-8", "surrogatepass").lower())
            for (block, train), own in texts.items():
                data, places, _ = marked(own)
                keys, counts = np.unique(contexts(data, places) << 8 | data[places], return_counts=True)
                held = blocks.setdefault(block, [])
                held.append((keys, counts if train else np.zeros(len(keys), np.int64)))
                if len(held) == 8:
                    blocks[block] = [merged(held)]
    for block, held in blocks.items():
        keys, counts = merged(held)
        for i in range(0, len(keys), 100_000):
            k = keys[i : i + 100_000]
            yield pa.RecordBatch.from_pydict(
                {"block": pa.array([block] * len(k), pa.int64()), "gram": pa.array(k), "n": pa.array(counts[i : i + 100_000])}
            )


class Level:
    """Counts of the grams of one level, and of its contexts: count, number of bytes, count of these bytes one level below."""

    def __init__(self, level: int, grams, n, below: Level | None):
        import numpy as np

        self.mask = (1 << 8 * (level + 1)) - 1
        self.grams, at = np.unique(grams & self.mask, return_inverse=True)
        self.n = np.bincount(at, weights=n, minlength=len(self.grams))
        self.nodes, at = np.unique(self.grams >> 8, return_inverse=True)
        size = len(self.nodes)
        self.all = np.bincount(at, weights=self.n, minlength=size)
        self.kinds = np.bincount(at, minlength=size).astype(float)
        self.lower = np.bincount(at, weights=below.counts(self.grams), minlength=size) if below else np.zeros(size)

    def counts(self, grams):
        return _looked_up(self.grams, grams & self.mask, self.n)[0]

    def stats(self, grams):
        return _looked_up(self.nodes, (grams & self.mask) >> 8, self.all, self.kinds, self.lower)


def _looked_up(known, wanted, *values):
    """The values at ``wanted`` in the sorted ``known``; 0 where it is not there."""
    import numpy as np

    if not len(known):
        return [np.zeros(len(wanted)) for _ in values]
    at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    hit = known[at] == wanted
    return [np.where(hit, v[at], 0) for v in values]


def levels_from(grams, n, first: int, last: int, below: list) -> list:
    """Levels ``first`` to ``last`` after those of ``below``, from grams that were seen."""
    out = list(below)
    for level in range(first, last + 1):
        out.append(Level(level, grams, n, out[-1] if out else None))
    return out


def log_probs(grams, levels: list):
    """log10 probability of the last byte of each gram after the bytes before it."""
    import numpy as np

    logs = np.zeros(len(grams))
    open_, left = np.arange(len(grams)), np.zeros(len(grams))
    kinds_above, lower_above = np.zeros(len(grams)), np.zeros(len(grams))
    for level in reversed(levels):
        own = grams[open_]
        n, (total, kinds, lower) = level.counts(own), level.stats(own)
        new = kinds - kinds_above  # bytes that the longer context has not seen
        total = total - lower_above + new
        hit = n > 0
        logs[open_[hit]] = left[hit] + np.log10(n[hit] / total[hit])
        escape = np.log10(np.where(new > 0, new, 1) / np.where(new > 0, total, 1))
        open_, left, kinds_above, lower_above = (x[~hit] for x in (open_, left + escape, kinds, lower))
    logs[open_] = left - np.log10(np.maximum(SYMBOLS - kinds_above, 1))
    return logs


def _gram_logs(handle):
    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        parts = [[b[c].to_numpy() for c in ("block", "gram", "n")] for b in batches]
        if not parts:
            return
        block, gram, n = (np.concatenate(x) for x in zip(*parts))
        grams, at = np.unique(gram, return_inverse=True)
        total = np.bincount(at, weights=n, minlength=len(grams))
        seen = total > 0
        logs = log_probs(grams, levels_from(grams[seen], total[seen], LOW + 1, ORDER, handle.value)).astype(np.float32)[at]
        for i in range(0, len(gram), 100_000):
            own = slice(i, i + 100_000)
            yield pa.RecordBatch.from_pydict({"block": pa.array(block[own]), "gram": pa.array(gram[own]), "log": pa.array(logs[own])})

    return kernel


def gram_logs(rows: DataFrame, blocks: int) -> DataFrame:
    """block, gram, log: the log10 probability of each distinct gram of each block of ``rows`` (_text, _block, _train)."""
    grams = written(
        rows.select("_text", "_block", "_train").repartitionById(blocks, F.col("_block").cast("int")).mapInArrow(_count_grams, "block long, gram long, n long"),
        "ppm-grams",
    )
    short = F.col("gram").bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))
    found = grams.filter("n > 0").groupBy(short.alias("gram")).agg(F.sum("n").alias("n")).toArrow()  # at most 256**3 rows
    low = levels_from(found["gram"].to_numpy(), found["n"].to_numpy(), 0, LOW, [])
    handle = rows.sparkSession.sparkContext.broadcast(low)
    cell = F.shiftright("gram", 8).bitwiseAND(F.lit((1 << 8 * (LOW + 1)) - 1))
    return grams.repartition(parts_for(grams.count(), CELL_GRAMS), cell).mapInArrow(
        _gram_logs(handle), "block long, gram long, log float"
    )


@dataclass
class Trie:
    """Nodes by level as sorted context numbers, where each level starts in the table, and log10 probabilities by node and byte."""

    nodes: list
    first: list[int]
    table: object

    def scores(self, texts: list[bytes]):
        """log10 probability of each text with its end."""
        import numpy as np

        data, places, sizes = marked(texts)
        code = contexts(data, places)
        row = np.zeros(len(places), np.int64)
        open_ = np.arange(len(places))
        for level in range(ORDER, 0, -1):
            nodes = self.nodes[level]
            if len(nodes) and len(open_):
                own = code[open_] & ((1 << 8 * level) - 1)
                at = np.searchsorted(nodes, own)
                at[at == len(nodes)] = 0
                hit = nodes[at] == own
                row[open_[hit]] = self.first[level] + at[hit]
                open_ = open_[~hit]
        logs = self.table[row, data[places]].astype(np.float64)
        return np.add.reduceat(logs, np.cumsum(sizes) - sizes)


def finish(counts: list, nodes: list) -> Trie:
    """Log-probabilities of all bytes at all nodes; ``counts[level]`` has a row for each node of a level."""
    import numpy as np

    first = np.cumsum([0, *(len(n) for n in nodes)]).tolist()
    tables = []
    for level, own in enumerate(nodes):
        chain = [np.searchsorted(nodes[k], own & ((1 << 8 * k) - 1)) for k in range(level + 1)]
        for start in range(0, len(own), 1024):
            rows = [c[start : start + 1024] for c in chain]
            size = len(rows[0])
            p, left = np.zeros((size, SYMBOLS)), np.ones((size, 1))
            seen = np.zeros((size, SYMBOLS), bool)
            for k in range(level, -1, -1):
                n = np.where(seen, 0, counts[k][rows[k]])
                kinds = (n > 0).sum(axis=1, keepdims=True)
                total = n.sum(axis=1, keepdims=True) + kinds
                p += np.where(total > 0, left * n / np.maximum(total, 1), 0)
                left = np.where(total > 0, left * kinds / np.maximum(total, 1), left)
                seen |= n > 0
            never = SYMBOLS - seen.sum(axis=1, keepdims=True)
            p += np.where(seen, 0, left / np.maximum(never, 1))
            tables.append(np.log10(p / p.sum(axis=1, keepdims=True)).astype(np.float32))
    return Trie(nodes, first, np.concatenate(tables))


def learn(texts: DataFrame) -> Trie:
    """The whole finished trie of a small corpus (_text) on the driver; ``score`` does not need it."""
    import numpy as np

    rows = texts.select("_text", F.lit(0).cast("long").alias("_block"), F.lit(True).alias("_train"))
    grams = rows.mapInArrow(_count_grams, "block long, gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    gram, n = grams["gram"].to_numpy(), grams["n"].to_numpy()
    nodes, counts = [], []
    for level in range(ORDER + 1):
        own = gram & ((1 << 8 * (level + 1)) - 1)
        nodes.append(np.unique(own >> 8) if level else np.zeros(1, np.int64))
        table = np.zeros((len(nodes[-1]), SYMBOLS), np.int64)
        np.add.at(table, (np.searchsorted(nodes[-1], own >> 8), own & 255), n)
        counts.append(table)
    return finish(counts, nodes)


def _block_words(batches: Iterator) -> Iterator:
    """Distinct words of each block with their number in training texts."""
    from collections import Counter

    import pyarrow as pa

    blocks: dict[int, Counter] = {}
    for batch in batches:
        for text, block, train in zip(batch["_text"], batch["_block"].to_pylist(), batch["_train"].to_pylist()):
            counts = blocks.setdefault(block, Counter())
            words = text.as_py().encode("utf-8", "surrogatepass").lower().split()
            if train:
                counts.update(words)
            else:
                counts.update(dict.fromkeys(words, 0))
    for block, counts in blocks.items():
        words = list(counts)
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            yield pa.RecordBatch.from_pydict(
                {
                    "block": pa.array([block] * len(part), pa.int64()),
                    "word": pa.array(part, pa.binary()),
                    "n": pa.array([counts[w] for w in part], pa.int64()),
                }
            )


def _score(end_count: int, train_tokens: int, distinct: int):
    def kernel(key, docs, own):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words, grams = own.filter(pc.is_valid(own["word"])), own.filter(pc.is_valid(own["gram"]))
        gram, log = grams["gram"].combine_chunks(), grams["log"].to_numpy().astype(np.float64)
        number = {w: i for i, w in enumerate(words["word"].to_pylist())}
        count = words["n"].to_numpy().astype(np.float64)
        below = np.log10(train_tokens + distinct + 1)
        logs, known = np.log10(count + 1) - below, count > 0
        end_log = np.log10(end_count + 1) - below
        out = []
        for batch in docs.to_batches():
            for part in slices(batch, SLICE_BYTES, "_text"):
                texts = [t.encode("utf-8", "surrogatepass").lower() for t in part["_text"].to_pylist()]
                n, hits, base = [], [], []
                for text in texts:
                    at = np.array(list(map(number.__getitem__, text.split())), np.int64)
                    n.append(len(at) + 1)
                    hits.append(int(known[at].sum()) + (end_count > 0))
                    base.append(float(logs[at].sum() + end_log))
                data, places, sizes = marked(texts)
                at = pc.index_in(pa.array(contexts(data, places) << 8 | data[places]), value_set=gram).to_numpy()
                out.append(
                    pa.table(
                        {
                            "key": part["_key"],
                            "train": part["_train"],
                            "n_tokens": pa.array(n, pa.int64()),
                            "n_known": pa.array(hits, pa.int64()),
                            "base_score": pa.array(base),
                            "score": pa.array(np.add.reduceat(log[at], np.cumsum(sizes) - sizes)),
                        }
                    )
                )
        return pa.concat_tables(out)

    return kernel


def score(docs: DataFrame, held: Column, key: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: key, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Rows where ``held`` is true are scored but not learned from.
    """
    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"), (~held).alias("_train"))
    kind = rows.schema["_key"].dataType.simpleString()
    blocks = parts_for(total_bytes(rows, "_text"), block_bytes)
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_key", "_text"), F.lit(blocks)).cast("long"))
    by_word = Window.partitionBy("word")
    words = written(
        rows.repartitionById(blocks, F.col("_block").cast("int"))
        .mapInArrow(_block_words, "block long, word binary, n long")
        .withColumn("total", F.sum("n").over(by_word))
        .withColumn("once", F.min("block").over(by_word) == F.col("block"))
        .select("block", "word", "n", "total", "once"),
        "ppm-words",
    )
    figures = words.agg(F.sum("n").alias("n"), F.count_if(F.col("once") & (F.col("total") > 0)).alias("v")).first()
    texts = rows.filter("_train").count()
    train_tokens, distinct = (figures["n"] or 0) + texts, figures["v"] + (texts > 0)
    own = words.select(F.col("block").alias("_block"), "word", F.col("total").alias("n")).unionByName(
        gram_logs(rows, blocks).withColumnRenamed("block", "_block"), allowMissingColumns=True
    )
    scored = (
        rows.groupBy("_block")
        .cogroup(own.groupBy("_block"))
        .applyInArrow(
            _score(texts, train_tokens, distinct),
            f"key {kind}, train boolean, n_tokens long, n_known long, base_score double, score double",
        )
    )
    return scored.select(
        F.col("key").alias(key),
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
