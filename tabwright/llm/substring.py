"""Removal of passages that an earlier document has, by suffix automata over words.

A passage is a run of ``WINDOW`` words or more that also stands in a document
with a smaller key. Suffix automata of the texts before a document tell, word by
word, the longest run that ends there and has been seen (its matching
statistic); runs of ``WINDOW`` words and more are removed.

One automaton of everything would have to visit every task, and every document
every automaton. Instead the texts are cut into shards by content: each window
has an anchor, the ``GRAM`` consecutive words in it with the smallest hash, so
equal windows have equal anchors wherever they stand. A segment is the stretch
of a document whose windows share an anchor occurrence. Only anchors of two
different texts go on. Each anchor is a shard: its segments stream by ascending
key past the automaton of those before them, then join it. An anchor with more
than ``HOT`` segments, as one text in ``DRAWN`` tells, is split by the windows
themselves: equal windows meet in an aggregate that combines before the shuffle.
Either way gives the same rows, so the sample decides only where the work is done.

Words are compared by 64-bit hashes, ``WINDOW`` in a row. Windows are judged on
the input, not on what is left.

Decisions: words are runs of other characters than ASCII white space, unchanged;
a missing text has none; a copy of an earlier whole text loses every word if it
has ``WINDOW`` words; rows that share a key do not take from each other; rows
without a key lose nothing and give nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import finished, groups, slices, text_of, word_hashes
from tabwright.operators.order import hot_key_join
from tabwright.session import written

WINDOW = 13
GRAM = 5
HOT = 20_000  # segments of an anchor that one automaton takes: about 200 MB if all differ
DRAWN = 64  # one text in so many tells which anchors crowd
CROWDED = 10_000
KNOWN = 1_000_000  # hot anchors that every task may be told: 8 MB
SLICE_BYTES = 1 << 20


def anchors_of(words, window: int, gram: int):
    """First window and last window of each stretch with one anchor, and the anchor's hash."""
    import numpy as np

    n = len(words) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.full(len(words) - gram + 1, 1, np.uint64)
    for i in range(gram):
        h = (h * np.uint64(0x9E3779B97F4A7C15)) ^ words[i : len(words) - gram + 1 + i]
        h ^= h >> np.uint64(29)
    h = finished(h)
    spread = window - gram + 1
    best, at = h[:n].copy(), np.arange(n)
    for i in range(1, spread):  # the leftmost of equal hashes
        other = h[i : n + i]
        less = other < best
        best[less] = other[less]
        at[less] = np.flatnonzero(less) + i
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    last = np.r_[first[1:], n] - 1
    return first, last, h[at[first]].view(np.int64)


class Automaton:
    """Suffix automaton of several word sequences, built online."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def add(self, words: list[int]) -> None:
        last = 0
        for w in words:
            last = self._extend(last, w)

    def _clone(self, p: int, q: int, w: int) -> int:
        clone = len(self.next)
        self.next.append(self.next[q].copy())
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = clone
            p = self.link[p]
        return clone

    def _extend(self, p: int, w: int) -> int:
        q = self.next[p].get(w)
        if q is not None:  # the word continues a sequence added before
            return q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[p] + 1)
        self.link.append(0)
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, w)
        return new

    def matches(self, words: list[int], least: int) -> list[tuple[int, int]]:
        """Maximal runs (start, end) of ``words``, of ``least`` words or more, that some sequence holds."""
        state, size, out = 0, 0, []
        for i, w in enumerate(words):
            while state and w not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if w in self.next[state]:
                state, size = self.next[state][w], size + 1
            else:
                size = 0
            if size >= least:
                start = i + 1 - size
                if out and start <= out[-1][1]:
                    out[-1] = (min(start, out[-1][0]), i + 1)
                else:
                    out.append((start, i + 1))
        return out


def _describe(window: int, gram: int):
    def kernel(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                sizes, digests, anchors = [], [], []
                for text in part["_text"].to_pylist():
                    data = text.encode("utf-8", "surrogatepass")
                    words = data.split()
                    sizes.append(len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                    hashes, _, _ = word_hashes(data)
                    anchors.append(np.unique(anchors_of(hashes, window, gram)[2]))
                offsets = np.cumsum([0, *map(len, anchors)]).astype(np.int32)
                flat = np.concatenate(anchors) if anchors else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["key"],
                        part["tid"],
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=["key", "tid", "n_words", "sha", "anchors"],
                )

    return kernel


def _among(handle):
    """Which anchors are in a broadcast array."""
    import numpy as np

    return lambda anchors: np.isin(anchors, handle.value)


def _common(handle):
    """Rows (tag, shared): the anchors of each text that are in the broadcast array."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            flat = batch["anchors"].flatten().to_numpy(zero_copy_only=False)
            sizes = batch["anchors"].value_lengths().to_numpy(zero_copy_only=False)
            hit = _among(handle)(flat)
            offsets = np.r_[0, np.cumsum(hit)][np.r_[0, np.cumsum(sizes)]].astype(np.int32)
            out = pa.RecordBatch.from_arrays(
                [batch["tag"], pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[hit], pa.int64()))], names=["tag", "shared"]
            )
            yield out.filter(pa.array(offsets[1:] > offsets[:-1]))

    return kernel


def _stretches(part, window: int, gram: int, handle=None, inside: bool = False):
    """For each text: row, word hashes, first and last window of the segments with a shared anchor, their anchors.

    With ``handle`` only anchors that are in the broadcast array (``inside``) or are not; a text without one is passed over.
    """
    import numpy as np

    for row, (text, shared) in enumerate(zip(part["_text"].to_pylist(), part["shared"])):
        wanted = shared.values.to_numpy(zero_copy_only=False)
        if handle is not None:
            wanted = wanted[_among(handle)(wanted) == inside]
        if len(wanted):
            hashes, _, _ = word_hashes(text.encode("utf-8", "surrogatepass"))
            first, last, anchor = anchors_of(hashes, window, gram)
            ours = np.isin(anchor, wanted)
            yield row, hashes, first[ours], last[ours], anchor[ours]


def _tallies(window: int, gram: int):
    """Rows (anchor, n): segments of each anchor."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                found = [np.zeros(0, np.int64), *(anchor for *_, anchor in _stretches(part, window, gram))]
                anchor, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    return kernel


def _segments(window: int, gram: int, handle=None, inside: bool = False):
    """Segments of the documents whose anchors are in ``shared``, as 64-bit word hashes; equal ones of a text are one row."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                rows, anchors, starts, words = [], [], [], []
                for row, hashes, first, last, anchor in _stretches(part, window, gram, handle, inside):
                    own: dict[bytes, list[int]] = {}  # equal segments have equal anchors
                    for a, b, c in zip(first.tolist(), (last + window).tolist(), anchor.tolist()):
                        run = hashes[a:b].tobytes()
                        if run in own:
                            own[run].append(a)
                            continue
                        own[run] = [a]
                        anchors.append(c)
                    rows += [row] * len(own)
                    starts += own.values()
                    words += own
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchors, pa.int64()),
                        part["key"].take(at),
                        part["tag"].take(at),
                        pa.array(starts, pa.list_(pa.int64())),
                        pa.array(words, pa.binary()),
                    ],
                    names=["anchor", "key", "tag", "starts", "words"],
                )

    return kernel


def _stream(window: int):
    """Ranges of words (key, tag, ranges) to remove; rows come sorted by anchor and key."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        out: list[tuple[int, int, list, list]] = []  # key, tag, starts and ends of ranges
        held = 0

        def flushed():
            nonlocal held
            keys, tags, starts, ends = zip(*out)
            offsets = pa.array(np.cumsum([0, *map(len, starts)]), pa.int32())
            flat = [pa.array([x for own in c for x in own], pa.int64()) for c in (starts, ends)]
            out.clear()
            held = 0
            ranges = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(flat, ["start", "end"]))
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(tags, pa.int64()), ranges], ["key", "tag", "ranges"])

        for table in groups(batches, ["anchor"]):
            keys, starts = table["key"].to_pylist(), table["starts"].to_pylist()
            tags, words = table["tag"].to_pylist(), table["words"].to_pylist()
            if len(keys) < 2:
                continue
            seen: set[bytes] = set()
            waiting: list[bytes] = []  # seen, but not in the automaton yet
            automaton = Automaton()
            i = 0
            while i < len(keys):
                end = i
                while end < len(keys) and keys[end] == keys[i]:
                    end += 1
                new: dict[bytes, list] = {}  # what of each segment has been seen
                for j in range(i, end):
                    if words[j] in seen:
                        runs = [(0, len(words[j]) // 8)]
                    else:
                        if words[j] not in new:
                            for w in waiting:
                                automaton.add(np.frombuffer(w, np.int64).tolist())
                            waiting = []
                            run = np.frombuffer(words[j], np.int64).tolist()
                            new[words[j]] = automaton.matches(run, window) if seen else []
                        runs = new[words[j]]
                    if runs:
                        out.append((keys[j], tags[j], [s + a for s in starts[j] for a, _ in runs], [s + b for s in starts[j] for _, b in runs]))
                        held += len(starts[j]) * len(runs)
                seen.update(new)
                waiting += new
                i = end
            if held > 20_000:
                yield flushed()
        if out:
            yield flushed()

    return kernel


def _kept(batches: Iterator) -> Iterator:
    """Words removed, and the kept words joined by one space."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        for part in slices(batch, SLICE_BYTES, "_text"):
            removed, kept = [], []
            for text, ranges in zip(part["_text"].to_pylist(), part["ranges"].to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(words) + 1, np.int64)
                for r in ranges:
                    gone[r["start"]] += 1
                    gone[r["end"]] -= 1
                stays = np.cumsum(gone)[:-1] == 0
                removed.append(int(len(words) - stays.sum()))
                kept.append(b" ".join([w for w, s in zip(words, stays.tolist()) if s]).decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays(
                [part["key"], part["tid"], pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=["key", "tid", "n_removed", "kept"]
            )


def removed_ranges(candidates: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Ranges of words (key, tag, ranges) of the candidates (key, tag, _text, shared) that an earlier one has."""
    spark, schema = candidates.sparkSession, "anchor long, key long, tag long, starts array<long>, words binary"
    drawn = candidates.filter(F.pmod("tag", F.lit(DRAWN)) == 0).mapInArrow(_tallies(window, gram), "anchor long, n long")
    tallies = drawn.groupBy("anchor").agg(F.sum("n").alias("n"))
    crowded = written(tallies.filter(F.col("n") * DRAWN > hot).select("anchor"), "passage-hot")
    many = crowded.count()
    if many <= KNOWN:
        import numpy as np

        handle = spark.sparkContext.broadcast(np.array(sorted(r["anchor"] for r in crowded.collect()), np.int64)) if many else None
        plain = candidates.mapInArrow(_segments(window, gram, handle), schema)
        dense = candidates.mapInArrow(_segments(window, gram, handle, True), schema)
    else:
        segments = candidates.mapInArrow(_segments(window, gram), schema)
        plain, dense = segments.join(crowded, "anchor", "left_anti"), segments.join(crowded, "anchor", "left_semi")
    ranges = (
        plain.repartition(F.col("anchor"))
        .sortWithinPartitions("anchor", "key")
        .mapInArrow(_stream(window), "key long, tag long, ranges array<struct<start: long, end: long>>")
    )
    if not many:
        return ranges
    dense = written(dense.select("key", "tag", "starts", "words"), "passage-dense")
    # of equal segments only those of the smallest key are looked into; the others go whole
    different = dense.groupBy("words").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count(F.lit(1)).alias("rows"))
    different = written(different, "passage-different")
    windows = different.withColumn("i", F.explode(F.sequence(F.lit(0), F.floor(F.octet_length("words") / 8).cast("int") - window))).select(
        "words", "first", "i", F.substring("words", F.col("i") * 8 + 1, F.lit(window * 8)).alias("run")
    )
    owners = windows.groupBy("run").agg(F.min("first").alias("owner"), F.max("first").alias("latest"), F.count(F.lit(1)).alias("n"))
    owners = written(owners.filter(F.col("owner") < F.col("latest")).drop("latest"), "passage-runs")
    seen = hot_key_join(windows, owners, "run", "n").filter(F.col("owner") < F.col("first"))
    seen = seen.groupBy("words").agg(F.collect_list("i").alias("seen"))  # no more than a segment has windows
    known = different.join(seen, "words", "left").filter((F.col("first") < F.col("last")) | F.col("seen").isNotNull())
    known = written(known.select("words", "first", "seen", "rows"), "passage-known")
    size = F.floor(F.octet_length("words") / 8)
    whole = F.transform("starts", lambda s: F.struct(s.alias("start"), (s + size).alias("end")))
    parts = F.transform(
        "starts", lambda s: F.transform("seen", lambda i: F.struct((s + i).alias("start"), (s + i + window).alias("end")))
    )
    gone = F.when(F.col("key") > F.col("first"), whole).otherwise(F.flatten(parts))
    later = hot_key_join(dense, known, "words", "rows").select("key", "tag", gone.alias("ranges")).filter("ranges is not null")
    return ranges.unionByName(later)


def shared_anchors(tagged: DataFrame) -> DataFrame:
    """Rows (tag, shared) of the texts (tag, anchors) with the anchors that another tag has too.

    One shuffle: sorted by anchor and tag, a row tells by its neighbours. Anchors
    that would crowd a task, those with a ``CROWDED``-th of a sample's rows, are
    fewer than ``CROWDED``: each task is told and picks them out of the lists; two
    tags of them have been seen in the sample, so the result is the same.
    """
    import numpy as np

    loose = tagged.select("tag", F.explode("anchors").alias("anchor"))
    drawn = loose.filter(F.pmod("tag", F.lit(DRAWN)) == 0)
    total = drawn.count()
    crowded = (
        drawn.groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("tag").alias("a"), F.max("tag").alias("b"))
        .filter((F.col("n") * CROWDED > total) & (F.col("a") != F.col("b")))
        .select("anchor")
    )
    crowded = written(crowded, "passage-crowded")
    by_anchor = Window.partitionBy("anchor").orderBy("tag")
    rest = (
        loose.join(F.broadcast(crowded), "anchor", "left_anti")
        .withColumn("before", F.lag("tag").over(by_anchor))
        .withColumn("after", F.lead("tag").over(by_anchor))
        .filter((F.col("before") != F.col("tag")) | (F.col("after") != F.col("tag")))
        .groupBy("tag")
        .agg(F.collect_set("anchor").alias("shared"))  # no more than the text has words
    )
    known = sorted(r["anchor"] for r in crowded.collect())
    if not known:
        return rest
    handle = tagged.sparkSession.sparkContext.broadcast(np.array(known, np.int64))
    common = tagged.mapInArrow(_common(handle), "tag long, shared array<long>").dropDuplicates(["tag"])
    both = rest.join(common.withColumnRenamed("shared", "common"), "tag", "full_outer")
    none = F.array().cast("array<long>")
    return both.select("tag", F.concat(F.coalesce("shared", none), F.coalesce("common", none)).alias("shared"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, gram: int = GRAM, hot: int = HOT
) -> tuple[DataFrame, DataFrame]:
    """What is left of each document, as two tables.

    The first has one row per row of ``docs``: key, n_words, tid (SHA-256 of the
    text), owner (smallest key with this text), sha (of all its words). The
    second has one row per key and tid that loses a part: key, tid, n_removed,
    kept (the words that stay, joined by one space). Keys are integers.
    """
    rows = docs.select(F.col(key).cast("long").alias("key"), text_of(text).alias("_text")).withColumn(
        "tid", F.unhex(F.sha2("_text", 256))
    )
    described = written(
        rows.mapInArrow(
            _describe(window, gram), "key long, tid binary, n_words long, sha string, anchors array<long>"
        ),
        "passage-anchors",
    )
    owners = written(
        described.groupBy("tid").agg(F.min("key").alias("owner"), F.count(F.lit(1)).alias("copies")), "passage-owners"
    )
    first = owners.select("tid", F.col("owner").alias("key"))
    candidates = shared_anchors(described.filter(F.col("key").isNotNull()).select(F.xxhash64("tid").alias("tag"), "anchors"))
    chosen = first.withColumn("tag", F.xxhash64("tid")).join(candidates, "tag")
    texts = written(
        rows.join(chosen, ["key", "tid"]).dropDuplicates(["key", "tid"]).select("key", "tid", "tag", "_text", "shared"), "passage-texts"
    )
    ranges = removed_ranges(texts, window, gram, hot)
    by_key = ranges.groupBy("key", "tag").agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    parts = (
        texts.select("key", "tid", "tag", "_text")
        .join(by_key, ["key", "tag"])
        .select("key", "tid", "_text", "ranges")
        .mapInArrow(_kept, "key long, tid binary, n_removed long, kept string")
    )
    whole = hot_key_join(described.select("key", "tid", "n_words", "sha"), owners, "tid", "copies", "left")
    return whole, parts


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: key, n_words, n_removed, kept_sha256."""
    whole, parts = remove_repeats(docs, key, text, window)
    parts = written(parts.select("key", "tid", "n_removed", F.sha2("kept", 256).alias("kept_sha")), "passage-kept")
    all_gone = (F.col("key") > F.col("owner")) & (F.col("n_words") >= window)
    owned = F.col("key") == F.col("owner")
    return whole.join(parts, ["key", "tid"], "left").select(
        F.col("key").alias(key),
        "n_words",
        F.when(all_gone, F.col("n_words"))
        .when(owned, F.coalesce("n_removed", F.lit(0).cast("long")))
        .otherwise(F.lit(0).cast("long"))
        .alias("n_removed"),
        F.when(all_gone, F.sha2(F.lit(""), 256)).when(owned, F.coalesce("kept_sha", "sha")).otherwise(F.col("sha")).alias("kept_sha256"),
    )
