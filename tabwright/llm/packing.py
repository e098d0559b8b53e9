"""Packing by lexical retrieval: a seed document's window is filled with its nearest unused neighbours.

Every text is encoded and gets an end id. All full windows of a document are
sequences of their own; what is left of it (less than a window) is packed in
rounds. A round puts the pieces in order of the first three token ids they hold
in a random order of the vocabulary, in which ids come early in proportion to
their squared idf (a weighted minimum hash: rare shared ids decide, the end id
and ids of a single piece never do), so lexical neighbours stand side by side
wherever they are in the table. The order is cut into shards, each with an
inverted index with BM25 weights over token ids.

In all rounds but the last a seed takes only close neighbours (``CLOSE`` of its
own score) from a shard of ``JOIN_PIECES``; a window they fill is done, and what
they do not fill goes on as one piece, placed anew by another order. Neighbours
that one order parts thus meet in the next, and those found stay together. In
the last round, over shards of ``SHARD_PIECES``, the first unused piece is the
seed: its window takes the unused pieces of the shard by falling BM25 score, the
last one cut to fit, and what is cut off opens the next window. Only the last
sequence of a shard can be short; it is padded to the window unless its length
is a power of two.

Decisions: a missing text is empty and holds its end id alone; neighbours with
equal scores, also those without a shared token, go by their place in the shard;
rows that repeat, and rows without a key, are packed like any others.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.common import finished, parts_for, slices, text_of
from tabwright.llm.unit_encoder import crc_of, opened
from tabwright.session import written

WINDOW = 1024
SHARD_PIECES = 512
JOIN_PIECES = 64
ROUNDS = 3
CLOSE = 0.5  # of the seed's own BM25 score
PLACE_BITS = 21  # of each of the three ranks in a place
NO_PLACE = (1 << 63) - 1
SLICE_BYTES = 4 << 20
K1, B = 1.2, 0.75

PIECES = "key {key}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded_to long"
UNITS = "keys array<{key}>, starts array<long>, lengths array<long>, tokens array<long>, crcs array<long>, rest binary, width int"
PIECE_NAMES = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to"]
UNIT_NAMES = ["keys", "starts", "lengths", "tokens", "crcs", "rest", "width"]


def _encode(tokenizer: str, window: int, end_id: int):
    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encoder = opened(tokenizer)
        end = np.array([end_id], encoder.dtype).tobytes()
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                sizes, crcs, rests, starts = [], [], [], []
                for raw in encoder.encode(part["_text"].to_pylist()):
                    ids = np.frombuffer(raw + end, encoder.dtype)
                    full = len(ids) // window * window
                    sizes.append(len(ids))
                    starts.append(full)
                    crcs.append([crc_of(ids[i : i + window]) for i in range(0, full, window)])
                    rests.append(ids[full:].tobytes())
                one = pa.array(np.arange(len(sizes) + 1), pa.int32())
                each = [pa.array(x, pa.int64()) for x in (starts, [n - s for n, s in zip(sizes, starts)], sizes)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[pa.ListArray.from_arrays(one, x) for x in (part["_key"], *each)],
                        pa.array(crcs, pa.list_(pa.int64())),
                        pa.array(rests, pa.binary()),
                        pa.array([encoder.dtype.itemsize] * len(sizes), pa.int32()),
                    ],
                    names=["keys", "starts", "lengths", "tokens", "crcs", "rest", "width"],
                )

    return kernel


def _token_rows(batches: Iterator) -> Iterator:
    """Number of pieces that hold each token id."""
    import numpy as np
    import pyarrow as pa

    df = np.zeros(0, np.int64)
    for batch in batches:
        for rest, width in zip(batch["rest"].to_pylist(), batch["width"].to_pylist()):
            ids = np.frombuffer(rest, f"<u{width}")
            if len(ids):
                if (top := int(ids.max())) >= len(df):
                    df = np.r_[df, np.zeros(top + 1 - len(df), np.int64)]
                df[ids] += 1  # an id that repeats in a piece counts once
    own = np.flatnonzero(df)
    yield pa.RecordBatch.from_pydict({"token": pa.array(own, pa.int64()), "n": pa.array(df[own], pa.int64())})


def rank_tables(df, n: int, end_id: int, rounds: int) -> list:
    """For each round the place of every token id in a random order that prefers high idf; -1 for ids that bring no neighbours."""
    import numpy as np

    idf = np.log1p((n - df + 0.5) / (df + 0.5))
    useful = df > 1
    if end_id < len(df):
        useful[end_id] = False
    tables = []
    for number in range(rounds):
        drawn = finished(np.arange(len(df), dtype=np.uint64) + np.uint64((number + 1) << 40)) >> np.uint64(11)
        cost = -np.log((drawn + 0.5) / (1 << 53)) / np.maximum(idf, 1e-9) ** 2
        cost[~useful] = np.inf
        ranks = np.empty(len(df), np.int64)
        ranks[np.argsort(cost, kind="stable")] = np.arange(len(df))
        ranks[~useful] = -1
        tables.append(ranks)
    return tables


def places_of(ids, starts, ranks):
    """The three lowest ranks of each piece as one number; pieces are not empty and lie in a row from ``starts``."""
    import numpy as np

    none = np.int32((1 << PLACE_BITS) - 1)
    rest = np.where(ranks < 0, none, ranks).astype(np.int32)[ids]
    sizes = np.diff(np.append(starts, len(ids)))
    lowest = np.minimum.reduceat(rest, starts)
    places, some = lowest.astype(np.int64), lowest < none
    for _ in range(2):
        rest[rest == np.repeat(lowest, sizes)] = none
        lowest = np.minimum.reduceat(rest, starts)
        places = places << PLACE_BITS | lowest
    return np.where(some, places, NO_PLACE)


def _placed(handle, number: int):
    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        ranks = handle.value[number]
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch["rest"]), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            widths = batch["width"].to_numpy(zero_copy_only=False)
            places = np.full(batch.num_rows, NO_PLACE)
            for width in np.unique(widths).tolist():
                own = np.flatnonzero((widths == width) & (sizes > 0))
                for part in np.split(own, np.flatnonzero(np.diff(np.cumsum(sizes[own]) // SLICE_BYTES)) + 1):
                    if len(part):
                        ids = np.frombuffer(b"".join(batch["rest"].take(pa.array(part)).to_pylist()), f"<u{width}")
                        ends = np.cumsum(sizes[part] // width)
                        places[part] = places_of(ids, ends - sizes[part] // width, ranks)
            yield batch.append_column("place", pa.array(places, pa.int64()))

    return kernel


class Bm25:
    """Inverted index of a shard: postings by token id, each with its BM25 weight."""

    def __init__(self, pieces: list):
        import numpy as np

        self.n = len(pieces)
        sizes = np.array([len(p) for p in pieces], np.int64)
        flat = np.concatenate(pieces)
        kind = np.int32 if (int(flat.max()) + 1) * self.n < 1 << 31 else np.int64  # short numbers sort faster
        pairs = flat.astype(kind) * kind(self.n) + np.repeat(np.arange(self.n, dtype=kind), sizes)
        pairs, counts = np.unique(pairs, return_counts=True)
        token, self.doc = np.divmod(pairs, self.n)
        starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
        self.starts, self.ends = starts, np.r_[starts[1:], len(token)]
        self.numbers = np.arange(len(token))
        df = self.ends - self.starts
        idf = np.log1p((self.n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * sizes[self.doc] / max(1.0, sizes.mean()))
        self.weight = (np.repeat(idf, df) * counts * (K1 + 1) / (counts + norm)).astype(np.float32).astype(float)
        term = np.repeat(np.arange(len(starts)), df)
        by_doc = np.argsort(self.doc, kind="stable")
        self.terms = np.split(term[by_doc], np.cumsum(np.bincount(self.doc, minlength=self.n))[:-1])
        self.doc = self.doc.astype(np.int64)

    def drop(self, gone) -> None:
        """Forget the postings of the pieces marked in ``gone``; their score is 0 from now on."""
        import numpy as np

        kept = ~gone[self.doc]
        before = np.zeros(len(kept) + 1, np.int64)
        np.cumsum(kept, out=before[1:])
        self.starts, self.ends = before[self.starts], before[self.ends]
        self.doc, self.weight = self.doc[kept], self.weight[kept]

    def scores(self, seed: int):
        """BM25 score of every piece of the shard for the distinct tokens of the seed."""
        import numpy as np

        terms = self.terms[seed]
        starts = self.starts[terms]
        sizes = self.ends[terms] - starts
        ends = np.cumsum(sizes)
        at = np.repeat(starts - ends + sizes, sizes)
        at += self.numbers[: len(at)]
        return np.bincount(self.doc[at], weights=self.weight[at], minlength=self.n)


def fill(pieces: list, window: int, close: float = 0.0) -> list[list[tuple[int, int, int]]]:
    """Sequences of (piece, start in it, length) that use every token of every piece once.

    Neighbours below ``close`` of the seed's own score are left to later seeds.
    """
    import numpy as np

    index = Bm25(pieces)
    sizes = [len(p) for p in pieces]
    used = np.zeros(index.n, bool)
    out, carried, first, held = [], None, 0, index.n
    while True:
        while first < index.n and used[first]:
            first += 1
        if carried is None and first == index.n:
            return out
        unused = index.n - int(np.count_nonzero(used))
        if 3 * unused < 2 * held:  # used pieces are scored no more
            gone = used.copy()
            if carried:
                gone[carried[0]] = False
            index.drop(gone)
            held = unused
        seed, start = carried or (first, 0)
        carried = None
        used[seed] = True
        room = window - (sizes[seed] - start)
        sequence = [(seed, start, sizes[seed] - start)]
        if room and not used.all():
            scores = index.scores(seed)
            least = close * scores[seed]
            scores[used] = -1
            for i in np.argsort(-scores, kind="stable").tolist():
                if not room or used[i] or scores[i] < least:
                    break
                used[i] = True
                taken = min(room, sizes[i])
                sequence.append((i, 0, taken))
                room -= taken
                if taken < sizes[i]:
                    carried = (i, taken)
        out.append(sequence)


def padded_length(length: int, window: int) -> int:
    """The window, or the length itself where that is a power of two."""
    return length if length & (length - 1) == 0 else window


def members(unit: dict, start: int, size: int) -> Iterator:
    """(key, start in the document, length, tokens of the document, start in the unit) of a part of a unit."""
    at = 0
    for key, first, length, tokens in zip(unit["keys"], unit["starts"], unit["lengths"], unit["tokens"]):
        low, high = max(start, at), min(start + size, at + length)
        if low < high:
            yield key, first + low - at, high - low, tokens, low
        at += length


def _pack(window: int, shard_pieces: int, number: int, last: bool):
    """One round: rows of done sequences, and units that are left (none in the last round)."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        sequence = (TaskContext.get().partitionId() << 4 | number) << 36
        held, kind = [], None

        def packed(rows):
            nonlocal sequence
            out, left = [], []
            for r in rows:
                for i, crc in enumerate(r["crcs"]):
                    out.append((r["keys"][0], i * window, window, crc, r["tokens"][0], sequence, 0, window))
                    sequence += 1
            rows = [r for r in rows if r["rest"]]
            if rows:
                pieces = [np.frombuffer(r["rest"], f"<u{r['width']}") for r in rows]
                for parts in fill(pieces, window, 0.0 if last else CLOSE):
                    total = sum(p[2] for p in parts)
                    own = [(i, m) for i, start, size in parts for m in members(rows[i], start, size)]
                    if total < window and not last:
                        rest = b"".join(pieces[i][start : start + size].tobytes() for i, start, size in parts)
                        left.append((*[[m[k] for _, m in own] for k in range(4)], [], rest, rows[parts[0][0]]["width"]))
                        continue
                    length = padded_length(total, window)
                    offset = 0
                    for i, (key, first, size, tokens, at) in own:
                        out.append((key, first, size, crc_of(pieces[i][at : at + size]), tokens, sequence, offset, length))
                        offset += size
                    sequence += 1
            longs = pa.list_(pa.int64())
            done = dict(zip(PIECE_NAMES, [kind, *[pa.int64()] * 7]))
            open_ = dict(zip(UNIT_NAMES, [pa.list_(kind), longs, longs, longs, longs, pa.binary(), pa.int32()]))
            for found, own in ((out, done), (left, open_)):
                if found:
                    columns = dict(zip(own, zip(*found)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[c], t) if c in own else pa.nulls(len(found), t) for c, t in (done | open_).items()],
                        names=[*done, *open_],
                    )

        for batch in batches:
            kind = batch.schema.field("keys").type.value_type
            held += batch.to_pylist()
            while len(held) >= shard_pieces:
                yield from packed(held[:shard_pieces])
                held = held[shard_pieces:]
        if held:
            yield from packed(held)

    return kernel


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    end_id: int = 0,
    shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to.

    The encoded pieces are written once; in each round a range shuffle on (place,
    key, tokens) brings neighbours together and splits hot places. Tasks hold one
    shard of rows at a time. The driver sees one number per token id.
    """
    import numpy as np

    rows = docs.select(F.col(key).alias("_key"), text_of(text).alias("_text"))
    kind = rows.schema["_key"].dataType.simpleString()
    schema = UNITS.format(key=kind)
    units = written(rows.mapInArrow(_encode(tokenizer, window, end_id), schema), "pack-encoded")
    count = units.count()
    found = (
        units.select("rest", "width").mapInArrow(_token_rows, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    )
    token = found["token"].to_numpy()
    df = np.zeros(int(token.max()) + 1 if len(token) else 1, np.int64)
    df[token] = found["n"].to_numpy()
    handle = docs.sparkSession.sparkContext.broadcast(rank_tables(df, count, end_id, ROUNDS))
    order = ["place", F.col("keys")[0], F.col("tokens")[0], F.xxhash64("rest", "crcs", "starts")]
    done = []
    for number in range(ROUNDS):
        last = number == ROUNDS - 1
        n_parts = parts_for(count, 16 * shard_pieces)
        out = (
            units.mapInArrow(_placed(handle, number), f"{schema}, place long")
            .repartitionByRange(n_parts, *order)
            .sortWithinPartitions(*order)
            .mapInArrow(
                _pack(window, shard_pieces if last else min(shard_pieces, JOIN_PIECES), number, last),
                f"{PIECES.format(key=kind)}, {schema}",
            )
        )
        if not last:
            out = written(out, "pack-round")
            units = out.filter("rest is not null").select(*UNIT_NAMES)
            count = units.count()
        done.append(out.filter("rest is null").select(*PIECE_NAMES))
    return reduce(DataFrame.unionAll, done).withColumnRenamed("key", key)
