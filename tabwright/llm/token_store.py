"""Token ids in binary shards, found by document key through a minimal perfect hash.

Files of a store, below one folder:

* ``shard-00007.ids``: the ids of the shard's documents in a row, little-endian
  integers of two bytes where the vocabulary allows it, else of four;
* ``shard-00007.off``: int64 positions, one per document and one at the end;
* ``index-00003.npz``: for the keys of one hash bucket, the bit levels of a
  minimal perfect hash, and by slot a 32-bit fingerprint, the shard, the
  document's number there and how many documents have the key;
* ``manifest.parquet``: documents and ids of each shard.

Shards hold documents in ascending key order (missing keys first, equal keys by
a hash of the text). A lookup hashes the key, reads one slot and compares the
fingerprint: constant time whatever the number of documents. Every file is
written under a name of its own and renamed when it is whole, so a task that
runs again leaves the same files.

Decisions: a missing text is empty and holds only the end id; documents without
a key are stored but not indexed (``null_keys`` of the manifest counts them, and
they come first); rows that share a key stand in a row, and the slot counts them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm.common import parts_for, slices, text_of, total_bytes
from tabwright.llm.unit_encoder import crc_of, opened
from tabwright.session import fresh_path, written

SHARD_BYTES = 24 << 20  # text of a shard
BUCKET_KEYS = 100_000  # keys of an index file
SLICE_BYTES = 4 << 20  # text encoded at once
GAMMA = 2.0  # bits of a level for each key that comes to it
MAX_LEVELS = 40


def mixed(keys, seed: int):
    """64-bit hashes of int64 keys."""
    import numpy as np

    x = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Minimal perfect hash of distinct int64 keys: each level keeps the keys that meet no other in its bits."""

    def __init__(self, levels: list, rest):
        import numpy as np

        self.levels, self.rest = levels, rest
        self.before = np.cumsum([0, *(int(b.sum()) for b in levels)])
        self.rank = [np.cumsum(b) - b for b in levels]

    @classmethod
    def build(cls, keys) -> "PerfectHash":
        import numpy as np

        levels, rest = [], np.asarray(keys, np.int64)
        while len(rest) and len(levels) < MAX_LEVELS:
            at = mixed(rest, len(levels)) % np.uint64(max(1, int(GAMMA * len(rest))))
            alone = np.bincount(at.astype(np.int64), minlength=max(1, int(GAMMA * len(rest)))) == 1
            levels.append(alone)
            rest = rest[~alone[at.astype(np.int64)]]
        return cls(levels, np.sort(rest))

    def __len__(self) -> int:
        return int(self.before[-1]) + len(self.rest)

    def slots(self, keys):
        """Slot of each key, -1 where no level has it; a key that was never added may get any slot."""
        import numpy as np

        keys = np.asarray(keys, np.int64)
        out = np.full(len(keys), -1, np.int64)
        for i, bits in enumerate(self.levels):
            open_ = np.flatnonzero(out < 0)
            if not len(open_):
                return out
            at = (mixed(keys[open_], i) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[open_[hit]] = self.before[i] + self.rank[i][at[hit]]
        open_ = np.flatnonzero(out < 0)
        if len(self.rest) and len(open_):
            at = np.searchsorted(self.rest, keys[open_]).clip(max=len(self.rest) - 1)
            hit = self.rest[at] == keys[open_]
            out[open_[hit]] = self.before[-1] + at[hit]
        return out


def fingerprint(keys):
    import numpy as np

    return (mixed(keys, 1000) >> np.uint64(32)).astype(np.uint32)


def bucket_of(keys, n: int):
    import numpy as np

    return (mixed(keys, 2000) % np.uint64(n)).astype(np.int64)


def _opened(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def put(folder: str, name: str, data: bytes) -> None:
    """Write a file whole: under another name first, then renamed."""
    system, base = _opened(folder)
    draft = f"{base}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{base}/{name}")


def get(folder: str, name: str, start: int = 0, size: int | None = None) -> bytes:
    system, base = _opened(folder)
    with system.open_input_file(f"{base}/{name}") as f:
        if start:
            f.seek(start)
        return f.read() if size is None else f.read(size)


@dataclass
class TokenStore:
    """A written store; ``manifest`` holds shard, first (documents before it), start (ids before it), docs, ids."""

    spark: SparkSession
    folder: str
    width: int
    buckets: int
    null_keys: int
    manifest: list[tuple[int, int, int, int, int]]

    def lookup(self, key: int) -> list[list[int]]:
        """Ids of each document with this key, through the index; empty if there is none."""
        import numpy as np

        keys = np.array([key], np.int64)
        if not self.manifest or not self.buckets:
            return []
        index = open_index(self.folder, int(bucket_of(keys, self.buckets)[0]))
        if index is None:
            return []
        shard, number, copies = (x.tolist() for x in index.find(keys))
        if not copies[0]:
            return []
        place = {row[0]: i for i, row in enumerate(self.manifest)}
        out, at, i = [], number[0], place[shard[0]]
        for _ in range(copies[0]):
            while at >= self.manifest[i][3]:
                at, i = 0, i + 1
            offsets = np.frombuffer(get(self.folder, f"shard-{self.manifest[i][0]:05d}.off", at * 8, 16), "<i8")
            raw = get(
                self.folder,
                f"shard-{self.manifest[i][0]:05d}.ids",
                int(offsets[0]) * self.width,
                int(offsets[1] - offsets[0]) * self.width,
            )
            out.append(np.frombuffer(raw, f"<u{self.width}").tolist())
            at += 1
        return out


@dataclass
class Index:
    hash: PerfectHash
    prints: object
    shard: object
    number: object
    copies: object

    def find(self, keys):
        """Shard, number there and documents of each key; no documents for a key that is not in the index."""
        import numpy as np

        if not len(self.hash):
            nothing = np.zeros(len(keys), np.int64)
            return nothing, nothing, nothing
        slot = self.hash.slots(keys)
        known = (slot >= 0) & (self.prints[slot] == fingerprint(keys))
        return self.shard[slot], self.number[slot], np.where(known, self.copies[slot], 0)


def open_index(folder: str, bucket: int) -> Index | None:
    import io

    import numpy as np

    try:
        raw = get(folder, f"index-{bucket:05d}.npz")
    except FileNotFoundError:  # no key fell into this bucket
        return None
    z = np.load(io.BytesIO(raw))
    bits = np.unpackbits(z["bits"])[: int(z["sizes"].sum())].astype(np.int64)
    levels = np.split(bits, np.cumsum(z["sizes"])[:-1]) if len(z["sizes"]) else []
    levels = [level.astype(bool) for level in levels]
    return Index(PerfectHash(levels, z["rest"]), z["prints"], z["shard"], z["number"], z["copies"])


def _write_index(folder: str):
    def kernel(key, table):
        import io

        import numpy as np
        import pyarrow as pa

        keys = table["key"].to_numpy()
        found = PerfectHash.build(keys)
        slot = found.slots(keys)
        columns = {}
        for name, kind in (("shard", np.int64), ("number", np.int64), ("copies", np.int64)):
            columns[name] = np.empty(len(keys), kind)
            columns[name][slot] = table[name].to_numpy()
        prints = np.empty(len(keys), np.uint32)
        prints[slot] = fingerprint(keys)
        out = io.BytesIO()
        np.savez(
            out,
            bits=np.packbits(np.concatenate([np.zeros(0, bool), *found.levels])),
            sizes=np.array([len(b) for b in found.levels], np.int64),
            rest=found.rest,
            prints=prints,
            **columns,
        )
        put(folder, f"index-{key[0].as_py():05d}.npz", out.getvalue())
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "keys": pa.array([len(keys)], pa.int64())})

    return kernel


def _write_shards(folder: str, tokenizer: str, end_id: int):
    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder, shard = opened(tokenizer), TaskContext.get().partitionId()
        system, base = _opened(folder)
        draft = f"{base}/.shard-{shard:05d}.{uuid.uuid4().hex}"
        end = np.array([end_id], encoder.dtype).tobytes()
        width, at, lengths, out = encoder.dtype.itemsize, 0, [0], None
        for batch in batches:
            for part in slices(batch, SLICE_BYTES, "_text"):
                if out is None:
                    out = system.open_output_stream(draft)
                sizes = []
                for ids in encoder.encode(part["_text"].to_pylist()):
                    out.write(ids + end)
                    sizes.append(len(ids) // width + 1)
                n = np.array(sizes, np.int64)
                lengths.extend((lengths[-1] + np.cumsum(n)).tolist())
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": part["_key"],
                        "shard": pa.array(np.full(len(n), shard, np.int64)),
                        "number": pa.array(np.arange(at, at + len(n), dtype=np.int64)),
                        "n_tokens": pa.array(n),
                    }
                )
                at += len(n)
        if out is not None:
            out.close()
            put(folder, f"shard-{shard:05d}.off", np.array(lengths, "<i8").tobytes())
            system.move(draft, f"{base}/shard-{shard:05d}.ids")

    return kernel


def write_store(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    folder: str | None = None,
    shard_bytes: int = SHARD_BYTES,
    bucket_keys: int = BUCKET_KEYS,
) -> TokenStore:
    """Encode every text, append ``end_id`` and write ids, offsets, index and manifest.

    One range shuffle of the texts puts keys in order; the hash of the text in
    the ordering splits a key that very many rows share. The driver sees one row
    per shard.
    """
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-store")
    system, base = _opened(folder)
    system.create_dir(base, recursive=True)
    rows = docs.select(F.col(key).cast("long").alias("_key"), text_of(text).alias("_text"))
    order = [F.col("_key").asc_nulls_first(), F.xxhash64("_text"), F.col("_text")]
    n_shards = parts_for(total_bytes(rows, "_text"), shard_bytes)
    placed = rows.repartitionByRange(n_shards, *order[:2]).sortWithinPartitions(*order)
    entries = written(
        placed.mapInArrow(
            _write_shards(folder, tokenizer, end_id), "key long, shard long, number long, n_tokens long"
        ),
        "token-entries",
    )
    shards = (
        entries.groupBy("shard")
        .agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("ids"), F.count("key").alias("keyed"))
        .orderBy("shard")
        .collect()
    )  # one row per shard
    manifest, first, start = [], 0, 0
    for r in shards:
        manifest.append((r["shard"], first, start, r["docs"], r["ids"]))
        first, start = first + r["docs"], start + r["ids"]
    keyed = sum(r["keyed"] for r in shards)
    buckets = parts_for(keyed, bucket_keys) if keyed else 0
    if buckets:
        place = F.struct("shard", "number")
        by_key = (
            entries.filter(F.col("key").isNotNull())
            .groupBy("key")
            .agg(F.min(place).alias("p"), F.count(F.lit(1)).alias("copies"))
            .select("key", "p.shard", "p.number", "copies")
            .mapInArrow(
                _with_bucket(buckets), "key long, shard long, number long, copies long, bucket long"
            )
        )
        by_key.groupBy("bucket").applyInArrow(_write_index(folder), "bucket long, keys long").agg(
            F.sum("keys")
        ).collect()
    encoder = opened(tokenizer)
    spark.createDataFrame(
        manifest, "shard long, first long, start long, docs long, ids long"
    ).coalesce(1).write.parquet(f"{folder}/manifest.parquet")
    return TokenStore(spark, folder, encoder.dtype.itemsize, buckets, first - keyed, manifest)


def _with_bucket(buckets: int, only_key: bool = False):
    def kernel(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            bucket = bucket_of(batch["key"].to_numpy(), buckets)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bucket)], names=[*batch.schema.names, "bucket"]
            )

    return kernel


def _find(folder: str):
    """Places of keys; rows come sorted by bucket, so each index file is opened once a task."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, index = -1, None
        for batch in batches:
            buckets, keys = batch["bucket"].to_numpy(), batch["key"].to_numpy()
            cuts = np.flatnonzero(np.diff(buckets)) + 1
            for part in np.split(np.arange(len(keys)), cuts):
                if not len(part):
                    continue
                if buckets[part[0]] != held:
                    held = int(buckets[part[0]])
                    index = open_index(folder, held)
                if index is None:
                    continue
                shard, number, copies = index.find(keys[part])
                hit = copies > 0
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": pa.array(keys[part][hit]),
                        "shard": pa.array(shard[hit]),
                        "number": pa.array(number[hit]),
                        "copies": pa.array(copies[hit]),
                    }
                )

    return kernel


def _read(folder: str, width: int):
    """Ids of places; rows come sorted by shard and number, so each shard is opened once a task."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held, offsets, system, base = -1, None, *_opened(folder)
        payload = None
        for batch in batches:
            shards, numbers = batch["shard"].to_numpy(), batch["number"].to_numpy()
            start = np.zeros(len(shards), np.int64)
            size = np.zeros(len(shards), np.int64)
            crc = np.zeros(len(shards), np.int64)
            for i, (shard, number) in enumerate(zip(shards.tolist(), numbers.tolist())):
                if shard != held:
                    held = shard
                    offsets = np.frombuffer(get(folder, f"shard-{shard:05d}.off"), "<i8")
                    if payload is not None:
                        payload.close()
                    payload = system.open_input_file(f"{base}/shard-{shard:05d}.ids")
                a, b = int(offsets[number]), int(offsets[number + 1])
                payload.seek(a * width)
                ids = np.frombuffer(payload.read((b - a) * width), f"<u{width}")
                start[i], size[i], crc[i] = a, len(ids), crc_of(ids)
            yield pa.RecordBatch.from_pydict(
                {
                    "key": batch["key"],
                    "shard": batch["shard"],
                    "at": pa.array(start),
                    "n_tokens": pa.array(size),
                    "ids_crc32": pa.array(crc),
                }
            )
        if payload is not None:
            payload.close()

    return kernel


def _shard_of(shards: list[tuple[int, int, int]]):
    """Shard and place there of documents numbered through the store, from (shard, first, documents)."""

    def kernel(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        held = sorted((first, shard) for shard, first, docs in shards if docs)
        firsts, numbers = (np.array(c, np.int64) for c in zip(*held)) if held else (np.zeros(1, np.int64),) * 2
        for batch in batches:
            doc = batch["doc"].to_numpy(zero_copy_only=False)
            place = np.searchsorted(firsts, doc, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch["key"], pa.array(numbers[place]), pa.array(doc - firsts[place])], ["key", "shard", "number"]
            )

    return kernel


def read_digests(store: TokenStore, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """Look every key of ``keys`` up in the index and read its ids back from the shards.

    One row per stored document with such a key: key, start (ids of all
    documents before it), n_tokens, ids_crc32, shard. A missing key finds the
    documents stored without one.
    """
    spark = store.spark
    starts = spark.createDataFrame(
        [(r[0], r[1], r[2], r[3]) for r in store.manifest], "shard long, first long, start long, docs long"
    )  # one row per shard
    wanted = keys.select(F.col(key).cast("long").alias("key")).distinct()
    n_parts = max(1, len(store.manifest))
    place = "key long, shard long, number long, copies long"
    found = spark.createDataFrame([], place)
    if store.buckets:
        found = (
            wanted.filter(F.col("key").isNotNull())
            .mapInArrow(_with_bucket(store.buckets), "key long, bucket long")
            .repartition(min(store.buckets, n_parts), "bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_find(store.folder), place)
        )
    if store.null_keys:
        # documents without a key are the first ones of the store
        missing = wanted.filter(F.col("key").isNull()).select(
            F.col("key"),
            F.lit(store.manifest[0][0]).cast("long").alias("shard"),
            F.lit(0).cast("long").alias("number"),
            F.lit(store.null_keys).cast("long").alias("copies"),
        )
        found = found.unionByName(missing)
    # number all documents of the store through; a key's documents may go on in the next shards
    first = found.join(F.broadcast(starts.select("shard", "first")), "shard").select(
        "key", F.explode(F.sequence(F.col("first") + F.col("number"), F.col("first") + F.col("number") + F.col("copies") - 1)).alias("doc")
    )
    at = first.mapInArrow(_shard_of([(r[0], r[1], r[3]) for r in store.manifest]), "key long, shard long, number long")
    read = (
        at.repartitionByRange(n_parts, "shard", "number")
        .sortWithinPartitions("shard", "number")
        .mapInArrow(_read(store.folder, store.width), "key long, shard long, at long, n_tokens long, ids_crc32 long")
    )
    return read.join(F.broadcast(starts.select("shard", F.col("start").alias("_before"))), "shard").select(
        F.col("key").alias(key), (F.col("_before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "shard"
    )
