"""Exact duplicates through an extendible-hash index, in DataFrame operations only.

Every distinct text is an entry of the index: 64-bit hash, chain number, the key
that stays, how many rows hold the text, and its SHA-256. Entries sit in buckets
named by the leading bits of the hash. The directory starts with one bucket and
doubles while a bucket holds more than ``capacity`` entries; only overfull
buckets split, so each has a depth of its own. Owner tasks each write the sorted
entries of a range of buckets to the shared folder, and every row then finds its
entry there.

Texts that share a hash are told apart by their bytes: entries are grouped by
the text itself, so they become chained entries of one hash, and rows with such
a hash are matched by text. Copies collapse in the map-side aggregate, before
the shuffle, whatever share of the rows they hold; entries held by more than a
thousandth of the rows (fewer than a thousand) are broadcast to the probe.

Decisions: a missing text equals an empty one; the largest key stays, a missing
key only if no other row has the text; rows that repeat key and text are one row
to this operator and all marked alike (``distinct_rows`` keeps one of them); an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm.common import text_of
from tabwright.operators.order import hot_key_join
from tabwright.session import fresh_path, written

CAPACITY = 50_000  # entries of a bucket
HASH_BITS = 64
MAX_DIRECTORY = 1 << 16  # buckets; beyond that the capacity grows with the table


def _leading(h: Column, bits: int, depth: int) -> Column:
    """The first ``depth`` of ``bits`` bits."""
    return F.lit(0).cast("long") if depth == 0 else F.shiftrightunsigned(h, bits - depth)


def directory(entries: DataFrame, bits: int, capacity: int) -> list[tuple[int, int, int]]:
    """Buckets as (leading bits, depth, entries), grown by splitting the overfull ones.

    A bucket is a bounded share of the table, so the driver holds a row per
    ``capacity`` entries. Buckets whose entries share all bits stay overfull:
    they are one chain.
    """
    total = entries.count()
    capacity = max(capacity, total // MAX_DIRECTORY * 4, 1)
    settled, overfull, depth = [], [(0, total)] if total else [], 0
    while overfull:
        settled += [(p, depth, n) for p, n in overfull if n <= capacity or depth == bits]
        split = [p for p, n in overfull if n > capacity and depth < bits]
        if not split:
            break
        parent = _leading(F.col("h"), bits, depth)
        halves = entries.filter(parent.isin(split)) if depth else entries
        depth += 1
        overfull = [
            (r["p"], r["n"])
            for r in halves.groupBy(_leading(F.col("h"), bits, depth).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()
        ]  # two rows per overfull bucket
    return settled


def _hash(text: Column, bits: int) -> Column:
    h = F.xxhash64(text)
    return h if bits == 64 else F.shiftrightunsigned(h, 64 - bits)


def build_index(rows: DataFrame, bits: int = HASH_BITS, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Write the index of ``rows`` (key, text) to the shared folder and open it."""
    spark = rows.sparkSession
    texts = rows.groupBy(_hash(F.col("text"), bits).alias("h"), "text").agg(
        F.max("key").alias("keep"), F.count(F.lit(1)).alias("size")
    )
    entries = written(
        texts.select("h", F.sha2("text", 256).alias("sha"), "keep", "size").withColumn(
            "chain", F.row_number().over(Window.partitionBy("h").orderBy("sha")) - 1
        ),
        "dedup-entries",
    )
    buckets = directory(entries, bits, capacity)
    depths = sorted({d for _, d, _ in buckets})
    bucket = F.coalesce(
        *[
            F.when(_leading(F.col("h"), bits, d).isin([p for p, e, _ in buckets if e == d]), F.shiftleft(_leading(F.col("h"), bits, d), 7) + d)
            for d in depths
        ],
        F.lit(0).cast("long"),
    )
    path = path or fresh_path(spark, "dedup-index")
    (
        entries.withColumn("bucket", bucket)
        .repartitionByRange(max(1, len(buckets)), "bucket", "h")
        .sortWithinPartitions("bucket", "h", "chain")
        .write.parquet(path)
    )
    return spark.read.parquet(path)


def duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    bits: int = HASH_BITS,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256."""
    rows = docs.select(F.col(key).alias("key"), text_of(text).alias("text"))
    index = build_index(rows, bits, capacity)
    chained = index.filter(F.col("chain") > 0).select("h").distinct()
    entry = ["h", "keep", "size", "sha"]
    hashed = rows.withColumn("h", _hash(F.col("text"), bits))
    if chained.isEmpty():
        single = index.select(*entry)
        found = hot_key_join(hashed.select("key", "h"), single.withColumn("_n", F.col("size")), "h", "_n")
    else:
        single = index.join(chained, "h", "left_anti").select(*entry)
        one = hot_key_join(hashed.select("key", "h"), single.withColumn("_n", F.col("size")), "h", "_n")
        shared = hashed.join(chained, "h", "left_semi")
        texts = shared.groupBy("text").agg(F.max("key").alias("keep"), F.count(F.lit(1)).alias("size"))
        texts = texts.withColumn("sha", F.sha2("text", 256))
        found = one.select("key", "keep", "size", "sha").unionByName(
            shared.join(texts, "text").select("key", "keep", "size", "sha")
        )
    return found.select(
        F.col("key").alias(key),
        F.col("keep").alias("keep_id"),
        F.col("size").alias("group_size"),
        F.col("key").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def distinct_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: one of each text, with all columns."""
    marked = docs.withColumn("_llm_sha", F.sha2(text_of(text), 256))
    kept = written(
        duplicates(docs, key, text)
        .filter("kept")
        .groupBy(F.col(key).alias("_llm_key"), F.col("text_sha256").alias("_llm_kept"))
        .agg(F.count(F.lit(1)).alias("_llm_n")),
        "dedup-kept",
    )
    same = F.col(key).eqNullSafe(F.col("_llm_key")) & (F.col("_llm_sha") == F.col("_llm_kept"))
    stay = marked.join(kept.filter("_llm_n = 1"), same, "left_semi")
    again = kept.filter("_llm_n > 1")
    if not again.isEmpty():
        stay = stay.unionByName(marked.join(again, same, "left_semi").dropDuplicates(["_llm_sha"]))
    return stay.drop("_llm_sha")
