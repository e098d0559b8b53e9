"""Order statistics and ranks without a single-task window.

Spark's exact percentile keeps every distinct value of a column in one buffer,
and ``row_number`` over an unpartitioned window moves all rows into one task.
The operators here keep both spread out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.functions.schema import quoted
from tabwright.session import written

ACCURACY = 10_000
BRACKET_LIMIT = 200_000  # values of one bracket that may be fetched
TOTAL_LIMIT = 2_000_000  # values of all brackets of a call
NARROWED_AT_ONCE = 32  # brackets in one aggregate
MAX_SCANS = 40
SMALLEST_LIMIT = 64  # a sketch cannot narrow a bracket much below this
HOT_SHARE = 1_000
BLOCK = 50_000  # ranks of one window


@dataclass
class _Search:
    """Bracket [low, high] that holds the values at ranks first..last (0-based)."""

    column: str
    prob: float
    first: int
    last: int
    weight: float
    low: float = -math.inf
    high: float = math.inf
    value: float | None = None

    def resolve(self, ordered: Sequence[tuple[float | None, int]]) -> bool:
        """Read both ranks off (value, count) pairs in order; a pair without value is a gap."""
        found, rank = {}, 0
        for value, n in ordered:
            for wanted in (self.first, self.last):
                if rank <= wanted < rank + n and value is not None:
                    found[wanted] = value
            rank += n
        if self.first not in found or self.last not in found:
            return False
        a, b = found[self.first], found[self.last]
        self.value = a if a == b else a + (b - a) * self.weight
        return True


def _double(name: str) -> Column:
    c = F.col(quoted(name)).cast("double")
    return F.when(~F.isnan(c), c)


def _start(df: DataFrame, columns, probs, interpolate, accuracy) -> tuple[list[_Search], dict[str, int]]:
    eps = 2.0 / accuracy
    marks = [q for p in probs for q in (max(0.0, p - eps), min(1.0, p + eps))]
    row = df.agg(
        *[
            F.struct(F.count(_double(c)), F.percentile_approx(_double(c), marks, accuracy)).alias(f"q{i}")
            for i, c in enumerate(columns)
        ]
    ).first()
    searches, counts = [], {}
    for i, c in enumerate(columns):
        n, cuts = row[f"q{i}"]
        counts[c] = n
        for j, p in enumerate(probs):
            if n == 0:
                continue
            at = (n - 1) * p if interpolate else max(math.ceil(n * p) - 1, 0)
            searches.append(
                _Search(c, p, math.floor(at), math.ceil(at), at - math.floor(at), cuts[2 * j], cuts[2 * j + 1])
            )
    return searches, counts


def _read_brackets(df: DataFrame, searches: list[_Search]) -> None:
    """Per column, count the distinct values inside the brackets, and the rows of each gap between them."""
    by_column: dict[str, list[_Search]] = {}
    for s in searches:
        by_column.setdefault(s.column, []).append(s)
    parts = []
    for i, (name, group) in enumerate(by_column.items()):
        spans: list[list[float]] = []
        for s in sorted(group, key=lambda s: s.low):
            if spans and s.low <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], s.high)
            else:
                spans.append([s.low, s.high])
        v, passed, inside = F.col("v"), F.lit(0), F.lit(False)
        for low, high in spans:
            passed = passed + (v > high).cast("int")
            inside = inside | v.between(low, high)
        parts.append(
            df.select(_double(name).alias("v"))
            .filter(v.isNotNull())
            .groupBy(passed.alias("gap"), F.when(inside, v).alias("v"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(i).alias("i"), "gap", "v", "n")
        )
    ordered: dict[int, list] = {}
    for r in reduce(DataFrame.unionByName, parts).collect():  # at most BRACKET_LIMIT values a bracket
        ordered.setdefault(r["i"], []).append((r["gap"], r["v"] is not None, r["v"] or 0.0, r["n"]))
    for i, group in enumerate(by_column.values()):
        pairs = [(v if known else None, n) for _, known, v, n in sorted(ordered.get(i, []))]
        for s in group:
            if not s.resolve(pairs):
                s.low, s.high = -math.inf, math.inf


def _narrow(df: DataFrame, searches: list[_Search], accuracy: int, limit: int) -> list[tuple[_Search, int]]:
    """One scan: how many values lie strictly inside each bracket, and tighter cuts there."""
    grid = [k / 64 for k in range(65)]
    figures = []
    for i, s in enumerate(searches):
        c = _double(s.column)
        within = F.when((c > s.low) & (c < s.high), c)
        figures.append(
            F.struct(
                F.count_if(c < s.low).alias("below"),
                F.count_if(c == s.low).alias("at_low"),
                F.count(within).alias("inside"),
                F.count_if(c == s.high).alias("at_high"),
                F.percentile_approx(within, grid, accuracy).alias("cuts"),
            ).alias(f"b{i}")
        )
    row = df.agg(*figures).first()
    out = []
    for i, s in enumerate(searches):
        b = row[f"b{i}"]
        edges = [(s.low, b["at_low"]), (s.high, b["at_high"])]
        start = b["below"] + b["at_low"]
        if s.first < b["below"] or s.last >= start + b["inside"] + b["at_high"]:
            s.low, s.high = -math.inf, math.inf
            out.append((s, limit + 1))
        elif s.last < start:
            s.value = s.low
        elif s.first >= start + b["inside"]:
            s.value = s.high
        else:
            size = b["inside"] + sum(1 for _, n in edges if n)
            before = (s.low, s.high)
            if size > limit:
                slack = 2 * b["inside"] / accuracy + 1
                low_at = math.floor(64 * (s.first - start - slack) / b["inside"]) - 1
                high_at = math.ceil(64 * (s.last - start + slack) / b["inside"]) + 1
                if low_at >= 0:
                    s.low = b["cuts"][low_at]
                if high_at <= 64:
                    s.high = b["cuts"][high_at]
                # cuts that cannot split the bracket leave few values in it
                size = 0 if (s.low, s.high) == before else size
            out.append((s, size))
    return out


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    interpolate: bool = True,
    accuracy: int = ACCURACY,
    bracket_limit: int = BRACKET_LIMIT,
) -> tuple[dict[tuple[str, float], float | None], dict[str, int]]:
    """Exact quantiles of numeric columns, and their counts without missing values.

    A sketch brackets each quantile, a scan counts what lies below, and the
    values left in the bracket decide. Brackets still too wide are narrowed by
    further scans, so no task or driver holds more than ``bracket_limit`` values
    per quantile, nor ``TOTAL_LIMIT`` in all. ``interpolate`` takes the midpoint rule of the median;
    otherwise the value at rank ceil(n*p) is returned.
    """
    wanted = max(1, len(columns) * len(probs))
    bracket_limit = max(min(bracket_limit, TOTAL_LIMIT // wanted), SMALLEST_LIMIT)
    searches, counts = _start(df, columns, probs, interpolate, accuracy)
    pending = searches
    # A bracket spans about 6/accuracy of the rows, by the bound of the sketch.
    small = [s for s in pending if counts[s.column] * 6 <= bracket_limit * accuracy]
    if small:
        _read_brackets(df, small)
    pending = [s for s in pending if s.value is None]
    for _ in range(MAX_SCANS):
        if not pending:
            break
        batches = [pending[i : i + NARROWED_AT_ONCE] for i in range(0, len(pending), NARROWED_AT_ONCE)]
        sized = [found for batch in batches for found in _narrow(df, batch, accuracy, bracket_limit)]
        ready = [s for s, size in sized if size <= bracket_limit and s.value is None]
        if ready:
            _read_brackets(df, ready)
        pending = [s for s in pending if s.value is None]
    if pending:
        raise RuntimeError("the rows changed between scans: quantiles cannot be settled")
    result: dict[tuple[str, float], float | None] = {(c, p): None for c in columns for p in probs}
    result.update({(s.column, s.prob): s.value for s in searches})
    return result, counts


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number all rows 1..n in ``order``, which must place every row uniquely.

    Rows are range-partitioned on the whole ordering (a hot leading value is
    split by the columns after it), sorted in place, and written once so the
    partition numbers stay fixed; a partition's offset is the size of those
    before it.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = written(placed, "rank")
    part = F.shiftright("_place", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for r in sorted(sizes, key=lambda r: r["_part"]):  # one row per partition
        offsets.append((r["_part"], total))
        total += r["n"]
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    within = F.col("_place") - F.shiftleft(part, 33)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + within + 1)
        .drop("_part", "_place", "_start")
    )


def hot_key_join(big: DataFrame, small: DataFrame, key: str, weight: str, how: str = "inner") -> DataFrame:
    """Join ``big`` to a table with one row per key, split by how many rows a key has.

    ``weight`` is the column of ``small`` that tells how many rows of ``big``
    hold the key. Keys above a thousandth of all rows number fewer than a
    thousand, so they are broadcast; the rest is joined by a plain shuffle.
    Keys are not null.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    hot = small.filter(F.col(weight) * HOT_SHARE > total)
    hot_keys = [r[0] for r in hot.select(key).collect()]
    if not hot_keys:
        return big.join(small.drop(weight), key, how)
    in_hot = F.col(key).isin(hot_keys)
    return (
        big.filter(in_hot)
        .join(F.broadcast(hot.drop(weight)), key, how)
        .unionByName(
            big.filter(~in_hot | F.col(key).isNull()).join(small.filter(~in_hot).drop(weight), key, how)
        )
    )


def group_rank(df: DataFrame, key: str, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Number rows 1..k within each key; a key may hold any share of the rows."""
    ranked = global_rank(df, [F.col(key), *order], "_rank")
    starts = ranked.groupBy(key).agg(F.min("_rank").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return (
        hot_key_join(ranked, starts, key, "_n")
        .withColumn(name, F.col("_rank") - F.col("_first") + 1)
        .drop("_rank", "_first")
    )


def running_total(df: DataFrame, order: Sequence[Column], weight: str, name: str = "running") -> DataFrame:
    """Sum of the whole-number ``weight`` over each row and all rows before it in ``order``.

    Rows are placed as in ``global_rank``: a partition adds up its own rows and
    starts from the sum of those before it.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("_place", F.monotonically_increasing_id()), "running")
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    sums = placed.groupBy("_part").agg(F.sum(weight).alias("n")).collect()
    offsets, total = [], 0
    for r in sorted(sums, key=lambda r: r["_part"]):  # one row per partition
        offsets.append((r["_part"], total))
        total += r["n"] or 0
    starts = df.sparkSession.createDataFrame(offsets, "_part long, _start long")
    before = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        placed.withColumn("_own", F.coalesce(F.sum(weight).over(before), F.lit(0)))
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + F.col("_own"))
        .drop("_part", "_place", "_own", "_start")
    )


def neighbouring(ranked: DataFrame, rank: str, k: int, columns: Sequence[str], name: str) -> DataFrame:
    """The ``columns`` of up to ``k`` rows before and after each row, and of itself, as an array.

    ``rank`` numbers the rows from 1. Rows meet in blocks of ``BLOCK`` ranks, and
    those within ``k`` of an edge are copied to the block behind it, so no window
    holds more than a block.
    """
    block = max(BLOCK, k)

    def of(shift: int) -> Column:
        return F.floor((F.col(rank) - 1 + shift) / block)

    around = Window.partitionBy("_block").orderBy(rank).rowsBetween(-k, k)
    return (
        ranked.withColumn("_block", F.explode(F.array_distinct(F.array(of(-k), of(0), of(k)))))
        .withColumn(name, F.collect_list(F.struct(*columns)).over(around))
        .filter(F.col("_block") == of(0))
        .drop("_block")
    )
