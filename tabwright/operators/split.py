"""Repeatable train/test split by a digest of the row key.

A row's side depends on its key and the seed alone, not on partitioning, task
retries or row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import quoted
from tabwright.operators.order import exact_quantiles

DIGITS = 13  # 52 bits: exact in a double


def row_digest(keys: Sequence[str], seed: int) -> Column:
    """Hex digest of the key columns and the seed, 13 digits, ordered as its number."""
    parts = [F.coalesce(F.col(quoted(k)).cast("string"), F.lit("")) for k in keys]
    return F.substring(F.md5(F.concat_ws("|", *parts, F.lit(str(seed)))), 1, DIGITS)


def hash_split(
    df: DataFrame,
    keys: Sequence[str],
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = False,
    output: str = "is_test",
) -> DataFrame:
    """Add a boolean column telling the test rows.

    The test share is close to ``test_size``; ``exact=True`` takes the rows
    with the ceil(n * test_size) smallest digests, for unique keys.
    """
    if test_size <= 0.0 or test_size >= 1.0:
        return df.withColumn(output, F.lit(test_size >= 1.0))
    digest = row_digest(keys, seed)
    if not exact:
        limit = format(round(test_size * 16**DIGITS), f"0{DIGITS}x")
        return df.withColumn(output, digest < F.lit(limit))
    number = F.conv(digest, 16, 10).cast("double").alias("h")
    cut, _ = exact_quantiles(df.select(number), ["h"], [test_size], interpolate=False)
    value = cut[("h", test_size)]
    if value is None:
        return df.withColumn(output, F.lit(False))
    return df.withColumn(output, digest <= F.lit(format(int(value), f"0{DIGITS}x")))


def train_test_split(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42, exact: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of :func:`hash_split`."""
    marked = hash_split(df, keys, test_size, seed, exact, "_is_test")
    return marked.filter(~F.col("_is_test")).drop("_is_test"), marked.filter("_is_test").drop("_is_test")
