"""Exact quantiles and distributed ranks against plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.operators.order import exact_quantiles, global_rank, group_rank


@pytest.mark.parametrize("limit", [200_000, 64])
@pytest.mark.parametrize("accuracy", [10_000, 50])
def test_quantiles(spark, limit, accuracy):
    rng = random.Random(7)
    rows = [
        (
            rng.random() * 1000,
            float(rng.randrange(5)),
            1.0 if rng.random() < 0.4 else rng.random() * 2,  # one value holds over a third
            None if rng.random() < 0.3 else float("nan") if rng.random() < 0.1 else rng.gauss(0, 1),
        )
        for _ in range(3001)
    ]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    probs = [0.1, 0.5, 0.9]
    got, counts = exact_quantiles(df, df.columns, probs, accuracy=accuracy, bracket_limit=limit)
    for i, c in enumerate(df.columns):
        values = [r[i] for r in rows if r[i] is not None and r[i] == r[i]]
        assert counts[c] == len(values)
        for p in probs:
            assert got[(c, p)] == pytest.approx(float(np.quantile(values, p)), abs=1e-12)
    low, _ = exact_quantiles(df, ["a"], [0.25], False, accuracy, limit)
    assert low[("a", 0.25)] == sorted(r[0] for r in rows)[int(np.ceil(3001 * 0.25)) - 1]


def test_quantiles_of_nothing(spark):
    got, counts = exact_quantiles(spark.createDataFrame([(None,)], "a double"), ["a"], [0.5])
    assert got == {("a", 0.5): None} and counts == {"a": 0}


def test_median_is_the_midpoint(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "a double")
    assert exact_quantiles(df, ["a"], [0.5])[0][("a", 0.5)] == 2.5


def test_global_rank(spark):
    df = spark.range(5000).select("id", F.pmod(F.hash("id"), F.lit(7)).alias("v"))
    got = global_rank(df, [F.col("v").desc(), F.col("id")]).collect()
    order = sorted(got, key=lambda r: (-r["v"], r["id"]))
    assert [r["rank"] for r in order] == list(range(1, 5001))


def test_group_rank_with_a_hot_key(spark):
    key = F.when(F.col("id") % 3 != 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 4000))
    df = spark.range(6000).select("id", key.alias("key"))
    got = group_rank(df, "key", [F.col("id")], "r").collect()
    assert len(got) == 6000
    seen = {}
    for r in sorted(got, key=lambda r: (r["key"], r["id"])):
        seen[r["key"]] = seen.get(r["key"], 0) + 1
        assert r["r"] == seen[r["key"]]
    assert seen["hot"] == 4000
