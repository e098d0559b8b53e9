"""Histogram boosting against plain trees, over partitions, outputs and both ways of summing."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import boosting as B
from tabwright.operators.models import FeatureTable, build_model


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(11)
    x = np.c_[rng.integers(0, 12, 900), rng.normal(0, 1, 900).round(1), rng.integers(0, 3, 900), np.ones(900)].astype(float)
    wave = np.sin(x[:, 0]) + x[:, 1] * (x[:, 2] - 1)
    y = (wave + rng.normal(0, 0.4, 900) > 0.2).astype(float)
    return x, y, wave


def frame(spark, x, y, parts=3):
    rows = [(list(map(float, a)), float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, y double").repartition(parts)


def plain_tree(x, g, h, plan):
    """Best first, one leaf at a time, every cut tried: {leaf rows: value} and the gains in order of the splits."""
    def best(rows):
        found = (0.0, None)
        for j in range(x.shape[1]):
            for cut in np.unique(x[:, j])[:-1]:
                left = rows & (x[:, j] <= cut)
                right = rows & ~(x[:, j] <= cut)
                sums = [(g[r].sum(), h[r].sum(), r.sum()) for r in (left, right, rows)]
                if min(sums[0][2], sums[1][2]) < plan.min_rows or min(sums[0][1], sums[1][1]) < plan.min_curvature:
                    continue
                a, b, c = [s[0] ** 2 / (s[1] + plan.l2) for s in sums]
                gain = 0.5 * (a + b - c) - plan.min_gain
                if gain > found[0] + 1e-9:
                    found = (gain, (left, right))
        return found

    everything = np.ones(len(x), bool)
    leaves, gains = [(everything, 0, *best(everything))], []
    while len(leaves) < (plan.num_leaves or 10**9):
        open_leaves = [i for i, (_, d, gain, _) in enumerate(leaves) if gain > 0 and d < (plan.max_depth or 10**9)]
        if not open_leaves:
            break
        rows, depth, gain, halves = leaves.pop(max(open_leaves, key=lambda i: leaves[i][2]))
        gains.append(gain)
        leaves += [(half, depth + 1, *best(half)) for half in halves]
    value = np.zeros(len(x))
    for rows, *_ in leaves:
        value[rows] = -g[rows].sum() / (h[rows].sum() + plan.l2)
    return value, gains


@pytest.mark.parametrize("leaves, depth", [(0, 3), (7, 0), (12, 4)])
def test_a_tree_equals_plain_growth(spark, points, leaves, depth):
    x, y, _ = points
    plan = B.BoostPlan(rounds=1, num_leaves=leaves, max_depth=depth, prior=False, min_rows=5, min_gain=0.05)
    held = B.boost(frame(spark, x, y), plan)["trees"][0][0]
    tree = B.Tree(**held)
    value, gains = plain_tree(x, 0.5 - y, np.full(len(y), 0.25), plan)
    assert np.allclose(np.array(tree.value)[tree.places(x)], value, atol=1e-8)
    assert np.allclose(sorted(g for g in tree.gain if g), sorted(gains), atol=1e-6)
    if leaves:
        assert sum(f < 0 for f in tree.feature) <= leaves


@pytest.mark.parametrize("objective, outputs", [("binary", 1), ("softmax", 3), ("squared", 1)])
def test_fits_do_not_depend_on_partitions_or_on_where_sums_are(spark, points, monkeypatch, objective, outputs):
    x, y, wave = points
    y = {"binary": y, "softmax": np.digitize(wave, [-0.5, 0.6]).astype(float), "squared": wave * 1000}[objective]
    plan = B.BoostPlan(objective, outputs, rounds=3, num_leaves=9, subsample=0.7, column_share=0.75, seed=5)
    first = B.boost(frame(spark, x, y, 2), plan)
    assert B.boost(frame(spark, x, y, 7), plan) == first
    monkeypatch.setattr(B, "NEAR_BYTES", 0)
    monkeypatch.setattr(B, "STRETCH", 2)
    monkeypatch.setattr(B, "HISTOGRAM_BYTES", 4_000)
    far = B.boost(frame(spark, x, y, 4), plan)
    assert far["start"] == first["start"]
    for a, b in zip([t for r in far["trees"] for t in r], [t for r in first["trees"] for t in r]):
        assert a["feature"] == b["feature"] and a["cut"] == b["cut"] and np.allclose(a["value"], b["value"], rtol=1e-6)


def log_loss(spark, x, y, plan):
    held = B.boost(frame(spark, x, y), plan)
    scores = np.tile(held["start"], (len(x), 1)).astype(float)
    for turn in held["trees"]:
        for k, t in enumerate(turn):
            tree = B.Tree(**t)
            scores[:, k] += held["learning_rate"] * np.array(tree.value)[tree.places(x)]
    p = B.probabilities(scores, plan.objective)
    return -np.mean(np.log(p[np.arange(len(y)), y.astype(int)]))


def test_second_order_beats_first_order_at_equal_trees(spark, points):
    x, y, wave = points
    rare = (wave > 1.4).astype(float)  # few rows carry the curvature
    common = dict(rounds=6, max_depth=3, learning_rate=0.3, l2=0.0, min_curvature=1e-3)
    second = log_loss(spark, x, rare, B.BoostPlan(**common))
    first = log_loss(spark, x, rare, B.BoostPlan(**common, second_order=False))
    assert second < first


def test_more_rounds_fit_better_and_probabilities_sum_to_one(spark, points, folder):
    x, _, wave = points
    y = np.digitize(wave, [-0.5, 0.6]).astype(float)
    losses = [log_loss(spark, x, y, B.BoostPlan("softmax", 3, rounds=n, max_depth=3, learning_rate=0.3)) for n in (1, 4, 10)]
    assert losses[0] > losses[1] > losses[2] and losses[2] < 0.6 * math.log(3)
    rows = frame(spark, x, y).select(array_to_vector("x").alias("features"), F.col("y").alias("label"))
    description = FeatureTable(tuple("abcd"), len(y), 3)
    fitted = build_model("gradient_boosting", {"n_estimators": 4, "max_depth": 3}, "classification", description).estimator.fit(rows)
    scored = fitted.transform(rows)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, p: a + p)
    assert scored.filter(F.abs(total - 1) > 1e-12).count() == 0
    assert scored.filter("prediction = label").count() > np.bincount(y.astype(int)).max() + 100  # well above the majority
    PipelineModel([fitted]).write().save(f"{folder}/boosted")
    again = PipelineModel.load(f"{folder}/boosted").transform(rows)
    assert sorted(again.select("probability", "label").collect(), key=str) == sorted(scored.select("probability", "label").collect(), key=str)


def test_odd_tables(spark):
    nan = float("nan")
    rows = [([nan, 1.0], 1.0), ([0.0, 1.0], 0.0), ([1.0, 1.0], 0.0), ([nan, 1.0], 1.0)] * 10
    df = spark.createDataFrame(rows, "x array<double>, y double")
    t = B.boost(df, B.BoostPlan(rounds=1, max_depth=2))["trees"][0][0]
    assert t["feature"][0] == 0  # missing values are the last bin
    tree = B.Tree(**t)
    values = np.array(tree.value)[tree.places(np.array([r[0] for r in rows]))]
    assert (values > 0).tolist() == [y == 1.0 for _, y in rows]
    one = B.boost(df.withColumn("y", F.lit(1.0)), B.BoostPlan(rounds=2))
    assert all(t["feature"] == [-1] for turn in one["trees"] for t in turn)
    with pytest.raises(ValueError, match="no rows"):
        B.boost(df.limit(0), B.BoostPlan())
    many = spark.range(3000).select(F.array(F.col("id").cast("double")).alias("x"), (F.col("id") >= 1500).cast("double").alias("y"))
    t = B.boost(many, B.BoostPlan(rounds=1, max_depth=1))["trees"][0][0]
    assert abs(t["cut"][0] - 1500) < 15  # more values than bins


@pytest.mark.parametrize("objective, outputs", [("binary", 1), ("softmax", 3), ("squared", 1)])
def test_equal_rows_travel_as_one(spark, monkeypatch, objective, outputs):
    """Rows many times over give the very model they give one by one, sampled rounds included."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 6, (40, 2)).astype(float)
    y = rng.integers(0, 2 if objective == "binary" else 3, 40).astype(float) * (1.7 if objective == "squared" else 1)
    times = rng.integers(5, 40, 40)
    df = frame(spark, np.repeat(x, times, axis=0), np.repeat(y, times))
    plan = B.BoostPlan(objective=objective, outputs=outputs, rounds=10, max_depth=4, subsample=0.8, min_rows=3)
    seen = []
    binned = B.binned
    monkeypatch.setattr(B, "binned", lambda *a: seen.append(binned(*a)) or seen[-1])
    short = B.boost(df, plan)
    monkeypatch.setattr(B, "REPEATS", 10**9)
    whole = B.boost(df, plan)
    assert [t.count() for t in seen] == [len(np.unique(np.c_[x, y], axis=0)), times.sum()]
    assert short == whole
