"""Regression trees on rows of equal bins against MLlib on the rows themselves."""

import json

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabwright.operators import binned as E
from tabwright.operators.models import FeatureTable, build_model


@pytest.fixture(scope="module")
def noisy(spark):
    rng = np.random.default_rng(8)
    x = np.c_[rng.integers(0, 12, 4000), rng.integers(0, 2, 4000), rng.integers(-2, 3, 4000) * 0.25]
    y = np.sin(x[:, 0]) + x[:, 1] * x[:, 2] + rng.normal(0, 1, 4000)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double")
    return x, y, df.select(array_to_vector("x").alias("features"), "label")


def fitted(df, family, **params):
    return build_model(family, params, "regression", FeatureTable(("a", "b", "c"), 4000, 0)).estimator.fit(df)


def answers(model, df):
    return np.array([r["prediction"] for r in model.transform(df).select("prediction").collect()])


def test_boosting_on_equal_bins_gives_the_trees_of_all_rows(spark, noisy, monkeypatch, folder):
    x, _, df = noisy
    rows = fitted(df, "gradient_boosting", n_estimators=6, max_depth=3)
    seen = {}
    monkeypatch.setattr(E, "written", lambda rows, name: seen.setdefault(name, rows))
    monkeypatch.setattr(E, "PART_ROWS", 100)
    bins = fitted(df, "gradient_boosting", n_estimators=6, max_depth=3)
    assert seen["equal-bins"].count() == len(np.unique(x, axis=0)) < 200  # no label repeats
    assert np.allclose(answers(rows, df), answers(bins, df), atol=1e-9)
    bins.write().save(folder)
    assert np.array_equal(answers(PipelineModel.load(folder), df), answers(bins, df))


def test_forest_parts_hold_all_rows_and_split_hot_ones(spark, noisy, monkeypatch):
    x, y, df = noisy
    seen = {}
    monkeypatch.setattr(E, "written", lambda rows, name: seen.setdefault(name, rows.cache()))
    monkeypatch.setattr(E, "PART_ROWS", 1000)
    monkeypatch.setattr(E, "HOT", 100)
    skewed = df.unionAll(df.filter("label > 2").limit(1).crossJoin(spark.range(4000)).drop("id"))
    fitted(skewed, "random_forest", n_estimators=3, max_depth=4)
    parts = seen["equal-bins"].select(F.sum("rows"), F.sum(F.col("y") * F.col("rows")), F.max("rows"), F.count("rows")).first()
    assert parts[0] == 8000 and np.isclose(parts[1], skewed.agg(F.sum("label")).first()[0])
    assert parts[2] < 100 and 500 < parts[3] <= 2200


def test_forest_on_parts_answers_like_one_on_rows(noisy, monkeypatch):
    _, _, df = noisy
    rows = answers(fitted(df, "random_forest", n_estimators=40, max_depth=5), df)
    monkeypatch.setattr(E, "PART_ROWS", 1000)
    parts = answers(fitted(df, "random_forest", n_estimators=40, max_depth=5), df)
    assert not np.array_equal(rows, parts) and np.abs(rows - parts).mean() < 0.1 * rows.std()


def test_tables_that_hardly_repeat_go_to_the_learner(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(rng.normal(size=3).tolist(), float(i % 7)) for i in range(600)]
    df = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    monkeypatch.setattr(E, "PART_ROWS", 100)
    assert not isinstance(fitted(df, "random_forest", n_estimators=2, max_depth=2), PipelineModel)


def test_cuts_are_mllibs(spark):
    """A tree of MLlib grown to the end cuts nowhere else."""
    from pyspark.ml.regression import DecisionTreeRegressor

    rng = np.random.default_rng(5)
    values = np.round(rng.gamma(2.0, 30.0, 3000))
    cuts = E.candidate_cuts(values, 32)
    df = spark.createDataFrame([([v], float(i % 97)) for i, v in enumerate(values.tolist())], "x array<double>, label double")
    model = DecisionTreeRegressor(maxDepth=12).fit(df.select(array_to_vector("x").alias("features"), "label"))
    used = {float(line.split("<= ")[1].rstrip(")")) for line in model.toDebugString.split("\n") if "<=" in line}
    assert len(cuts) == 31 and used <= set(cuts) and len(used) > 20
    assert E.candidate_cuts(np.array([1.0, 1.0, 3.0, np.nan]), 32) == [2.0] and E.candidate_cuts(np.ones(3), 32) == []


def test_bins_put_values_where_trees_do(spark):
    df = spark.createDataFrame([([v],) for v in (1.0, 2.0, 2.5, float("nan"))], "x array<double>").select(array_to_vector("x").alias("f"))
    found = E.ToBins(inputCol="f", outputCol="b", cuts=json.dumps([[1.5, 2.0]])).transform(df)
    assert [r["b"][0] for r in found.collect()] == [0.0, 1.0, 2.0, 2.0]
