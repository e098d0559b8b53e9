"""Forests grown to the end: pure and deep leaves, limits, tops, and saved models."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from tabwright.operators import forest as D
from tabwright.operators.models import FeatureTable, build_model


def frame(spark, x, y):
    rows = [(list(map(float, a)), float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")


def fitted(df, classes, **params):
    task = "classification" if classes else "regression"
    width = len(df.first()["features"])
    model = build_model("random_forest", {"n_estimators": 4, **params}, task, FeatureTable(tuple("abcdef"[:width]), df.count(), classes))
    assert isinstance(model.estimator, D.DeepForest)
    return model.estimator.fit(df)


def test_leaves_are_pure_and_deep(spark):
    n = 1500
    x = np.arange(n)[:, None]
    y = np.random.default_rng(0).integers(0, 2, n)  # labels without a pattern: cuts take small bites
    df = frame(spark, x, y)
    model = fitted(df, 2, max_depth=None)
    assert model.grown.agg(F.min("depth")).first()[0] > 30
    assert all((value[feature < 0].max(1) == 1).all() for feature, _, _, _, value in model.subtrees().values())
    limited = fitted(df, 2, max_depth=5, min_samples_split=3)
    assert limited.grown.agg(F.max("depth")).first()[0] == 5


@pytest.mark.parametrize("split, leaf", [(2, 1), (40, 1), (2, 15)])
def test_least_rows_of_nodes(spark, split, leaf):
    rng = np.random.default_rng(1)
    x, y = rng.normal(0, 1, (300, 3)), rng.integers(0, 3, 300).astype(float)
    feature, cut, left, right, _, _ = D.grow(x, y, np.ones(300), 3, 2, split, leaf, 0, 9)
    node = {0: np.arange(300)}
    for at in range(len(feature)):
        rows = node[at]
        assert len(rows) >= leaf
        if feature[at] >= 0:
            assert len(rows) >= split
            goes = x[rows, feature[at]] <= cut[at]
            node[left[at]], node[right[at]] = rows[goes], rows[~goes]


@pytest.mark.parametrize("classes", [3, 0])
def test_tops_and_splits_of_oversized_nodes(spark, monkeypatch, folder, classes):
    monkeypatch.setattr(D, "NODE_ROWS", 60)
    monkeypatch.setattr(D, "OVERSIZED", 1)
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(0, 1, 900), rng.integers(0, 9, 900), rng.normal(0, 1, 900)]
    wave = np.sin(2 * x[:, 0]) + 0.2 * x[:, 1]
    y = np.digitize(wave, [0.4, 1.2]) if classes else wave
    df = frame(spark, x, y)
    model = fitted(df, classes, max_depth=None, min_samples_split=4)
    assert model.tops.forest is not None and model.tops.splits
    scored = model.transform(df)
    if classes:
        assert scored.filter("prediction = label").count() > 820
    else:
        assert scored.agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0] < 0.1 * wave.var()
    PipelineModel([model]).write().save(f"{folder}/deep{classes}")
    again = PipelineModel.load(f"{folder}/deep{classes}").transform(df)
    assert sorted(again.select("label", "prediction").collect()) == sorted(scored.select("label", "prediction").collect())


def test_odd_tables(spark):
    df = frame(spark, np.zeros((30, 2)), np.arange(30) % 2)
    model = fitted(df, 2, max_depth=None)
    assert model.transform(df).select("prediction").distinct().count() == 1
    with pytest.raises(ValueError, match="no rows"):
        model_of = build_model("random_forest", {"max_depth": None}, "classification", FeatureTable(("a", "b"), 1, 2))
        model_of.estimator.fit(df.limit(0))


def test_equal_rows_travel_as_one(spark, monkeypatch):
    """A few different rows, many times each: no top, no split of pure nodes, one row a tree and different row."""
    monkeypatch.setattr(D, "NODE_ROWS", 40)
    monkeypatch.setattr(D, "OVERSIZED", 1)
    x = np.c_[np.repeat(np.arange(12), 100), np.tile(np.arange(3), 400)]
    y = (x[:, 0] * 7 % 12).astype(float)
    seen = []
    together = D.DeepForest._together
    monkeypatch.setattr(D.DeepForest, "_together", lambda self, *a: seen.append(together(self, *a)) or seen[-1])
    df = frame(spark, x, y)
    for classes in (0, 12):
        model = fitted(df, classes, max_depth=None)
        assert model.tops.forest is None and not model.tops.splits
        assert seen[-1].groupBy("tree").count().agg(F.max("count")).first()[0] <= 36
        assert model.transform(df).filter("abs(prediction - label) > 1e-9").count() == 0


@pytest.mark.parametrize("classes", [3, 0])
def test_counted_rows_grow_the_tree_of_their_copies(classes):
    rng = np.random.default_rng(8)
    x, count = rng.integers(0, 6, (80, 2)).astype(float), rng.integers(1, 5, 80)
    y, drawn = rng.integers(0, 3, 80).astype(float), rng.integers(1, 3, 80)
    each = [np.repeat(a, count, axis=0) for a in (x, y, drawn)]
    whole = D.grow(each[0], each[1], each[2].astype(float), classes, 2, 9, 4, 0, 5)
    short = D.grow(x, y, (drawn * count).astype(float), classes, 2, 9, 4, 0, 5, count)
    assert all(np.allclose(a, b) for a, b in zip(whole, short))


@pytest.mark.parametrize("classes", [3, 0])
def test_rows_meet_the_subtrees_of_a_large_forest(spark, monkeypatch, classes):
    """Subtrees that no task holds together give the answers of those that all do."""
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1, (400, 3))
    y = rng.integers(0, 3, 400) if classes else x[:, 0] * 2 + rng.normal(0, 1, 400)
    df = frame(spark, x, y)
    monkeypatch.setattr(D, "NODE_ROWS", 100)
    model = fitted(df, classes, max_depth=None)
    columns = ["features", "prediction"] + (["probability"] if classes else [])

    def answers():
        return sorted(map(str, model.transform(df).select(*columns).collect()))

    held = answers()
    monkeypatch.setattr(D, "HELD_NODES", 0)
    monkeypatch.setattr(D, "MEETING_ROWS", 30)
    monkeypatch.setattr(D.DeepForestModel, "subtrees", None)
    assert len(held) == 400 and answers() == held


@pytest.mark.parametrize("regress", [False, True])
def test_many_splits_are_one_step_of_the_plan(spark, regress):
    """Each split once named the column before it twice, so the plan doubled with every one of them."""
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400)])
    df = frame(spark, x, (x[:, 0] > 0) ^ (x[:, 1] > 1)).withColumnRenamed("features", "_vector")
    indexed = VectorIndexer(inputCol="_vector", outputCol="v", maxCategories=4).fit(df).transform(df)  # the second is a category
    rows = indexed.select(F.col("v").alias("_vector"), "label")
    make = DecisionTreeRegressor if regress else DecisionTreeClassifier
    model = make(featuresCol="_vector", labelCol="label", maxDepth=3, seed=1).fit(rows)
    assert model.numNodes > 3
    trees, splits = 3, [(0, 0, 100, model), (1, 0, 200, model), (0, 101, 300, model), (1, 7, 400, model), (0, 302, 500, model)]
    whole = RandomForestRegressor if regress else RandomForestClassifier
    forest = whole(featuresCol="_vector", labelCol="label", numTrees=trees, maxDepth=1, seed=1).fit(rows)
    placed = D._Tops(trees, forest, splits).place(rows)
    plain = D._Tops(trees, forest).place(rows).withColumnRenamed("_nodes", "nodes")
    named = model.copy({model.getParam("leafCol"): "leaf"}).transform(plain)
    assert named.select("leaf").distinct().count() > 2

    def settle(nodes, leaf):
        for tree, node, first, _ in splits:
            if nodes[tree] == node:
                nodes[tree] = first + leaf
        return nodes

    expected = sorted((tuple(r["_vector"]), tuple(settle(list(r["nodes"]), int(r["leaf"])))) for r in named.collect())
    assert sorted((tuple(r["_vector"]), tuple(r["_nodes"])) for r in placed.collect()) == expected
    many = [D._Tops(trees, forest, [(0, n, 100 + n, model) for n in range(size)]) for size in (1, 10)]
    plans = [t.place(rows).select(F.posexplode("_nodes"))._jdf.queryExecution().optimizedPlan().toString() for t in many]
    assert len(plans[1]) < 2 * len(plans[0])
