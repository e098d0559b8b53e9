"""Kernel machines in the dual against a plain solution of the same problem."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector

from tabwright.operators import support as S
from tabwright.operators.models import FeatureTable, build_model


def projected(v, sign, c):
    """The nearest point of the box that is orthogonal to ``sign``."""
    low, high = -1e6, 1e6
    for _ in range(100):
        mid = (low + high) / 2
        a = np.clip(v - mid * sign, 0, c)
        low, high = (mid, high) if a @ sign > 0 else (low, mid)
    return a


def plain_decision(x, y, c, gamma, epsilon=None):
    """Decision values of the rows, by accelerated projected gradients on the whole dual."""
    k = S.gaussian(x, x, gamma)
    n = len(x)
    if epsilon is None:
        sign, linear, row = y, -np.ones(n), np.arange(n)
    else:
        sign, linear, row = np.r_[np.ones(n), -np.ones(n)], np.r_[epsilon - y, epsilon + y], np.r_[np.arange(n), np.arange(n)]
    q = sign[:, None] * sign[None] * k[np.ix_(row, row)]
    step, a, ahead, t = 1 / np.linalg.eigvalsh(q).max(), np.zeros(len(sign)), np.zeros(len(sign)), 1.0
    for _ in range(4000):
        after = projected(ahead - step * (q @ ahead + linear), sign, c)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, a, t = after + (t - 1) / t2 * (after - a), after, t2
    score = -sign * (q @ a + linear)
    free = (a > 1e-4 * c) & (a < c * (1 - 1e-4))
    return k @ np.bincount(row, sign * a, n) + score[free].mean()


@pytest.fixture(scope="module")
def rings():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 1.2, (160, 2))
    y = np.where((x**2).sum(1) + rng.normal(0, 0.5, 160) > 2, 1.0, -1.0)
    return x, y


def pairs_of(spark, x, y):
    rows = [(0, i, list(map(float, a)), float(b)) for i, (a, b) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "pair int, id long, x array<double>, y double")


@pytest.mark.parametrize("block", [30, 1000])
@pytest.mark.parametrize("epsilon", [None, 0.2])
def test_cascade_equals_a_plain_solution(spark, rings, monkeypatch, block, epsilon):
    x, y = rings
    if epsilon is not None:
        y = np.sin(x[:, 0] * 1.5) + 0.3 * x[:, 1] + np.random.default_rng(1).normal(0, 0.1, len(x))
    monkeypatch.setattr(S, "BLOCK_ROWS", block)
    _, hx, _, weight, bias = S.fit_dual(pairs_of(spark, x, y), 2.0, 0.7, epsilon)[0]
    got = S.gaussian(x, hx, 0.7) @ weight + bias
    assert np.abs(got - plain_decision(x, y, 2.0, 0.7, epsilon)).max() < 0.02
    assert abs(weight.sum()) < 1e-6 and np.abs(weight).max() <= 2.0 + 1e-9
    if epsilon is not None:  # rows inside the tube carry no weight, rows outside carry all
        held = {tuple(a): w for a, w in zip(hx.tolist(), weight)}
        off = np.abs(got - y)
        assert all(tuple(a) not in held for a in x[off < epsilon - 0.01].tolist())
        assert all(abs(held[tuple(a)]) > 2.0 - 1e-6 for a in x[off > epsilon + 0.01].tolist())


def test_three_classes_vote_and_are_saved(spark, folder):
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0], [3, 0], [0, 3]])
    rows = [([float(v) for v in centres[i % 3] + rng.normal(0, 0.5, 2)], float(i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    model = build_model("svm", {"C": 1.0}, "classification", FeatureTable(("a", "b"), 150, 3))
    assert isinstance(model.estimator, S.DualSupport)
    fitted = model.estimator.fit(df)
    assert fitted.transform(df).filter("prediction = label").count() > 140
    PipelineModel([fitted]).write().save(f"{folder}/dual")
    again = PipelineModel.load(f"{folder}/dual").transform(df)
    assert sorted(again.select("decision", "prediction").collect()) == sorted(fitted.transform(df).select("decision", "prediction").collect())
    far = build_model("svm", {"C": 1.0}, "classification", FeatureTable(("a", "b"), 10**7, 3))
    assert not isinstance(far.estimator, S.DualSupport)


def test_odd_rows(spark):
    same = pairs_of(spark, np.zeros((6, 2)), np.array([1.0, -1, 1, -1, 1, -1]))
    _, _, _, weight, _ = S.fit_dual(same, 1.0, 1.0)[0]
    assert abs(weight.sum()) < 1e-9
    one = pairs_of(spark, np.eye(3), -np.ones(3))
    _, hx, _, weight, bias = S.fit_dual(one, 1.0, 1.0)[0]
    assert not weight.any() and bias < 0
    with pytest.raises(ValueError, match="no rows"):
        S.fit_dual(same.limit(0), 1.0, 1.0)


@pytest.mark.parametrize("epsilon", [None, 0.2])
def test_equal_rows_are_one(spark, monkeypatch, epsilon):
    """Rows many times over give the decisions they give one by one, and only different rows go into the cascade."""
    rng = np.random.default_rng(3)
    x = np.repeat(rng.integers(0, 4, (14, 2)), rng.integers(5, 15, 14), axis=0).astype(float)
    y = np.sin(x[:, 0]) + x[:, 1] if epsilon else np.where(x[:, 0] + rng.normal(0, 1, len(x)) > 1.5, 1.0, -1.0)
    grid = np.array([[a, b] for a in range(4) for b in range(4)], float)

    def decisions():
        _, hx, _, weight, bias = S.fit_dual(pairs_of(spark, x, y), 2.0, 0.7, epsilon)[0]
        return S.gaussian(grid, hx, 0.7) @ weight + bias

    sizes = []
    cascade = S._cascade
    monkeypatch.setattr(S, "_cascade", lambda rows, n, *a: sizes.append(n) or cascade(rows, n, *a))
    short = decisions()
    assert sizes[0] == len(np.unique(np.c_[x, y], axis=0))
    monkeypatch.setattr(S, "REPEATS", 10**9)
    whole = decisions()
    assert np.allclose(short, whole, atol=2e-2)
