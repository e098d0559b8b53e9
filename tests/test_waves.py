"""Machines on Fourier features that are not stored, held against MLlib's on stored ones."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tabwright.operators import fourier_fit, models
from tabwright.operators.fourier import projection
from tabwright.operators.fourier_fit import HUBER, WaveMachine, WaveModel, Waves, huber, minimise
from tabwright.operators.models import FeatureTable, build_model
from tabwright.session import written

N = 600


def rows(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(N, 3))
    y = {
        "number": 1000 + 50 * np.sin(x[:, 0]) + rng.normal(size=N),
        "two": (x[:, 0] ** 2 + x[:, 1] ** 2 > 1.5).astype(float),
        "three": np.digitize(x[:, 0], [-0.5, 0.5]).astype(float),
    }[kind]
    plain = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double")
    return plain.select(array_to_vector("x").alias("features"), "label"), x, y


def built(kind, monkeypatch, stored):
    monkeypatch.setattr(models, "STORED_ROWS", stored)
    family, task = ("svr", "regression") if kind == "number" else ("svm", "classification")
    table = FeatureTable(("a", "b", "c"), N, {"number": 0, "two": 2, "three": 3}[kind])
    return build_model(family, {"solver": "fourier", "max_iter": 100}, task, table).estimator


def test_many_rows_are_not_stored_as_waves(spark, monkeypatch):
    for kind in ("number", "two", "three"):
        assert isinstance(built(kind, monkeypatch, 100), WaveMachine)
        assert not isinstance(built(kind, monkeypatch, 1000), WaveMachine)


@pytest.mark.parametrize("kind", ["number", "two"])
def test_objective_is_as_low_as_mllibs(spark, monkeypatch, kind):
    df, x, y = rows(spark, kind)
    own, stored = built(kind, monkeypatch, 100), built(kind, monkeypatch, 1000)
    s = json.loads(own.getOrDefault("settings"))
    weights, shifts = projection(3, s["components"], s["gamma"], s["seed"])
    waves = np.sqrt(2 / len(shifts)) * np.cos(x @ weights + shifts)

    def objective(w, intercept):
        margin = waves @ w + intercept
        if kind == "two":
            loss = np.maximum(1 - (2 * y - 1) * margin, 0).mean()
        else:  # at the best scale
            z = np.abs(y - margin)
            loss = min(huber(margin, y, sigma)[0].mean() for sigma in np.geomspace(z.std() / 20, z.max() * 2, 400))
        return loss + s["reg"] / 2 * w @ w

    fitted = own.fit(df)
    *w, intercept = json.loads(fitted.getOrDefault("weights"))[0]
    last = stored.fit(df).stages[-1]
    theirs = objective(last.coefficients.toArray(), last.intercept)
    assert objective(np.array(w), intercept) <= theirs * 1.01


def test_classes_come_back_and_the_model_can_be_saved(spark, monkeypatch, tmp_path):
    df, _, y = rows(spark, "three")
    fitted = built("three", monkeypatch, 100).fit(df)
    fitted.write().overwrite().save(f"file://{tmp_path}/model")
    for model in (fitted, WaveModel.load(f"file://{tmp_path}/model")):
        scored = model.transform(df)
        assert scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.9
        assert scored.agg(F.max(F.size(vector_to_array("rawPrediction")))).first()[0] == 3
        assert fitted.transform(df.limit(0)).count() == 0


@pytest.mark.parametrize("d", [3, 300])
def test_written_records_are_small_and_hold_every_row(spark, monkeypatch, d):
    """Spark holds thousands of records at once for each task that reads them."""
    kept = []

    def keep(df, label):
        kept.append(written(df, label))
        return kept[-1]

    monkeypatch.setattr(fourier_fit, "written", keep)
    rng = np.random.default_rng(8)
    x, y = rng.normal(size=(5_000, d)), rng.normal(size=5_000)
    plain = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double").repartition(3)
    settings = {"dim": d, "gamma": 1 / d, "seed": 1, "components": 16, "reg": 1e-3, "steps": 2, "classes": 0}
    WaveMachine(settings=json.dumps(settings)).fit(plain.select(array_to_vector("x").alias("features"), "label"))
    records = kept[0].select(kept[0].columns[0]).collect()
    assert max(len(r[0]) for r in records) <= max(1024, 8 * (d + 1))
    found = np.concatenate([np.frombuffer(r[0]).reshape(-1, d + 1) for r in records])
    assert sorted(map(tuple, found)) == sorted(map(tuple, np.column_stack([x, y])))
    summed = fourier_fit._summed(kept[0], *projection(d, 16, 1 / d, 1), lambda waves, y: np.r_[len(y), y.sum(), waves.sum()])
    weights, shifts = projection(d, 16, 1 / d, 1)
    assert np.allclose(summed, [5_000, y.sum(), (np.sqrt(2 / 16) * np.cos(x @ weights + shifts)).sum()], rtol=1e-5, atol=1e-2)


def test_long_angles_keep_their_cosine():
    weights, shifts = projection(2, 16, 1.0, 1)
    x = np.random.default_rng(1).normal(size=(50, 2)) * 1e5
    assert np.abs(Waves(weights, shifts)(x) - np.sqrt(2 / 16) * np.cos(x @ weights + shifts)).max() < 1e-5


def test_minimum_of_a_smooth_function():
    a = np.diag([1.0, 10.0, 100.0])
    found = minimise(lambda v: (0.5 * v @ a @ v - v.sum(), a @ v - 1), np.zeros(3), 100)
    assert np.abs(a @ found - 1).max() < 1e-2
    assert HUBER == 1.35
