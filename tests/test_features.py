"""Feature rules, encoders, statistics, selection, split and metrics."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.functions.values import float_text
from tabwright.operators import encode as E
from tabwright.operators import information
from tabwright.operators import metrics as M
from tabwright.operators import select as S
from tabwright.operators import order as O
from tabwright.operators.features import extract_features
from tabwright.operators.information import digamma, neighbour_information
from tabwright.operators.split import hash_split, train_test_split
from tabwright.plans.preprocess import Preprocessor, choose_roles, fit_preprocessor


def test_ticket_and_name_rules(spark):
    rows = [
        ("A/5 21171", "None", 21171.0),
        ("113803", "113803", 113803.0),
        ("PC 17599", "PC 17599", 17599.0),
        ("STON/O2. 31", "None", 31.0),
        ("LINE", "LINE", 0.0),
        ("", "None", 0.0),
        (None, "None", 0.0),
    ]
    got, _ = extract_features(spark.createDataFrame(rows, "Ticket string, p string, n double"))
    assert all(r["Ticket_Prefix"] == r["p"] and r["Ticket_Number"] == r["n"] for r in got.collect())
    assert "Ticket" not in got.columns
    names = spark.createDataFrame([("X, Mr. A", "Mr"), ("X, Zed. A", "Other"), (None, "Other"), ("X, Lady. B", "Nobility")], "Name string, t string")
    assert all(r["Name_Title"] == r["t"] for r in extract_features(names)[0].collect())


def test_family_rules(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (None, 0)], "SibSp int, Parch int")
    got = [(r["Family_Size"], r["Is_Alone"]) for r in extract_features(df)[0].collect()]
    assert got == [(1, 1), (2, 0), (None, 0)]


def test_float_spelling(spark):
    values = [0.0, 1.0, -2.5, 12345678.0, 1e15, 1e16, 1.5e17, 0.001, 0.00025, 1e-5, 123456789.125, 0.1]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", float_text(F.col("v")).alias("t"))
    assert [(r["v"], r["t"]) for r in df.collect()] == [(v, repr(v)) for v in values]


def test_label_codes_are_in_text_order(spark):
    df = spark.createDataFrame([(i,) for i in [1, 2, 10, None, 11]], "v int")
    got = {r["v"]: r["code"] for r in E.label_encode(df, "v", "code").collect()}
    assert got == {1: 0, 10: 1, 11: 2, 2: 3, None: 4}


def test_unseen_labels(spark):
    train = spark.createDataFrame([("a",), ("b",)], "v string")
    test = spark.createDataFrame([("b",), ("z",)], "v string")
    codes, _ = E.label_codes(train, "v")
    kept = {r["v"]: r["c"] for r in E.label_encode(test, "v", "c", codes, "keep").collect()}
    assert kept == {"b": 1, "z": 2}
    with pytest.raises(Exception, match="not seen"):
        E.label_encode(test, "v", "c", codes, "error").collect()


def test_scaling_and_one_hot(spark):
    df = spark.createDataFrame([(1.0, 1, "b"), (2.0, 2, "a"), (3.0, 2, None), (10.0, 3, "a"), (None, None, "c")], "x double, n int, t string")
    stats = E.fit_stats(df, ["x"], ["n", "t"])
    out = E.apply_stats(df, stats).toPandas()
    assert list(out.columns) == ["x", "n_2", "n_3", "t_b", "t_c"]
    filled = np.array([1, 2, 3, 10, 2.5])
    assert np.allclose(out["x"], (filled - filled.mean()) / filled.std())
    assert list(out["n_2"]) == [0, 1, 1, 0, 1] and list(out["t_b"]) == [1, 0, 0, 0, 0]
    unseen = spark.createDataFrame([(1.0, 9, "zzz")], "x double, n int, t string")
    row = E.apply_stats(unseen, stats).first()
    assert (row["n_2"], row["n_3"], row["t_b"], row["t_c"]) == (0, 0, 0, 0)


def test_constant_column_scales_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r["x"] for r in E.apply_stats(df, E.fit_stats(df, ["x"], [])).collect()] == [0.0, 0.0]


def test_impute_strategies(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (1.0,), (9.0,), (None,)], "x double")
    fills = {s: E.impute_values(df, ["x"], s)["x"] for s in ("median", "mean", "most_frequent", "constant")}
    assert fills == {"median": 2.0, "mean": 3.0, "most_frequent": 1.0, "constant": 0.0}
    with pytest.raises(ValueError):
        E.impute_values(df, ["x"], "other")


def test_preprocessor_saves_and_reapplies(spark, folder):
    i = F.col("id")
    df = spark.range(300).select(
        "id",
        (i % 7).cast("double").alias("x"),
        F.concat(F.lit("w"), i % 30).alias("word"),
        F.concat(F.lit("c"), i % 3).alias("cat"),
        F.when(i % 2 == 0, "yes").otherwise("no").alias("label"),
    )
    roles = choose_roles(df, exclude=["id"])
    assert roles.target == "label" and roles.task == "classification"
    assert roles.coded == ["word"] and set(roles.categorical) == {"x", "cat"}
    fitted = fit_preprocessor(df, roles)
    fitted.save(spark, folder)
    again = Preprocessor.load(spark, folder)
    assert again.names == fitted.names and again.classes == ["no", "yes"]
    a = fitted.transform(df, ["id"]).orderBy("id").collect()
    b = again.transform(df, ["id"]).orderBy("id").collect()
    assert a == b
    assert choose_roles(df, exclude=["id"], string_categoricals="drop", encoded=False).coded == []


def test_anova_matches_a_hand_sum(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 200)
    x = rng.normal(0, 1, 200) + y
    z = np.ones(200)
    df = spark.createDataFrame([(float(a), float(b), int(c)) for a, b, c in zip(x, z, y)], "x double, z double, y int")
    got = {r["feature"]: r["f_score"] for r in S.anova_f(df, ["x", "z"], "y").collect()}
    groups = [x[y == c] for c in range(3)]
    between = sum(len(g) * (g.mean() - x.mean()) ** 2 for g in groups) / 2
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / 197
    assert got["x"] == pytest.approx(between / within) and got["z"] is None
    assert [r["feature"] for r in S.select_k_best(df, ["x", "z"], "y", 1).collect()] == ["x"]


def test_mutual_information_of_a_copy_is_the_entropy(spark):
    df = spark.range(1000).select((F.col("id") % 4).cast("double").alias("x"), (F.col("id") % 4).alias("y"))
    assert S.mutual_information(df, ["x"], "y").first()["mi"] == pytest.approx(math.log(4))


def _psi(n):
    return -0.5772156649015329 + sum(1 / i for i in range(1, n))


def _neighbour_score(pairs, k):
    """Brute force over all pairs of rows."""
    pairs = [(v, c) for v, c in pairs if v is not None and math.isfinite(v) and c is not None]
    sizes = {c: sum(1 for _, d in pairs if d == c) for _, c in pairs}
    pairs = [(v, c) for v, c in pairs if sizes[c] > 1]
    if not pairs:
        return None
    total = 0.0
    for i, (v, c) in enumerate(pairs):
        same = sorted(abs(v - w) for j, (w, d) in enumerate(pairs) if j != i and d == c)
        radius = same[min(k, len(same)) - 1]
        inside = sum(1 for j, (w, _) in enumerate(pairs) if j != i and abs(v - w) <= radius)
        total += _psi(sum(1 for d in same if d <= radius)) - _psi(sizes[c]) - _psi(inside)
    return max(_psi(len(pairs)) + total / len(pairs), 0.0)


@pytest.mark.parametrize("block", [3, 50_000])
def test_neighbour_information_against_all_pairs(spark, monkeypatch, block):
    """Ties, copies, missing and infinite values, a class of one row and one of two; windows of three ranks too."""
    monkeypatch.setattr(O, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(240):
        c = "abc"[rng.integers(3)]
        rows.append((float(rng.integers(-4096, 4096)) / 1024 + "abc".index(c), float(rng.integers(5)), c))
    rows += [(None, 1.0, "a"), (float("nan"), 2.0, "b"), (float("inf"), None, "c"), (0.5, 1.0, None)]
    rows += [(0.25, 1.0, "single"), (0.5, 4.0, "two"), (7.5, 4.0, "two")]
    df = spark.createDataFrame(rows, "x double, z double, y string")
    first = neighbour_information(df, ["x", "z"], "y")
    got = {r["feature"]: r["mi"] for r in first.collect()}
    assert got["x"] == pytest.approx(_neighbour_score([(r[0], r[2]) for r in rows], 3), abs=1e-9)
    assert got["z"] == pytest.approx(_neighbour_score([(r[1], r[2]) for r in rows], 3), abs=1e-9)
    assert got["x"] > 0.05
    again = neighbour_information(df.repartition(5), ["x", "z"], "y").collect()
    assert {r["feature"]: r["mi"] for r in again} == pytest.approx(got, abs=1e-12)


def test_neighbour_information_of_known_dependence(spark):
    """Two unit intervals that overlap by half share half a bit; unrelated values and an empty feature share none."""
    df = spark.range(6000).select(
        (F.rand(1) + F.when(F.col("id") % 2 == 0, 0.5).otherwise(0)).alias("x"),
        F.rand(2).alias("noise"),
        F.lit(None).cast("double").alias("empty"),
        (F.col("id") % 2).alias("y"),
        F.rand(1).alias("target"),
    )
    got = {r["feature"]: r["mi"] for r in neighbour_information(df, ["x", "noise", "empty"], "y").collect()}
    assert got["x"] == pytest.approx(math.log(2) / 2, abs=0.03)
    assert got["noise"] < 0.03 and got["empty"] is None
    assert neighbour_information(df.limit(0), ["x"], "y").first()["mi"] is None
    assert [r["feature"] for r in S.select_k_best(df, ["noise", "x"], "y", 1, "mutual_info_knn").collect()] == ["x"]
    best = S.select_k_best(df, ["noise", "x"], "target", 1, "mutual_info_knn", "regression").collect()
    assert [r["feature"] for r in best] == ["x"]


def test_digamma_of_whole_numbers(spark):
    got = spark.range(1, 60).select("id", digamma(F.col("id")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(_psi(r["id"]), abs=1e-12) for r in got)


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(3000)
    train, test = train_test_split(df, ["id"])
    a, b = {r[0] for r in train.collect()}, {r[0] for r in test.collect()}
    assert not a & b and len(a | b) == 3000 and 500 < len(b) < 700
    again = {r[0] for r in train_test_split(df.repartition(7), ["id"])[1].collect()}
    assert b == again
    assert hash_split(df, ["id"], exact=True).filter("is_test").count() == 600
    assert hash_split(df, ["id"], test_size=0.1234, exact=True).filter("is_test").count() == math.ceil(3000 * 0.1234)


def metric_row(spark, pairs, ddl="y int, p int"):
    return M.classification_metrics(spark.createDataFrame(pairs, ddl), "y", "p").first()


def test_binary_and_weighted_metrics(spark):
    row = metric_row(spark, [(1, 1), (1, 0), (0, 1), (0, 0), (1, 1)])
    assert row["accuracy"] == 0.6
    assert row["precision"] == row["recall"] == row["f1"] == pytest.approx(2 / 3)
    row = metric_row(spark, [(0, 0), (1, 1), (2, 1), (2, 2)])
    assert row["precision"] == pytest.approx((1 + 0.5 + 2 * 1.0) / 4)
    assert row["f1"] == pytest.approx((1 + 2 / 3 + 2 * 2 / 3) / 4)
    row = metric_row(spark, [(0, 0), (0, 0)])
    assert (row["accuracy"], row["precision"], row["f1"]) == (1.0, 0.0, 0.0)
    row = metric_row(spark, [(1, 0), (0, 0)])
    assert row["precision"] == 0.0 and row["f1"] == 0.0


def test_regression_metrics_of_constant_labels(spark):
    exact = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    off = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, p double")
    assert M.regression_metrics(exact, "y", "p").first()["r2"] == 1.0
    assert M.regression_metrics(off, "y", "p").first()["r2"] == 0.0


def test_evaluate_chooses_the_family(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(3)], "y double, p double")
    assert {r["metric"] for r in M.evaluate(df, "y", "p").collect()} == {"mse", "rmse", "mae", "r2"}
    assert {r["metric"] for r in M.evaluate(df, "y", "p", "classification").collect()} == {"accuracy", "precision", "recall", "f1"}


def test_ranges_of_neighbours_are_worked_out_once(spark, monkeypatch):
    rows = [(float(i * 7 % 50), i % 3) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, label int")
    total, plans = information.running_total, []

    def noted(events, *rest):
        plans.append(events._jdf.queryExecution().optimizedPlan().toString())
        return total(events, *rest)

    monkeypatch.setattr(information, "running_total", noted)
    assert information.neighbour_information(df, ["x"], "label").first()["mi"] is not None
    assert len(plans) == 1 and "Window" not in plans[0]
