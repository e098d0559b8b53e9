"""Models on a separable table, parameters, search, tracking and scoring."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import metrics as M
from tabwright.operators import runs as R
from tabwright.operators import trials as TR
from tabwright.operators.models import FeatureTable, build_model, effective_params
from tabwright.plans import experiment as X
from tabwright.plans.search import different_plan, run_trials, save_results, search
from tabwright.streaming.scoring import Scorer


@pytest.fixture(scope="module")
def separable(spark):
    i = F.col("id")
    noise = (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0) - 0.5
    return spark.range(400).select(
        "id",
        (F.when(i % 2 == 0, 2.0).otherwise(-2.0) + noise).alias("a"),
        noise.alias("b"),
        F.when(i % 3 == 0, "p").otherwise("q").alias("c"),
        (i % 2).alias("target"),
    )


@pytest.fixture(scope="module")
def prepared(separable):
    return X.prepare(separable, keys=["id"], exclude=["id"])


CHEAP = {
    "random_forest": {"n_estimators": 5, "max_depth": 3},
    "gradient_boosting": {"n_estimators": 2, "max_depth": 2},
    "xgboost": {"n_estimators": 2, "max_depth": 2, "subsample": 0.8, "colsample_bytree": 0.8},
    "lightgbm": {"n_estimators": 2, "max_depth": 3, "num_leaves": 4},
    "logistic_regression": {"max_iter": 10},
    "knn": {"n_neighbors": 3},
}


@pytest.mark.parametrize("family", sorted(CHEAP))
def test_classifiers_separate(prepared, family):
    metrics, _, _ = X.fit_and_score(prepared, family, CHEAP[family])
    assert metrics["accuracy"] > 0.9 and metrics["f1"] > 0.9


@pytest.mark.parametrize("kernel", ["linear", "rbf"])
def test_svm_separates(prepared, kernel):
    metrics, _, _ = X.fit_and_score(prepared, "svm", {"kernel": kernel, "max_iter": 5})
    assert metrics["accuracy"] > 0.9


@pytest.mark.parametrize("family", ["random_forest", "gradient_boosting", "linear_regression", "svr", "knn"])
def test_regressors_beat_the_mean(spark, separable, family):
    df = separable.withColumn("y", F.col("a") * 3 + 1).drop("target")
    prepared = X.prepare(df, "y", keys=["id"], exclude=["id"])
    assert prepared.task == "regression"
    params = {"n_estimators": 5, "max_depth": 3} if family in ("random_forest", "gradient_boosting") else {"max_iter": 20}
    metrics, _, _ = X.fit_and_score(prepared, family, params if family != "knn" else {})
    assert metrics["r2"] > 0.5


def test_many_classes_one_vs_rest(spark):
    i = F.col("id")
    df = spark.range(240).select("id", ((i % 3) * 5 + (i % 7) / 10.0).alias("x"), F.concat(F.lit("k"), i % 3).alias("target"))
    prepared = X.prepare(df, keys=["id"], exclude=["id"])
    metrics, _, _ = X.fit_and_score(prepared, "gradient_boosting", {"n_estimators": 2, "max_depth": 2})
    assert metrics["accuracy"] > 0.9


def test_effective_params():
    deep = {"max_depth": None, "min_samples_split": 5}
    used, dropped = effective_params("random_forest", {**deep, "engine": "mllib"})
    assert used["max_depth"] == 30 and used["n_estimators"] == 100 and dropped == ["min_samples_split"]
    used, dropped = effective_params("random_forest", deep)
    assert (used["max_depth"], used["min_samples_split"]) == (0, 5) and dropped == []
    leafy = {"max_depth": 7, "num_leaves": 20, "subsample": 0.8}
    used, dropped = effective_params("lightgbm", {**leafy, "engine": "mllib"})
    assert used["max_depth"] == 5 and dropped == ["subsample"]
    used, dropped = effective_params("lightgbm", leafy)
    assert (used["max_depth"], used["num_leaves"]) == (7, 20) and dropped == ["subsample"]
    used, _ = effective_params("nonsense", {})
    assert used["n_estimators"] == 100
    used, dropped = effective_params("svm", {"kernel": "linear", "gamma": "auto"})
    assert "gamma" not in used and dropped == ["gamma"]
    assert "random_state" not in effective_params("logistic_regression", {"random_state": 1})[0]


def test_logistic_penalty_follows_c():
    model = build_model("logistic_regression", {"C": 0.1}, "classification", FeatureTable(("a",), 200))
    assert model.estimator.getRegParam() == pytest.approx(1 / (0.1 * 200))


def test_grid_and_plan(spark):
    combos = TR.param_grid(TR.grid_table(spark))
    sizes = {r["model_type"]: r["n"] for r in combos.groupBy("model_type").agg(F.count("*").alias("n")).collect()}
    assert sizes == {
        "random_forest": 108,
        "gradient_boosting": 54,
        "xgboost": 108,
        "lightgbm": 162,
        "logistic_regression": 24,
        "svm": 12,
        "knn": 16,
    }
    first = [r["params"] for r in combos.filter("model_type = 'svm'").orderBy("combo_pos").collect()]
    assert first[0] == {"C": "0.1", "kernel": "rbf", "gamma": "scale"}
    assert first[1] == {"C": "0.1", "kernel": "rbf", "gamma": "auto"}
    assert first[2] == {"C": "0.1", "kernel": "linear", "gamma": "scale"}
    plan = TR.trial_plan(combos).orderBy("trial_no").collect()
    assert [r["model_type"] for r in plan] == ["random_forest"] * 3 + ["gradient_boosting"] * 3 + ["xgboost"] * 3 + ["lightgbm"]
    assert [r["seed"] for r in plan] == list(range(1, 11))
    assert TR.trial_plan(combos, ["knn"]).count() == 3


def test_search_keeps_failures_and_saves(spark, separable, folder):
    grids = [
        ("Broken", "knn", {"n_neighbors": [3], "metric": ["nope"]}),
        ("LogisticRegression", "logistic_regression", {"C": [1.0], "solver": ["lbfgs", "liblinear"], "max_iter": [5]}),
    ]
    plan = TR.trial_plan(TR.param_grid(TR.grid_table(spark, grids)))
    result = search(separable, keys=["id"], exclude=["id"], plan=plan)
    rows = {r["trial_no"]: r for r in result.trials.collect()}
    assert rows[1]["status"] == "failed" and "nope" in rows[1]["error"] and rows[1]["metrics"] == {}
    assert rows[2]["status"] == "completed" and rows[2]["dropped"] == []
    assert [r["rank"] for r in result.leaderboard().collect()] == [1, 2]
    save_results(result, "toy", folder)
    head = spark.read.json(f"{folder}/header").first()
    assert (head["total_trials"], head["successful"], head["target"]) == (3, 2, "target")
    best = result.best()
    assert best in {r["run_id"] for r in result.run_rows("toy").collect()}
    assert result.run_rows("toy").schema.simpleString() == X.run_experiment_schema(spark).simpleString()
    result.save_best(f"{folder}/best")
    ours = result.scorer().score(separable, keep=["id"]).collect()
    assert sorted(Scorer.load(spark, f"{folder}/best").score(separable, keep=["id"]).collect()) == sorted(ours)


def test_plan_has_no_repeats(spark):
    plan = different_plan(spark, None, 10, "classification").collect()
    assert len(plan) == 10 and [r["trial_no"] for r in plan] == list(range(1, 11))
    assert {r["params"]["min_samples_split"] for r in plan if "min_samples_split" in r["params"]} <= {"2"}


def test_saved_neighbours_equal_the_join(spark, separable, folder):
    params = {"model_type": "knn", "model_params": {"n_neighbors": 3}, "keys": ["id"], "exclude": ["id"]}
    run = X.run_experiment(separable, params, "toy", model_path=f"{folder}/knn").first()
    assert run["model_path"] == f"{folder}/knn"
    scored = Scorer.load(spark, f"{folder}/knn").score(separable, keep=["id", "target"])
    right = scored.filter(F.col("predicted_class") == F.col("target").cast("string")).count()
    assert scored.count() == 400 and right > 360


def test_own_rules_are_saved(spark, folder):
    from tabwright.operators.features import Rule, char_at, equals_flag, then

    df = spark.createDataFrame([(i, f"{'AB'[i % 2]}{i}", float(i % 7), i % 2) for i in range(200)], "id int, code string, x double, y int")
    rules = [Rule("first", ("code",), then(char_at(0, "?"), equals_flag("A")), "numerical")]
    params = {"target_column": "y", "model_type": "logistic_regression", "keys": ["id"], "exclude": ["id"], "rules": rules}
    X.run_experiment(df, params, "own", model_path=f"{folder}/own")
    scored = Scorer.load(spark, f"{folder}/own").score(df, keep=["y"])
    assert scored.filter("predicted_class = cast(y AS string)").count() == 200


def test_rare_classes_keep_their_rows(spark):
    df = spark.createDataFrame([(i, float(i % 9), "rare" if i == 3 else "ab"[i % 2]) for i in range(200)], "id int, x double, y string")
    for seed in range(12):
        prepared = X.prepare(df, "y", keys=["id"], exclude=["id"], seed=seed)
        assert prepared.n_samples == 200 and prepared.preprocessor.classes == ["a", "b", "rare"]
    missing = df.withColumn("y", F.when(F.col("id") > 4, F.col("y")))
    kept = X.prepare(missing, "y", keys=["id"], exclude=["id"])
    assert (kept.n_samples, kept.n_unlabelled, kept.preprocessor.classes) == (200, 0, ["a", "b", "nan"])
    numbers = df.withColumn("y", F.when(F.col("id") > 4, F.col("x") * 0.5))
    assert X.prepare(numbers, "y", "regression", keys=["id"], exclude=["id"]).n_unlabelled == 5


def test_more_than_twenty_classes(spark):
    df = spark.createDataFrame([(i, float(i % 23), f"c{i % 23:02d}") for i in range(460)], "id int, x double, y string")
    prepared = X.prepare(df, "y", keys=["id"], exclude=["id"])
    metrics, _, _ = X.fit_and_score(prepared, "gradient_boosting", {"n_estimators": 1, "max_depth": 5})
    assert metrics["accuracy"] > 0.9


def test_class_that_is_only_predicted(spark):
    rows = [(0, 0), (1, 1), (1, 1), (0, 2)]
    df = spark.createDataFrame(rows, "label int, prediction int")
    row = M.classification_metrics(df, "label", "prediction").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.75, 1.0, 1.0, 1.0)
    one = spark.createDataFrame([(0, 0), (0, 1)], "label int, prediction int")
    assert M.classification_metrics(one, "label", "prediction").first()["recall"] == 0.0


def test_search_stops_at_its_deadline(spark, prepared):
    grids = [("LogisticRegression", "logistic_regression", {"C": [0.1, 1.0], "max_iter": [5]})]
    rows = run_trials(prepared, TR.trial_plan(TR.param_grid(TR.grid_table(spark, grids))), timeout=0.0).collect()
    assert {r["status"] for r in rows} == {"timeout"} and len(rows) == 2


def test_error_metrics_rank_ascending(spark):
    df = spark.createDataFrame(
        [(1, "completed", {"mse": 2.0}), (2, "completed", {"mse": 1.0}), (3, "failed", {"mse": 0.0}), (4, "completed", {})],
        "trial_no long, status string, metrics map<string,double>",
    )
    assert [r["trial_no"] for r in TR.rank(df, "mse").orderBy("rank").collect()] == [2, 1]


def test_run_experiment_logs_and_scores(spark, separable, folder):
    params = {
        "model_type": "random_forest",
        "model_params": CHEAP["random_forest"],
        "keys": ["id"],
        "exclude": ["id"],
        "select_features": True,
        "n_features": 1,
    }
    steps = []
    run = X.run_experiment(separable, params, "toy", lambda p, m: steps.append(p), f"{folder}/runs", f"{folder}/model").first()
    assert run["status"] == "FINISHED" and run["params"]["n_features"] == "1" and steps[-1] == 100
    assert spark.read.parquet(f"{folder}/runs").count() == 1
    scorer = Scorer.load(spark, f"{folder}/model")
    batch = scorer.score(separable, keep=["id", "target"])
    right = batch.filter(F.col("predicted_class") == F.col("target").cast("string")).count()
    assert batch.count() == 400 and right > 380
    separable.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(separable.schema).parquet(f"{folder}/in")
    scorer.score_stream(stream, f"{folder}/out", f"{folder}/state", keep=["id", "target"]).awaitTermination()
    streamed = spark.read.parquet(f"{folder}/out")
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_fit_on_train_leaves_test_rows_out(spark):
    i = F.col("id")
    df = spark.range(200).select("id", i.cast("double").alias("x"), (i % 2).alias("target"))
    on_train = X.prepare(df, keys=["id"], exclude=["id"])
    on_all = X.prepare(df, keys=["id"], exclude=["id"], fit_on="all")
    mean = on_train.train.agg(F.avg("x")).first()[0]
    assert mean == pytest.approx(0.0, abs=1e-9)
    assert on_all.table.agg(F.avg("x")).first()[0] == pytest.approx(0.0, abs=1e-9)
    assert on_all.train.agg(F.avg("x")).first()[0] != pytest.approx(0.0, abs=1e-9)


def test_custom_family(prepared):
    from pyspark.ml.classification import LogisticRegression

    X.register_family("mine", lambda params, task, table: LogisticRegression(maxIter=5))
    metrics, _, model = X.fit_and_score(prepared, "mine", {})
    assert model.family == "mine" and metrics["accuracy"] > 0.9


def test_best_run_rules(spark):
    rows = [
        ("a", "e", 1, {"m": 0.5}),
        ("b", "e", 2, {"m": 0.5}),
        ("c", "e", 3, {"m": float("nan")}),
        ("d", "e", 4, {}),
        ("x", "other", 9, {"m": 9.0}),
    ]
    runs = spark.createDataFrame(rows, "run_id string, experiment string, start_time long, metrics map<string,double>")
    assert R.best_run(runs, "e", "m").first()["run_id"] == "b"
    assert R.best_run(runs, "e", "m", "min").first()["run_id"] == "b"
    assert R.best_run(runs, "nobody", "m").count() == 0
    assert R.best_run(runs, "e", "m", max_results=2).count() == 0
    assert R.get_run(runs, "d").count() == 1
    many = spark.range(150).select(F.col("id").cast("string").alias("run_id"), F.lit("e").alias("experiment"), F.col("id").alias("start_time"))
    assert [r["start_time"] for r in R.search_runs(many, "e").collect()] == list(range(149, 49, -1))


def test_run_events_and_upsert(spark):
    start = spark.createDataFrame([("r1", 1, "RUNNING", None), ("r2", 2, "RUNNING", None)], "run_id string, seq long, status string, end_time long")
    ends = R.end_run_events(spark.createDataFrame([("r1", 3, 99)], "run_id string, seq long, at long"))
    state = {r["run_id"]: (r["status"], r["end_time"]) for r in R.runs_latest(start.unionByName(ends)).collect()}
    assert state == {"r1": ("FINISHED", 99), "r2": ("RUNNING", None)}
    known = spark.createDataFrame([("a",)], "name string")
    asked = spark.createDataFrame([("a",), ("b",), ("b",)], "name string")
    assert [r["name"] for r in R.tracking_upsert(known, asked).collect()] == ["b"]


def test_source_columns_may_have_any_name(spark):
    """Names the plans used for themselves are ordinary features, and reserved ones are refused."""
    rows = [(i, float(i % 23), float(i % 29), "xy"[i % 2], i % 3, float(i % 2), "yes" if i % 2 else None) for i in range(300)]
    df = spark.createDataFrame(rows, "id int, label double, features double, is_test string, row_id int, prediction double, late string")
    prepared = X.prepare(df, "late", keys=["id"], exclude=["id"], select_features=True, k=5)
    assert prepared.n_samples == 300 and prepared.preprocessor.classes == ["nan", "yes"]
    assert {"label", "features", "is_test_y", "prediction"} <= set(prepared.names)
    kinds = prepared.table.select("label").distinct().count()
    assert kinds == 23
    for family, params in (("random_forest", CHEAP["random_forest"]), ("knn", {"n_neighbors": 3})):
        assert X.fit_and_score(prepared, family, params)[0]["accuracy"] == 1.0
    with pytest.raises(ValueError, match="share the names"):
        prepared.preprocessor.transform(df)
    with pytest.raises(ValueError, match="reserved"):
        X.prepare(df.withColumn("_tabwright_label", F.lit(1)), "late", keys=["id"])


def test_penalised_intercept_and_l1_meet_their_conditions(spark):
    """At the optimum the slope of the loss meets the penalty: equal for L2, within its box and zeroing weights for L1."""
    import json

    import numpy as np
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (300, 5))
    y = (x[:, 0] - 0.5 * x[:, 1] + 0.8 + rng.normal(0, 1, 300) > 0).astype(float)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x, y)], "x array<double>, label double")
    df = df.select(array_to_vector("x").alias("features"), "label")
    wide = np.c_[x, np.ones(300)]
    for penalty, c in (("l2", 0.05), ("l1", 0.05)):
        params = {"C": c, "solver": "liblinear", "penalty": penalty, "max_iter": 500}
        fitted = build_model("logistic_regression", params, "classification", FeatureTable(tuple("abcde"), 300)).estimator.fit(df)
        w = np.array(json.loads(fitted.getOrDefault(fitted.weights))[0])
        slope = c * wide.T @ (1 / (1 + np.exp(-wide @ w)) - y)
        if penalty == "l2":
            assert np.allclose(slope, -w, atol=1e-4)
        else:
            assert (np.abs(w[2:5]) == 0).all() and np.abs(w[0]) > 0
            assert np.allclose(slope[w != 0], -np.sign(w[w != 0]), atol=1e-4) and (np.abs(slope) <= 1 + 1e-4).all()
            assert fitted.transform(df).filter("prediction = label").count() > 220
    three = df.withColumn("label", F.pmod(F.monotonically_increasing_id(), F.lit(3)).cast("double"))
    many = build_model("logistic_regression", {"solver": "liblinear"}, "classification", FeatureTable(tuple("abcde"), 300, 3))
    assert many.estimator.fit(three).transform(three).select("prediction").distinct().count() > 1


def test_info_row_holds_the_summary(separable, prepared):
    import json

    row = X.dataset_info(prepared, "toy", separable).first()
    summary = json.loads(row["summary"])
    assert summary["target"] == "target" and summary["n_rows"] == 400 and summary["columns"] == separable.columns
    assert summary["types"]["c"] == "categorical" and row["n_samples"] == 400


@pytest.mark.parametrize("classes", [2, 3, 0])
def test_boosting_trains_on_equal_rows_as_one(spark, monkeypatch, classes):
    """MLlib's booster gives the same answers for weighted rows, of which there are as many as different ones."""
    import numpy as np
    from pyspark.ml.functions import array_to_vector
    from tabwright.operators import models as M

    rng = np.random.default_rng(4)
    x = np.repeat(rng.integers(0, 5, (30, 2)), rng.integers(5, 30, 30), axis=0)
    y = (x[:, 0] * 2 + x[:, 1]) % (classes or 7)
    df = spark.createDataFrame([(a.tolist(), float(b)) for a, b in zip(x.astype(float), y)], "x array<double>, label double")
    df = df.select(array_to_vector("x").alias("features"), "label")
    seen = []
    monkeypatch.setattr(M, "written", lambda rows, name: seen.append(rows) or rows)
    task = "classification" if classes else "regression"
    params = {"n_estimators": 5, "max_depth": 3, "engine": "mllib"}

    def answers():
        fitted = build_model("gradient_boosting", params, task, FeatureTable(("a", "b"), len(x), classes)).estimator.fit(df)
        return [r["prediction"] for r in fitted.transform(df).select("prediction").collect()]

    weighted = answers()
    assert [r.count() for r in seen] == [len(np.unique(np.c_[x, y], axis=0))]
    monkeypatch.setattr(M, "REPEATS", 10**9)
    assert np.allclose(weighted, answers()) and len(seen) == 1
