"""Model, experiment, search and scoring queries.

Where a target is a step function of one column, or the model is a straight
line, SQL states what a trained model must give; the other models are checked by
row count here and by bounds in the tests.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite import query, table
from suite.encoding import DIGEST, LIMIT
from tabwright.operators import trials as TR
from tabwright.operators.boosting import BoostPlan, boost
from tabwright.operators.metrics import confusion_matrix
from tabwright.operators.models import FeatureTable, build_model
from tabwright.operators.runs import get_run
from tabwright.operators.split import hash_split
from tabwright.plans.experiment import dataset_info, fit_and_score, prepare, run_experiment, save_scorer
from tabwright.plans.search import run_trials, save_results, search
from tabwright.session import fresh_path
from tabwright.streaming.scoring import Scorer

KEYS = ["l_orderkey", "l_partkey", "l_suppkey"]
LINE_KEYS = ["l_orderkey", "l_partkey", "l_linenumber"]


def sales(spark, sf_dir) -> DataFrame:
    """lineitem with its identifiers left out of the features."""
    return table(spark, sf_dir, "lineitem")


def scores(spark, sf_dir, family, target, task, **params) -> DataFrame:
    """(metric, value) of one family on whole lineitem."""
    df = sales(spark, sf_dir)
    prepared = prepare(df, target, task, exclude=KEYS)
    metrics, _, model = fit_and_score(prepared, family, params)
    rows = [(model.family, k, round(v, 6)) for k, v in sorted(metrics.items())]
    return spark.createDataFrame(rows, "family string, metric string, value double")


def model_query(name, family, target, task, **params):
    @query(name)
    def run(spark, sf_dir):
        return scores(spark, sf_dir, family, target, task, **params)

    return run


ORDER_ROW = DIGEST.format(keys="CAST(o_orderkey AS VARCHAR)")


def threshold_query(name, family, classes=2, **params):
    """A target that is a step function of one column with few values must be predicted for every test row.

    The result counts test rows by label and prediction; SQL states that they agree.
    """
    step = "extract(month FROM o_orderdate)"
    label = f"CAST({step} > 6 AS INTEGER)" if classes == 2 else f"CAST(floor(({step} - 1) / 4) AS INTEGER)"

    @query(
        name,
        f"SELECT CAST(y AS DOUBLE) AS label, CAST(y AS DOUBLE) AS prediction, count(*) AS n "
        f"FROM (SELECT {label} AS y FROM orders WHERE {ORDER_ROW} < '{LIMIT}') GROUP BY y",
    )
    def run(spark, sf_dir):
        orders = table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
        y = (F.col("month") > 6).cast("int") if classes == 2 else F.floor((F.col("month") - 1) / 4).cast("int")
        df = orders.withColumn("y", y).select("o_orderkey", "month", "o_orderpriority", "y")
        prepared = prepare(df, "y", "classification", keys=["o_orderkey"], exclude=["o_orderkey"])
        _, fitted, _ = fit_and_score(prepared, family, params)
        scored = fitted.transform(prepared.vectors(prepared.test))
        if "probability" in scored.columns:
            # rows whose probabilities do not sum to one would be missing from the counts
            total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, p: a + p)
            scored = scored.filter(F.abs(total - 1) < 1e-9)
        return confusion_matrix(scored, "label", "prediction")

    return run


@query(
    "missing_class_confusion",
    f"""SELECT CASE WHEN m <= 4 THEN 'early' WHEN m > 8 THEN 'late' ELSE 'nan' END AS label,
    CASE WHEN m <= 4 THEN 'early' WHEN m > 8 THEN 'late' ELSE 'nan' END AS prediction, count(*) AS n, (SELECT count(*) FROM orders) AS n_samples
    FROM (SELECT extract(month FROM o_orderdate) AS m FROM orders WHERE {ORDER_ROW} < '{LIMIT}') GROUP BY 1""",
)
def missing_class_confusion(spark, sf_dir):
    """Rows without a class are of the class nan, and features may be called like the plans' own columns."""
    month = F.month("o_orderdate")
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month.alias("label"),
        F.col("o_totalprice").alias("features"),
        F.col("o_orderpriority").alias("is_test"),
        F.dayofmonth("o_orderdate").alias("row_id"),
        F.when(month <= 4, "early").when(month > 8, "late").alias("season"),
    )
    prepared = prepare(df, "season", keys=["o_orderkey"], exclude=["o_orderkey"])
    _, fitted, _ = fit_and_score(prepared, "random_forest", {"n_estimators": 20, "max_depth": 10})
    counts = confusion_matrix(fitted.transform(prepared.vectors(prepared.test)), "label", "prediction")
    classes = F.array(*map(F.lit, prepared.preprocessor.classes))
    names = [F.get(classes, F.col(c).cast("int")).alias(c) for c in ("label", "prediction")]
    return counts.select(*names, "n", F.lit(prepared.n_samples).cast("long").alias("n_samples"))


# Settings of the smallest grids of the shipped search space.
threshold_query("random_forest_classifier", "random_forest", n_estimators=50, max_depth=10)
threshold_query("gradient_boosting_classifier", "gradient_boosting", n_estimators=50, max_depth=3)
threshold_query("gradient_boosting_one_vs_rest", "gradient_boosting", classes=3, n_estimators=50, max_depth=3, engine="mllib")
threshold_query("xgboost_classifier", "xgboost", n_estimators=50, max_depth=3, engine="mllib")
threshold_query("lightgbm_classifier", "lightgbm", n_estimators=50, max_depth=7, num_leaves=20, engine="mllib")
threshold_query("newton_boosting_classifier", "xgboost", n_estimators=10, max_depth=3, subsample=0.8, colsample_bytree=0.8)
threshold_query("leafwise_boosting_classifier", "lightgbm", n_estimators=10, max_depth=7, num_leaves=20)
threshold_query("joint_boosting_classifier", "gradient_boosting", classes=3, n_estimators=10, max_depth=3)
threshold_query("newton_boosting_joint", "xgboost", classes=3, n_estimators=10, max_depth=3)
threshold_query("svm_linear", "svm", kernel="linear", max_iter=100, C=10.0)
model_query("random_forest_regressor", "random_forest", "l_extendedprice", "regression", n_estimators=50, max_depth=10)
model_query("gradient_boosting_regressor", "gradient_boosting", "l_extendedprice", "regression", n_estimators=50, max_depth=3)
model_query("logistic_regression", "logistic_regression", "l_returnflag", "classification", C=1.0, max_iter=100)
model_query("svm_rbf", "svm", "l_linestatus", "classification", kernel="rbf", max_iter=100, solver="fourier")
model_query("svr_rbf", "svr", "l_extendedprice", "regression", max_iter=100, solver="fourier")

threshold_query("deep_forest_classifier", "random_forest", n_estimators=20, max_depth=None, min_samples_split=5)
threshold_query("logistic_penalised_intercept", "logistic_regression", C=10.0, max_iter=100, solver="liblinear")
threshold_query("logistic_classifier", "logistic_regression", C=10.0, max_iter=100)


def steps_query(name, family, **params):
    """A number that is a step function of the month must come back for every test row, to the nearest whole number."""

    @query(
        name,
        f"SELECT o_orderkey, CAST((extract(month FROM o_orderdate) * 7) % 12 AS BIGINT) AS prediction FROM orders WHERE {ORDER_ROW} < '{LIMIT}'",
    )
    def run(spark, sf_dir):
        month = F.month("o_orderdate")
        orders = table(spark, sf_dir, "orders")
        df = orders.select("o_orderkey", month.alias("month"), "o_orderpriority", ((month * 7) % 12).cast("double").alias("y"))
        prepared = prepare(df, "y", "regression", keys=["o_orderkey"], exclude=["o_orderkey"])
        _, fitted, _ = fit_and_score(prepared, family, params)
        test = prepared.preprocessor.transform(hash_split(df, ["o_orderkey"]).filter("is_test"), ["o_orderkey"])
        return fitted.transform(test).select("o_orderkey", F.round("prediction").cast("long").alias("prediction"))

    return run


steps_query("deep_forest_regressor", "random_forest", n_estimators=10, max_depth=None)
steps_query("forest_regressor_steps", "random_forest", n_estimators=10, max_depth=10)
steps_query("boosting_regressor_steps", "gradient_boosting", n_estimators=40, max_depth=10)
steps_query("newton_regressor_steps", "xgboost", n_estimators=15, max_depth=10)
threshold_query("svm_dual_classifier", "svm", kernel="rbf", C=100.0, solver="dual")
threshold_query("svm_dual_three_classes", "svm", classes=3, kernel="rbf", C=100.0, solver="dual")


@query(
    "svr_dual_tube",
    f"SELECT extract(month FROM o_orderdate) AS month, count(*) AS n_inside FROM orders WHERE {ORDER_ROW} < '{LIMIT}' GROUP BY 1",
)
def svr_dual_tube(spark, sf_dir):
    """A kernel regression whose tube holds every test row: the target is a wave over the months."""
    month = F.month("o_orderdate")
    df = table(spark, sf_dir, "orders").select("o_orderkey", month.alias("month"), (F.sin(month / 2.0) * 3).alias("wave"))
    prepared = prepare(df, "wave", "regression", keys=["o_orderkey"], exclude=["o_orderkey"], string_categoricals="drop")
    _, fitted, _ = fit_and_score(prepared, "svr", {"C": 100.0, "epsilon": 0.1, "gamma": 4.0, "solver": "dual"})
    scored = fitted.transform(prepared.vectors(prepared.test))
    inside = scored.filter(F.abs(F.col("prediction") - F.col("label")) <= 0.1 + 5e-3)
    # months come back from the label, which is different for each of them
    waves = df.select("month", F.round("wave", 9).alias("w")).distinct()
    found = inside.select(F.round("label", 9).alias("w")).join(F.broadcast(waves), "w")
    return found.groupBy(F.col("month").cast("long").alias("month")).agg(F.count(F.lit(1)).alias("n_inside"))


BOOSTED = ["l_quantity", "l_discount", "l_linenumber"]


def boosted_rows(spark, sf_dir) -> DataFrame:
    x = F.array(*[F.col(c).cast("double") for c in BOOSTED])
    return table(spark, sf_dir, "lineitem").select(x.alias("x"), (F.col("l_returnflag") == "R").cast("double").alias("y"))


def cuts_sql(rows, keys, l2, least_h, least_n):
    """Candidate cuts (f, x, edge, gain, gl, hl, gr, hr) of the rows (f, x, g, h) of each group of ``keys``."""
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    return f"""SELECT {k}f, x, edge, gl, hl, g - gl AS gr, h - hl AS hr,
        0.5 * (gl * gl / (hl + {l2}) + (g - gl) * (g - gl) / (h - hl + {l2}) - g * g / (h + {l2})) AS gain
        FROM (SELECT *, sum(sg) OVER (PARTITION BY {k}f ORDER BY x) AS gl, sum(sh) OVER (PARTITION BY {k}f ORDER BY x) AS hl,
            sum(sn) OVER (PARTITION BY {k}f ORDER BY x) AS nl, sum(sg) OVER (PARTITION BY {k}f) AS g,
            sum(sh) OVER (PARTITION BY {k}f) AS h, sum(sn) OVER (PARTITION BY {k}f) AS n
            FROM (SELECT {k}f, x, sum(g) AS sg, sum(h) AS sh, count(*) AS sn FROM {rows} GROUP BY {k}f, x))
        JOIN edges USING (f, x) WHERE hl >= {least_h} AND h - hl >= {least_h} AND nl >= {least_n} AND n - nl >= {least_n}
        QUALIFY row_number() OVER ({part} ORDER BY gain DESC, f, x) = 1"""


def boosted_sql(prior, l2, least_h, least_n):
    """Root cut and best cut of both children of the first tree."""
    p = "(SELECT avg(y) FROM t)" if prior else "0.5"
    unpivot = " UNION ALL ".join(f"SELECT {{0}}{j} AS f, x{j} AS x, {p} - y AS g, {p} * (1 - {p}) AS h FROM {{1}}" for j in range(len(BOOSTED)))
    columns = ", ".join(f"CAST({c} AS DOUBLE) AS x{j}" for j, c in enumerate(BOOSTED))
    return f"""t AS (SELECT {columns}, CAST(l_returnflag = 'R' AS DOUBLE) AS y FROM lineitem),
    u AS ({unpivot.format('', 't')}),
    edges AS (SELECT f, x, x + (b - x) / 2 AS edge FROM (SELECT f, x, lead(x) OVER (PARTITION BY f ORDER BY x) AS b FROM (SELECT DISTINCT f, x FROM u)) WHERE b IS NOT NULL),
    root AS ({cuts_sql('u', '', l2, least_h, least_n)}),
    s AS (SELECT t.*, CASE root.f WHEN 0 THEN x0 WHEN 1 THEN x1 ELSE x2 END <= root.edge AS low FROM t, root),
    v AS ({unpivot.format('low, ', 's')}),
    child AS ({cuts_sql('v', 'low', l2, least_h, least_n)})"""


@query(
    "newton_leaf_values",
    f"""WITH {boosted_sql(False, 1.0, 1.0, 1)}
    SELECT root.f AS root_feature, round(root.edge, 6) AS root_cut, low, child.f AS child_feature, round(child.edge, 6) AS child_cut,
    round(-child.gl / (child.hl + 1), 9) AS left_value, round(-child.gr / (child.hr + 1), 9) AS right_value FROM root, child""",
)
def newton_leaf_values(spark, sf_dir):
    """A two-level tree of second-order boosting: SQL states its cuts and leaf values."""
    held = boost(boosted_rows(spark, sf_dir), BoostPlan(rounds=1, max_depth=2, prior=False))
    t = held["trees"][0][0]
    rows = []
    for low, child in ((True, t["left"][0]), (False, t["right"][0])):
        values = [round(t["value"][t[side][child]], 9) for side in ("left", "right")]
        rows.append((t["feature"][0], round(t["cut"][0], 6), low, t["feature"][child], round(t["cut"][child], 6), *values))
    return spark.createDataFrame(
        rows, "root_feature int, root_cut double, low boolean, child_feature int, child_cut double, left_value double, right_value double"
    )


@query(
    "leafwise_first_splits",
    f"""WITH {boosted_sql(True, 0.0, 0.001, 20)}
    SELECT 1 AS split, f AS feature, round(edge, 6) AS cut, round(gain, 5) AS gain FROM root
    UNION ALL (SELECT 2, f, round(edge, 6), round(gain, 5) FROM child ORDER BY gain DESC LIMIT 1)""",
)
def leafwise_first_splits(spark, sf_dir):
    """Growth stops at three leaves: the root and the better of its two children are split."""
    plan = BoostPlan(rounds=1, num_leaves=3, l2=0.0, min_rows=20, min_curvature=1e-3)
    t = boost(boosted_rows(spark, sf_dir), plan)["trees"][0][0]
    inner = [i for i, f in enumerate(t["feature"]) if f >= 0]  # a child comes after its parent
    rows = [(n, t["feature"][i], round(t["cut"][i], 6), round(t["gain"][i], 5)) for n, i in enumerate(inner, 1)]
    return spark.createDataFrame(rows, "split int, feature int, cut double, gain double")


LINE_ROW = DIGEST.format(keys="CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)")


@query(
    "linear_regression_scores",
    f"""WITH t AS (SELECT l_quantity AS x, l_extendedprice AS y, {LINE_ROW} < '{LIMIT}' AS is_test FROM lineitem),
    m AS (SELECT regr_slope(y, x) AS a, regr_intercept(y, x) AS b FROM t WHERE NOT is_test),
    e AS (SELECT y, y - (a * x + b) AS e FROM t, m WHERE is_test),
    s AS (SELECT avg(e * e) AS mse, avg(abs(e)) AS mae, 1 - sum(e * e) / (var_pop(y) * count(*)) AS r2 FROM e)
    SELECT 'linear_regression' AS family, metric, round(value, 3) AS value FROM
    (SELECT 'mse' AS metric, round(mse / 1000) AS value FROM s UNION ALL SELECT 'mae', mae FROM s UNION ALL SELECT 'r2', r2 FROM s)""",
)
def linear_regression_scores(spark, sf_dir):
    """One-feature regression: SQL states the metrics on the test rows (mse in thousands)."""
    df = table(spark, sf_dir, "lineitem").select(*LINE_KEYS, "l_quantity", "l_extendedprice")
    prepared = prepare(df, "l_extendedprice", "regression", keys=LINE_KEYS, exclude=LINE_KEYS)
    metrics, _, model = fit_and_score(prepared, "linear_regression", {})
    shown = {"mse": round(metrics["mse"] / 1000), "mae": metrics["mae"], "r2": metrics["r2"]}
    rows = [(model.family, k, round(float(v), 3)) for k, v in shown.items()]
    return spark.createDataFrame(rows, "family string, metric string, value double")


@query(
    "linear_regression",
    """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
    round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""",
)
def linear_regression(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select("l_quantity", F.col("l_extendedprice").alias("label"))
    packed = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(df)
    model = build_model("linear_regression", {}, "regression", FeatureTable(("l_quantity",), 0)).estimator.fit(packed)
    row = (round(float(model.coefficients[0]), 4), round(float(model.intercept), 2))
    return spark.createDataFrame([row], "slope double, intercept double")


def labelled(spark, sf_dir) -> DataFrame:
    """Documents with their labels, texts included."""
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")


DOC_ROW = DIGEST.format(keys="CAST(doc_id AS VARCHAR)")


@query(
    "dataset_info",
    f"""WITH t AS (SELECT * FROM documents JOIN labels USING (doc_id)),
    tr AS (SELECT * FROM t WHERE {DOC_ROW} >= '{LIMIT}')
    SELECT 'documents' AS dataset, (SELECT count(*) FROM t) AS n_samples, 'quality' AS target_column,
    'n_chars,toxic,' || (SELECT CASE WHEN count(DISTINCT text) < least(1000, count(*)) THEN 'text_encoded,' ELSE '' END FROM t)
        || 'source_encoded,' || (SELECT string_agg('lang_' || lang, ',' ORDER BY lang) FROM (SELECT DISTINCT lang FROM tr)
        WHERE lang > (SELECT min(lang) FROM tr)) AS feature_names,
    (SELECT string_agg(q, ',' ORDER BY q) FROM (SELECT DISTINCT CAST(quality AS VARCHAR) AS q FROM t)) AS target_classes""",
)
def describe_dataset(spark, sf_dir):
    prepared = prepare(labelled(spark, sf_dir), "quality", keys=["doc_id"], exclude=["doc_id"])
    info = dataset_info(prepared, "documents")
    return info.select(
        "dataset",
        "n_samples",
        "target_column",
        F.array_join("feature_names", ",").alias("feature_names"),
        F.array_join("target_classes", ",").alias("target_classes"),
    )


@query("single_experiment")
def single_experiment(spark, sf_dir):
    """One experiment end to end, with the three best features and its run logged."""
    params = {
        "target_column": "quality",
        "model_type": "logistic_regression",
        "model_params": {"max_iter": 100},
        "keys": ["doc_id"],
        "exclude": ["doc_id"],
        "select_features": True,
        "n_features": 3,
    }
    run = run_experiment(labelled(spark, sf_dir), params, "documents")
    return run.select("experiment", "status", F.explode("metrics").alias("metric", "value"))


@query(
    "experiment_steps",
    """SELECT 'FINISHED' AS status, '10,50,90,100' AS progress, 1.0::DOUBLE AS accuracy, CAST(count(*) AS VARCHAR) AS n_samples,
    'random_forest' AS model_type, 'late' AS target_column, 1::BIGINT AS n_logged FROM orders""",
)
def experiment_steps(spark, sf_dir):
    """An experiment whose target is a step of the month: its progress, its score and its logged run."""
    month = F.month("o_orderdate")
    df = table(spark, sf_dir, "orders").select("o_orderkey", month.alias("month"), "o_orderpriority", (month > 6).cast("int").alias("late"))
    path, told = fresh_path(spark, "steps-runs"), []
    params = {
        "target_column": "late",
        "model_type": "random_forest",
        "model_params": {"n_estimators": 20, "max_depth": 5},
        "keys": ["o_orderkey"],
        "exclude": ["o_orderkey"],
    }
    run = run_experiment(df, params, "orders", lambda percent, _: told.append(str(percent)), runs_path=path)
    logged = spark.read.parquet(path).join(run.select("run_id"), "run_id", "left_semi").count()
    return run.select(
        "status",
        F.lit(",".join(told)).alias("progress"),
        F.col("metrics")["accuracy"].alias("accuracy"),
        *[F.col("params")[name].alias(name) for name in ("n_samples", "model_type", "target_column")],
        F.lit(logged).cast("long").alias("n_logged"),
    )


@query(
    "search_deadline",
    "SELECT n AS trial_no, 'timeout' AS status, (SELECT count(*) FROM orders) AS n_samples FROM (VALUES (1), (2), (3)) t(n)",
)
def search_deadline(spark, sf_dir):
    """A search that may take no time: no trial begins, each has its row."""
    df = table(spark, sf_dir, "orders").drop("o_custkey")
    prepared = prepare(df, "o_orderstatus", keys=["o_orderkey"], exclude=["o_orderkey"])
    rows = run_trials(prepared, TR.trial_plan(TR.param_grid(TR.grid_table(spark)), ["logistic_regression"], 3), timeout=0.0)
    return rows.select(F.col("trial_no").cast("int").alias("trial_no"), "status", F.lit(prepared.n_samples).cast("long").alias("n_samples"))


@query("run_log")
def run_log(spark, sf_dir):
    """Two runs appended to a run table and read back."""
    path = fresh_path(spark, "runs")
    df = labelled(spark, sf_dir)
    for family in ("random_forest", "logistic_regression"):
        params = {
            "target_column": "quality",
            "model_type": family,
            "model_params": {"n_estimators": 50} if family == "random_forest" else {"max_iter": 100},
            "keys": ["doc_id"],
            "exclude": ["doc_id"],
        }
        run_experiment(df, params, "documents", runs_path=path)
    runs = spark.read.parquet(path)
    return runs.select("experiment", "status", F.col("params")["model_type"].alias("model_type"), F.col("metrics")["accuracy"].alias("accuracy"))


@query("trial_leaderboard")
def trial_leaderboard(spark, sf_dir):
    """The shipped plan of ten different trials on the labelled documents."""
    return search(labelled(spark, sf_dir), "quality", keys=["doc_id"], exclude=["doc_id"]).leaderboard()


@query(
    "search_winner_scores",
    "SELECT o_orderkey, CAST(extract(month FROM o_orderdate) > 6 AS VARCHAR) AS late, 'true' AS tracked FROM orders",
)
def search_winner_scores(spark, sf_dir):
    """A search whose winner scores the whole table, and whose run is in the run table. The target is a step of the month."""
    orders = table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    df = orders.select("o_orderkey", "month", "o_orderpriority", (F.col("month") > 6).cast("string").alias("late"))
    path = fresh_path(spark, "winner-runs")
    families = ["random_forest", "gradient_boosting"]
    result = search(df, "late", keys=["o_orderkey"], exclude=["o_orderkey"], models=families, n_trials=4, runs_path=path)
    tracked = get_run(spark.read.parquet(path), result.best()).count() == 1
    scored = result.scorer().score(df, keep=["o_orderkey"])
    return scored.select("o_orderkey", F.col("predicted_class").alias("late"), F.lit(str(tracked).lower()).alias("tracked"))


@query(
    "search_results_file",
    "SELECT 'orders' AS data, 'o_orderstatus' AS target, 'classification' AS task, 2::BIGINT AS total_trials, 2::BIGINT AS successful",
)
def search_results_file(spark, sf_dir):
    """Search on orders, with the result header and trials saved and read back."""
    plan = TR.trial_plan(
        TR.param_grid(TR.grid_table(spark, [("LogisticRegression", "logistic_regression", {"C": [0.1, 1.0], "max_iter": [100]})]))
    )
    result = search(table(spark, sf_dir, "orders"), "o_orderstatus", keys=["o_orderkey"], exclude=["o_orderkey", "o_custkey"], plan=plan)
    path = fresh_path(spark, "results")
    save_results(result, "orders", path)
    return spark.read.json(f"{path}/header")


def saved_scorer(spark, sf_dir) -> Scorer:
    prepared = prepare(table(spark, sf_dir, "orders"), "o_orderstatus", keys=["o_orderkey"], exclude=["o_orderkey", "o_custkey"])
    _, fitted, _ = fit_and_score(prepared, "logistic_regression", {"max_iter": 100})
    path = fresh_path(spark, "scorer")
    save_scorer(spark, prepared, fitted, path)
    return Scorer.load(spark, path)


@query("score_batch")
def score_batch(spark, sf_dir):
    scored = saved_scorer(spark, sf_dir).score(table(spark, sf_dir, "orders"), keep=["o_orderkey"])
    return scored.select("o_orderkey", "predicted_class")


@query("score_stream")
def score_stream(spark, sf_dir):
    """Orders arriving as files, scored by a saved model."""
    base = fresh_path(spark, "score-stream")
    orders = table(spark, sf_dir, "orders")
    orders.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(orders.schema).parquet(f"{base}/in")
    scorer = saved_scorer(spark, sf_dir)
    scorer.score_stream(stream, f"{base}/out", f"{base}/state", keep=["o_orderkey"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("o_orderkey", "predicted_class")
