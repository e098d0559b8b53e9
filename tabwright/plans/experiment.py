"""One experiment: prepare a table once, train a family on it, score it, log the run."""

from __future__ import annotations

import datetime
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabwright.functions.schema import RESERVED, quoted
from tabwright.operators.knn import knn_predict
from tabwright.operators.metrics import evaluate
from tabwright.operators.profile import profile, profile_summary
from tabwright.operators.models import FeatureTable, Model, build_model
from tabwright.operators.select import select_k_best, selected_features
from tabwright.operators.split import hash_split
from tabwright.operators.features import PASSENGER_RULES, Rule
from tabwright.plans.preprocess import LABEL, Preprocessor, choose_roles, fit_preprocessor
from tabwright.session import written

RUN_SCHEMA = (
    "run_id string, experiment string, run_name string, status string, start_time timestamp, "
    "end_time timestamp, metrics map<string,double>, params map<string,string>, model_path string"
)

# Columns of a prepared table beside its named features, which may have any other name.
IS_TEST, FEATURES, ROW_ID = f"{RESERVED}is_test", f"{RESERVED}features", f"{RESERVED}row_id"

# Options of `prepare` that an experiment or a search passes on as they are.
PREPARE_OPTIONS = ("strategy", "fit_on", "rules", "string_categoricals", "encoded", "method")


def run_experiment_schema(spark: SparkSession):
    """The schema of a run table."""
    return spark.createDataFrame([], RUN_SCHEMA).schema


# User-defined families: name -> function(params, task, FeatureTable) returning an estimator.
CUSTOM_FAMILIES: dict[str, Callable] = {}


def register_family(name: str, build: Callable) -> None:
    """Add a family whose estimator ``build(params, task, table)`` returns."""
    CUSTOM_FAMILIES[name] = build


@dataclass
class Prepared:
    """A feature table split into train and test rows, shared by all trials."""

    table: DataFrame
    preprocessor: Preprocessor
    names: list[str]
    n_samples: int
    n_train: int
    n_unlabelled: int = 0

    @property
    def train(self) -> DataFrame:
        return self.table.filter(~F.col(IS_TEST))

    @property
    def test(self) -> DataFrame:
        return self.table.filter(F.col(IS_TEST))

    @staticmethod
    def vectors(rows: DataFrame) -> DataFrame:
        """(row_id, label, features) of ``train`` or ``test``: what estimators read, whatever the source columns are called."""
        shown = zip((ROW_ID, LABEL, FEATURES), ("row_id", "label", "features"))
        return rows.select(*[F.col(c).alias(name) for c, name in shown])

    @property
    def task(self) -> str:
        return self.preprocessor.roles.task

    @cached_property
    def variance(self) -> float:
        """Variance of all entries of the training features, as one population."""
        sums = [
            F.struct(F.avg(F.col(quoted(n))).alias("m"), F.var_pop(F.col(quoted(n))).alias("v")).alias(f"s{i}")
            for i, n in enumerate(self.names)
        ]
        row = self.train.agg(*sums).first()
        means = [row[f"s{i}"]["m"] for i in range(len(self.names))]
        grand = sum(means) / len(means)
        return sum(row[f"s{i}"]["v"] + (m - grand) ** 2 for i, m in enumerate(means)) / len(means)

    def description(self, with_variance: bool = False) -> FeatureTable:
        classes = self.preprocessor.classes
        return FeatureTable(
            tuple(self.names),
            self.n_train,
            len(classes) if classes else 0,
            self.variance if with_variance else 1.0,
        )


def prepare(
    df: DataFrame,
    target: str | None = None,
    task: str = "auto",
    keys: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    select_features: bool = False,
    k: int = 10,
    strategy: str = "median",
    fit_on: str = "train",
    exclude: Sequence[str] = (),
    rules: Sequence[Rule] = PASSENGER_RULES,
    string_categoricals: str = "onehot",
    encoded: bool = True,
    method: str = "f_classif",
) -> Prepared:
    """Profile, split, write what is used once, fit on that and project.

    ``keys`` identify a row for the split (all columns by default). Statistics
    and selection are fitted on the training rows; ``fit_on='all'`` uses all.
    Target classes are those of all rows; rows without a class are of the class
    ``nan``. Rows without a number to regress on are left out and counted in
    ``n_unlabelled``. ``method`` ranks the features to select.
    """
    if fit_on not in ("train", "all"):
        raise ValueError(f"fit_on must be 'train' or 'all', not {fit_on!r}")
    roles = choose_roles(
        df, target, task, rules=rules, exclude=exclude, string_categoricals=string_categoricals, encoded=encoded
    )
    sources = {s for r in rules for s in r.sources}
    used = sources.union(roles.numeric, roles.categorical, roles.coded, [roles.target])
    split = hash_split(df, list(keys or df.columns), test_size, seed, output=IS_TEST)
    # no fit reads the source, its other columns or the split digest again
    marked = written(split.select(*[quoted(c) for c in df.columns if c in used], IS_TEST), "split")
    basis = marked.filter(~F.col(IS_TEST)) if fit_on == "train" else marked
    fitted = fit_preprocessor(basis, roles, strategy, rules, marked)
    table = fitted.transform(marked, [IS_TEST], vector=FEATURES, label_name=LABEL).filter(F.col(LABEL).isNotNull())
    names = fitted.names
    # the written table fixes the row numbers and spares every trial the preparation
    table = written(table.withColumn(ROW_ID, F.monotonically_increasing_id()), "features")
    if select_features and len(names) > k:
        rows = table.filter(~F.col(IS_TEST)) if fit_on == "train" else table
        names = selected_features(select_k_best(rows, names, LABEL, k, method=method, task=roles.task))
        table = _reassemble(table, names)
    counts = table.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(IS_TEST)).alias("train")).first()
    return Prepared(table, fitted, names, counts["n"], counts["train"], marked.count() - counts["n"])


def _reassemble(table: DataFrame, names: Sequence[str]) -> DataFrame:
    """Feature vector of the chosen columns only."""
    kept = table.select(ROW_ID, IS_TEST, LABEL, *[quoted(n) for n in names])
    safe = [f"_f{i}" for i in range(len(names))]
    plain = kept.toDF(ROW_ID, IS_TEST, LABEL, *safe)
    packed = VectorAssembler(inputCols=safe, outputCol=FEATURES).transform(plain)
    return packed.toDF(ROW_ID, IS_TEST, LABEL, *names, FEATURES)


def dataset_info(prepared: Prepared, name: str, source: DataFrame | None = None) -> DataFrame:
    """One row describing a prepared table; with its ``source`` also ``summary``, the profile's figures as JSON."""
    if source is not None:
        roles = prepared.preprocessor.roles
        summary = profile_summary(profile(source, distinct="adaptive"), roles.target)
        plain = summary.select(F.to_json(F.struct(*summary.columns)).alias("summary"))
        return dataset_info(prepared, name).join(plain)  # one row and one row
    spark = prepared.table.sparkSession
    roles, classes = prepared.preprocessor.roles, prepared.preprocessor.classes
    shown = classes if classes is not None and len(classes) <= 20 else None
    row = (
        name,
        prepared.n_samples,
        len(prepared.names),
        prepared.names,
        roles.target,
        shown,
        "classes" if shown is not None else "regression",
    )
    return spark.createDataFrame(
        [row],
        "dataset string, n_samples long, n_features int, feature_names array<string>, "
        "target_column string, target_classes array<string>, target_type string",
    )


def fit_and_score(
    prepared: Prepared, family: str, params: dict[str, Any], model: Model | None = None
) -> tuple[dict[str, float], Transformer | None, Model]:
    """Train one family on the training rows and score the test rows."""
    needs_variance = family in ("svm", "svr") and params.get("kernel", "rbf") == "rbf"
    description = prepared.description(needs_variance)
    if family in CUSTOM_FAMILIES:
        estimator = CUSTOM_FAMILIES[family](params, prepared.task, description)
        model = Model(family, prepared.task, estimator, dict(params))
    else:
        model = model or build_model(family, params, prepared.task, description)
    train, test = prepared.vectors(prepared.train), prepared.vectors(prepared.test)
    if model.estimator is None:
        fitted = None
        scored = knn_predict(
            test,
            train,
            "label",
            model.used["n_neighbors"],
            id_col="row_id",
            metric=model.used["metric"],
            weights=model.used["weights"],
            task=prepared.task,
        ).join(test.select("row_id", "label"), "row_id")
    else:
        # the named columns stay out: MLlib cannot read names that hold a dot
        fitted = model.estimator.fit(train.drop("row_id"))
        scored = fitted.transform(test.drop("row_id"))
    # rows are counted by a metric aggregate: one row per metric comes back
    metrics = {r["metric"]: r["value"] for r in evaluate(scored, "label", "prediction", prepared.task).collect()}
    return metrics, fitted, model


def run_experiment(
    df: DataFrame,
    params: dict[str, Any],
    experiment: str = "default",
    progress: Callable[[int, str], None] | None = None,
    runs_path: str | None = None,
    model_path: str | None = None,
) -> DataFrame:
    """Run one experiment and return its run as one row.

    ``params`` takes target_column, task, model_type, model_params, test_size,
    random_state, select_features, n_features, keys, exclude, and the names in
    ``PREPARE_OPTIONS``.
    """
    spark = df.sparkSession
    tell = progress or (lambda percent, message: None)
    started = datetime.datetime.now(datetime.timezone.utc)
    tell(10, "preparing features")
    prepared = prepare(
        df,
        params.get("target_column"),
        params.get("task", "auto"),
        params.get("keys"),
        params.get("test_size", 0.2),
        params.get("random_state", 42),
        params.get("select_features", False),
        params.get("n_features", 10),
        exclude=params.get("exclude", ()),
        **{name: params[name] for name in PREPARE_OPTIONS if name in params},
    )
    tell(50, f"training on {prepared.n_train} of {prepared.n_samples} rows")
    family = params.get("model_type", "auto")
    given = {"random_state": params.get("random_state", 42), **params.get("model_params", {})}
    metrics, fitted, model = fit_and_score(prepared, family, given)
    tell(90, "scored the test rows")
    if model_path:
        save_scorer(spark, prepared, fitted if fitted is not None else neighbours(prepared, model), model_path)
    logged = {
        **{k: str(v) for k, v in params.items() if k not in ("model_params", "rules")},
        **{k: str(v) for k, v in model.used.items()},
        "target_column": prepared.preprocessor.roles.target,
        "model_type": model.family,
        "n_samples": str(prepared.n_samples),
        "n_unlabelled": str(prepared.n_unlabelled),
        "n_features": str(len(prepared.names)),
    }
    row = (
        uuid.uuid4().hex,
        experiment,
        f"{experiment}-{int(time.time())}",
        "FINISHED",
        started,
        datetime.datetime.now(datetime.timezone.utc),
        metrics,
        logged,
        model_path,
    )
    run = spark.createDataFrame([row], RUN_SCHEMA)
    if runs_path:
        run.write.mode("append").parquet(runs_path)
    tell(100, "done")
    return run


@dataclass
class Neighbours:
    """The neighbour model: its settings and the training rows it looks in."""

    train: DataFrame
    k: int
    metric: str
    weights: str
    task: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` (with a features vector) and its ``prediction``."""
        rows = written(df.withColumn("row_id", F.monotonically_increasing_id()), "neighbour-rows")
        found = knn_predict(
            rows, self.train, "label", self.k, id_col="row_id", metric=self.metric, weights=self.weights, task=self.task
        )
        return rows.join(found.select("row_id", "prediction"), "row_id").drop("row_id")

    def save(self, spark: SparkSession, path: str) -> None:
        self.train.select("row_id", "label", "features").write.parquet(f"{path}/neighbours/train")
        settings = [(self.k, self.metric, self.weights, self.task)]
        frame = spark.createDataFrame(settings, "k int, metric string, weights string, task string")
        frame.coalesce(1).write.parquet(f"{path}/neighbours/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Neighbours | None:
        """The saved model, or None where ``path`` holds a model of another family."""
        try:
            s = spark.read.parquet(f"{path}/neighbours/settings").first()
        except AnalysisException:
            return None
        return cls(spark.read.parquet(f"{path}/neighbours/train"), s["k"], s["metric"], s["weights"], s["task"])


def neighbours(prepared: Prepared, model: Model) -> Neighbours:
    used = model.used
    return Neighbours(prepared.vectors(prepared.train), used["n_neighbors"], used["metric"], used["weights"], prepared.task)


def save_scorer(spark: SparkSession, prepared: Prepared, fitted: Transformer | Neighbours, path: str) -> None:
    """Save the fitted statistics, the chosen features and the model below ``path``."""
    prepared.preprocessor.save(spark, f"{path}/preprocess")
    spark.createDataFrame([(n,) for n in prepared.names], "name string").coalesce(1).write.parquet(f"{path}/names")
    if isinstance(fitted, Neighbours):
        fitted.save(spark, path)
        return
    pipeline = fitted if isinstance(fitted, PipelineModel) else PipelineModel([fitted])
    pipeline.write().overwrite().save(f"{path}/model")
