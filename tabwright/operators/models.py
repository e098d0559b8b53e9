"""Model families: parameters mapped to MLlib estimators.

Where MLlib lacks a parameter or a method the gap is stated beside the family
and the parameter is reported as dropped.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field
from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.binned import EqualBinsAsOne
from tabwright.operators.boosting import HistogramBooster
from tabwright.operators.forest import DeepForest
from tabwright.operators.fourier import COMPONENTS, FourierFeatures
from tabwright.operators.fourier_fit import WaveMachine
from tabwright.operators.penalised import PenalisedLogistic
from tabwright.operators.support import DualSupport
from tabwright.session import written

# The search space, in search order.
GRIDS = [
    (
        "RandomForest",
        "random_forest",
        {
            "n_estimators": [50, 100, 200],
            "max_depth": [3, 5, 10, None],
            "min_samples_split": [2, 5, 10],
            "min_samples_leaf": [1, 2, 4],
        },
    ),
    (
        "GradientBoosting",
        "gradient_boosting",
        {
            "n_estimators": [50, 100, 200],
            "max_depth": [3, 5, 7],
            "learning_rate": [0.01, 0.1, 0.2],
            "min_samples_split": [2, 5],
        },
    ),
    (
        "XGBoost",
        "xgboost",
        {
            "n_estimators": [50, 100, 200],
            "max_depth": [3, 5, 7],
            "learning_rate": [0.01, 0.1, 0.2],
            "subsample": [0.8, 1.0],
            "colsample_bytree": [0.8, 1.0],
        },
    ),
    (
        "LightGBM",
        "lightgbm",
        {
            "n_estimators": [50, 100, 200],
            "max_depth": [3, 5, 7],
            "learning_rate": [0.01, 0.1, 0.2],
            "num_leaves": [20, 31, 50],
            "subsample": [0.8, 1.0],
        },
    ),
    (
        "LogisticRegression",
        "logistic_regression",
        {
            "C": [0.01, 0.1, 1.0, 10.0],
            "solver": ["lbfgs", "liblinear"],
            "max_iter": [100, 200, 500],
        },
    ),
    (
        "SVM",
        "svm",
        {
            "C": [0.1, 1.0, 10.0],
            "kernel": ["rbf", "linear"],
            "gamma": ["scale", "auto"],
        },
    ),
    (
        "KNN",
        "knn",
        {
            "n_neighbors": [3, 5, 7, 11],
            "weights": ["uniform", "distance"],
            "metric": ["euclidean", "manhattan"],
        },
    ),
]

# Penalties of the second-order booster where none are given.
NEWTON_DEFAULTS = {"reg_lambda": 1.0, "gamma": 0.0, "min_child_weight": 1.0}
LEAF_MIN_ROWS, LEAF_MIN_CURVATURE = 20, 1e-3  # of the leaf-wise booster

DEFAULT_TREES = 100
DEFAULT_SEED = 42
MAX_DEPTH = 30  # deepest tree MLlib builds; stands for "no limit"
PER_CLASS_PARALLEL = 4
REPEATS = 4  # rows to a different one from which equal rows are trained on as one
NORMAL_SOLVER_FEATURES = 4096
STORED_ROWS = 200_000  # training rows whose Fourier features MLlib may store: 200 MB
DUAL_ROWS = 20_000  # training rows up to which a Gaussian kernel is solved exactly unless asked otherwise

CLASSIFIERS = [
    "random_forest",
    "gradient_boosting",
    "logistic_regression",
    "svm",
    "knn",
    "xgboost",
    "lightgbm",
]
REGRESSORS = [
    "random_forest",
    "gradient_boosting",
    "linear_regression",
    "svr",
    "knn",
    "xgboost",
    "lightgbm",
]


@dataclass(frozen=True)
class FeatureTable:
    """What an estimator must know of its training table."""

    names: tuple[str, ...]
    n_train: int
    n_classes: int = 2
    variance: float = 1.0
    features: str = "features"
    label: str = "label"


@dataclass
class Model:
    """An estimator, or the settings of the neighbour model, with its parameters."""

    family: str
    task: str
    estimator: Estimator | None
    used: dict[str, Any]
    dropped: list[str] = field(default_factory=list)


class EqualRowsAsOne(Estimator, HasFeaturesCol, HasLabelCol):
    """Fit ``learner``, which draws no rows, to the different rows, weighted by their number, where rows repeat.

    The model is the learner's own.
    """

    @keyword_only
    def __init__(self, *, learner=None, featuresCol="features", labelCol="label"):
        super().__init__()
        self.learner = learner
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, dataset: DataFrame):
        features, label = self.getFeaturesCol(), self.getLabelCol()
        rows = dataset.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("x", "y")).alias("different")).first()
        if size["n"] < REPEATS * max(size["different"], 1):
            return self.learner.fit(dataset)
        weighted = rows.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("rows"))
        weighted = written(weighted.select(array_to_vector("x").alias(features), F.col("y").alias(label), "rows"), "equal-rows")
        return self.learner.copy({self.learner.weightCol: "rows"}).fit(weighted)


def family_for(family: str, task: str) -> str:
    """Family that is trained; an unknown name falls back to the forest."""
    known = CLASSIFIERS if task == "classification" else REGRESSORS
    return family if family in known else "random_forest"


def effective_params(family: str, params: dict[str, Any], task: str = "classification") -> tuple[dict, list[str]]:
    """(parameters that take effect, names of those that do not)."""
    family = family_for(family, task)
    p = dict(params)
    used: dict[str, Any] = {}
    engine = p.pop("engine", None)
    if engine not in (None, "mllib"):
        raise ValueError(f"unknown engine {engine!r}")
    if engine:
        used["engine"] = engine
    if family == "random_forest":
        used["n_estimators"] = int(p.pop("n_estimators", DEFAULT_TREES))
        depth = p.pop("max_depth", None)
        if engine:
            used["max_depth"] = MAX_DEPTH if depth is None else min(int(depth), MAX_DEPTH)
        else:
            used["max_depth"] = int(depth or 0)  # 0: no limit
            used["min_samples_split"] = int(p.pop("min_samples_split", 2))
        used["min_samples_leaf"] = int(p.pop("min_samples_leaf", 1))
    elif family in ("gradient_boosting", "xgboost", "lightgbm"):
        used["n_estimators"] = int(p.pop("n_estimators", DEFAULT_TREES))
        depth = int(p.pop("max_depth", None) or {"gradient_boosting": 3, "xgboost": 6, "lightgbm": MAX_DEPTH}[family])
        if family == "lightgbm":
            leaves = int(p.pop("num_leaves", 31))
            if engine:
                depth = min(depth, math.ceil(math.log2(leaves)))
            else:
                used["num_leaves"] = leaves
        used["max_depth"] = depth
        used["learning_rate"] = float(p.pop("learning_rate", 0.3 if family == "xgboost" else 0.1))
        if family == "xgboost":
            used["subsample"] = float(p.pop("subsample", 1.0))
            used["colsample_bytree"] = float(p.pop("colsample_bytree", 1.0))
            if not engine:
                used |= {name: float(p.pop(name, value)) for name, value in NEWTON_DEFAULTS.items()}
    elif family == "logistic_regression":
        used["C"] = float(p.pop("C", 1.0))
        used["max_iter"] = int(p.pop("max_iter", 100))
        used["solver"] = p.pop("solver", "lbfgs")
        used["penalty"] = p.pop("penalty", "l2")
        if used["solver"] not in ("lbfgs", "liblinear") or used["penalty"] not in ("l1", "l2"):
            raise ValueError(f"unknown solver {used['solver']!r} or penalty {used['penalty']!r}")
    elif family in ("svm", "svr"):
        used["C"] = float(p.pop("C", 1.0))
        used["kernel"] = p.pop("kernel", "rbf")
        if used["kernel"] == "rbf":
            used["gamma"] = p.pop("gamma", "scale")
            if "solver" in p:
                used["solver"] = p.pop("solver")
                if used["solver"] not in ("dual", "fourier"):
                    raise ValueError(f"unknown solver {used['solver']!r}")
        if family == "svr":
            used["epsilon"] = float(p.pop("epsilon", 0.1))
        used["max_iter"] = int(p.pop("max_iter", 100))
    elif family == "knn":
        used["n_neighbors"] = int(p.pop("n_neighbors", 5))
        used["weights"] = p.pop("weights", "uniform")
        used["metric"] = p.pop("metric", "euclidean")
    seed = p.pop("random_state", DEFAULT_SEED)
    if family in ("random_forest", "gradient_boosting", "xgboost", "lightgbm", "svm", "svr"):
        used["random_state"] = int(seed)
    return used, sorted(p)


def _gamma(gamma: Any, table: FeatureTable) -> float:
    """Kernel width: 1/(d var X) for ``scale``, 1/d for ``auto``, or the number given."""
    d = max(len(table.names), 1)
    named = {"scale": 1.0 / (d * (table.variance or 1.0)), "auto": 1.0 / d}
    return float(named.get(gamma, gamma))


def _per_class(classifier: Estimator, table: FeatureTable, features: str) -> Estimator:
    """Two-class learners are wrapped one-vs-rest where the target has more classes, a few models at a time."""
    if table.n_classes <= 2:
        return classifier
    return OneVsRest(
        classifier=classifier, featuresCol=features, labelCol=table.label, parallelism=PER_CLASS_PARALLEL
    )


def _solved_in_dual(used: dict[str, Any], table: FeatureTable) -> bool:
    """The dual is as large as its carriers, often a share of the rows, so it is left to tables of ``DUAL_ROWS`` unless asked for."""
    return used.get("solver", "dual" if table.n_train <= DUAL_ROWS else "fourier") == "dual"


def _boost_settings(family: str, used: dict[str, Any], classify: bool, table: FeatureTable) -> dict[str, Any]:
    """Settings of the histogram booster that stands for a family."""
    many = table.n_classes > 2
    settings = {
        "objective": ("softmax" if many else "binary") if classify else "squared",
        "outputs": table.n_classes if classify and many else 1,
        "rounds": used["n_estimators"],
        "learning_rate": used["learning_rate"],
        "max_depth": 0 if used["max_depth"] == MAX_DEPTH else used["max_depth"],
    }
    if family == "xgboost":
        settings |= {
            "l2": used["reg_lambda"],
            "min_gain": used["gamma"],
            "min_curvature": used["min_child_weight"],
            "subsample": used["subsample"],
            "column_share": used["colsample_bytree"],
            "prior": False,
        }
    elif family == "lightgbm":
        settings |= {"num_leaves": used["num_leaves"], "l2": 0.0, "min_rows": LEAF_MIN_ROWS, "min_curvature": LEAF_MIN_CURVATURE}
    else:
        settings |= {"second_order": False}
    return settings


def build_model(family: str, params: dict[str, Any], task: str, table: FeatureTable) -> Model:
    """Estimator of a family.

    ``xgboost`` is second-order boosting by level, ``lightgbm`` by best leaf, and
    ``gradient_boosting`` over more than two classes one joint booster; with
    ``engine="mllib"`` all three are MLlib's first-order booster, one per class.
    A Gaussian kernel is solved in the dual, with the epsilon tube for
    regression, up to ``DUAL_ROWS`` training rows or with ``solver="dual"``;
    beyond, or with ``solver="fourier"``, by random Fourier features and a Huber
    loss; above ``STORED_ROWS`` training rows the features are drawn anew in each
    pass, for the same objective. A forest without a depth limit, or with ``min_samples_split``, is grown
    to the end below MLlib's top. Gaps: boosting knows no ``min_samples_split``
    and splits by histogram. ``solver="liblinear"`` of the logistic family
    penalises the intercept too; ``penalty="l1"`` works with both solvers.
    """
    family = family_for(family, task)
    used, dropped = effective_params(family, params, task)
    common = {"featuresCol": table.features, "labelCol": table.label}
    classify = task == "classification"
    if family == "random_forest" and (not 0 < used["max_depth"] <= MAX_DEPTH or used.get("min_samples_split", 2) > 2):
        settings = {
            "trees": used["n_estimators"],
            "classes": max(table.n_classes, 2) if classify else 0,
            "min_split": used["min_samples_split"],
            "min_leaf": used["min_samples_leaf"],
            "max_depth": used["max_depth"],
        }
        estimator = DeepForest(settings=json.dumps(settings), seed=used["random_state"], **common)
    elif family == "random_forest":
        make = RandomForestClassifier if classify else RandomForestRegressor
        estimator = make(
            numTrees=used["n_estimators"],
            maxDepth=used["max_depth"],
            minInstancesPerNode=used["min_samples_leaf"],
            featureSubsetStrategy="sqrt" if classify else "all",
            seed=used["random_state"],
            **common,
        )
        if not classify:
            estimator = EqualBinsAsOne(learner=estimator, draws=True, **common)
    elif "engine" not in used and (family in ("xgboost", "lightgbm") or family == "gradient_boosting" and classify and table.n_classes > 2):
        estimator = HistogramBooster(plan=json.dumps(_boost_settings(family, used, classify, table)), seed=used["random_state"], **common)
    elif family in ("gradient_boosting", "xgboost", "lightgbm"):
        make = GBTClassifier if classify else GBTRegressor
        estimator = make(
            maxIter=used["n_estimators"],
            maxDepth=used["max_depth"],
            stepSize=used["learning_rate"],
            subsamplingRate=used.get("subsample", 1.0),
            featureSubsetStrategy=str(used.get("colsample_bytree", "all")).replace("1.0", "all"),
            seed=used["random_state"],
            **common,
        )
        if classify:
            estimator = _per_class(estimator, table, table.features)
        if used.get("subsample", 1.0) >= 1.0:
            plain = EqualRowsAsOne(learner=estimator, **common)
            estimator = plain if classify else EqualBinsAsOne(learner=estimator, plain=plain, **common)
    elif family == "logistic_regression":
        settings = {
            "regParam": 1.0 / (used["C"] * table.n_train),
            "elasticNetParam": 1.0 if used["penalty"] == "l1" else 0.0,
            "standardization": False,
            "maxIter": used["max_iter"],
        }
        if used["solver"] == "lbfgs":
            estimator = LogisticRegression(**settings, **common)
        else:
            own = {"c": used["C"], "l1": used["penalty"] == "l1", "steps": used["max_iter"], "classes": table.n_classes}
            estimator = PenalisedLogistic(settings=json.dumps(own), **common)
    elif family == "linear_regression":
        solver = "normal" if len(table.names) <= NORMAL_SOLVER_FEATURES else "l-bfgs"
        estimator = LinearRegression(regParam=0.0, solver=solver, **common)
    elif family in ("svm", "svr") and used["kernel"] == "rbf" and _solved_in_dual(used, table):
        estimator = DualSupport(
            c=used["C"], gamma=_gamma(used["gamma"], table), epsilon=used.get("epsilon"), classes=table.n_classes or 2, **common
        )
    elif family in ("svm", "svr") and used["kernel"] == "rbf" and table.n_train > STORED_ROWS:
        settings = {
            "dim": len(table.names),
            "gamma": _gamma(used["gamma"], table),
            "seed": used["random_state"],
            "components": COMPONENTS,
            "reg": 1.0 / (used["C"] * table.n_train),
            "steps": used["max_iter"],
            "classes": max(table.n_classes, 2) if family == "svm" else 0,
        }
        estimator = WaveMachine(settings=json.dumps(settings), **common)
    elif family in ("svm", "svr"):
        stages, features = [], table.features
        if used["kernel"] == "rbf":
            features = "_fourier"
            stages = [
                FourierFeatures(
                    inputCol=table.features,
                    outputCol=features,
                    dim=len(table.names),
                    gamma=_gamma(used["gamma"], table),
                    seed=used["random_state"],
                )
            ]
        reg = 1.0 / (used["C"] * table.n_train)
        shared = {"featuresCol": features, "labelCol": table.label, "standardization": False, "maxIter": used["max_iter"]}
        if family == "svm":
            last = _per_class(LinearSVC(regParam=reg, **shared), table, features)
        else:
            last = LinearRegression(loss="huber", regParam=reg, **shared)
        estimator = Pipeline(stages=[*stages, last])
    else:
        estimator = None  # neighbours: nothing to train
    return Model(family, task, estimator, used, dropped)
