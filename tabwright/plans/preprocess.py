"""The preprocessing plan: column roles, fit on one table, projection of any other."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions.schema import RESERVED, TEXT, quoted, refuse_reserved, type_class
from tabwright.functions.values import label_text
from tabwright.operators.encode import FittedStats, apply_stats, feature_names, fit_stats, label_codes
from tabwright.operators.features import PASSENGER_RULES, USED_UP, Rule, extract_features, rules_from_data, rules_to_data
from tabwright.operators.profile import BINARY_MAX, ENCODE_MAX, profile
from tabwright.operators.target import TARGET_NAMES, detect_task, infer_target


LABEL = f"{RESERVED}label"


@dataclass
class ColumnRoles:
    """What becomes of every column."""

    target: str
    task: str
    numeric: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    coded: list[str] = field(default_factory=list)
    dropped: list[str] = field(default_factory=list)


def _rows(profiled: DataFrame) -> list:
    return sorted(profiled.collect(), key=lambda r: r["pos"])  # one row per column


def choose_roles(
    df: DataFrame,
    target: str | None = None,
    task: str = "auto",
    rules: Sequence[Rule] = PASSENGER_RULES,
    exclude: Sequence[str] = (),
    string_categoricals: str = "onehot",
    encoded: bool = True,
    target_names: Sequence[str] = TARGET_NAMES,
) -> ColumnRoles:
    """Decide the target, the task and the role of every column.

    Texts of at most 10 values get one-hot columns, texts of 11 to 999 values a
    code, longer ones are dropped. ``string_categoricals='drop'`` and
    ``encoded=False`` leave those columns out.
    """
    refuse_reserved(df.columns)
    candidates = df.drop(*exclude)
    profiled = profile(candidates, distinct="adaptive")
    rows = _rows(profiled)
    if target is None:
        target = infer_target(profiled, names=target_names).first()[0]
    if task == "auto":
        task = detect_task(df, target).first()["task"]

    shaped, applied = extract_features(candidates, rules)
    used = {s for r in applied for s in r.sources if s in USED_UP}
    roles = ColumnRoles(target, task)
    for r in rows:
        name = r["column"]
        if name == target:
            continue
        if name in used or r["kind"] in ("drop", "id", "unsupported"):
            roles.dropped.append(name)
        else:
            _assign(roles, r, type_class(df.schema[name].dataType) == TEXT, string_categoricals, encoded)
    outputs = [r.output for r in applied]
    if outputs:
        by_name = {r["column"]: r for r in _rows(profile(shaped.select(*map(quoted, outputs)), distinct="adaptive"))}
        for rule in applied:
            if rule.kind == "numerical":
                roles.numeric.append(rule.output)
            else:
                _assign(roles, by_name[rule.output], True, string_categoricals, encoded, extracted=True)
    return roles


def _assign(roles: ColumnRoles, r, is_text: bool, string_categoricals: str, encoded: bool, extracted=False):
    name, kind, distinct = r["column"], r["kind"], r["n_distinct"]
    if kind in ("numerical", "binary") and not extracted:
        roles.numeric.append(name)
    elif not is_text:
        roles.categorical.append(name)
    elif distinct <= BINARY_MAX and string_categoricals == "onehot":
        roles.categorical.append(name)
    elif BINARY_MAX < distinct < ENCODE_MAX and encoded:
        roles.coded.append(name)
    else:
        roles.dropped.append(name)


@dataclass
class Preprocessor:
    """Fitted preprocessing: roles, statistics and target classes."""

    roles: ColumnRoles
    stats: FittedStats
    classes: list[str] | None
    rules: Sequence[Rule] = tuple(PASSENGER_RULES)

    @property
    def names(self) -> list[str]:
        return feature_names(self.stats)

    def transform(
        self,
        df: DataFrame,
        keep: Sequence[str] = (),
        label: bool = True,
        vector: str | None = "features",
        label_name: str = "label",
    ) -> DataFrame:
        """``keep`` columns, the label, the named features and their vector.

        A class target becomes the rank of its text, a missing one that of
        ``nan``; rows whose label was not seen in the fit get a null label. A
        feature of the name ``label_name`` or ``vector`` raises: give others.
        """
        taken = {*self.names, *keep} & {*([label_name] if label else []), vector}
        if taken:
            raise ValueError(f"columns of the result would share the names {sorted(taken)}")
        shaped, _ = extract_features(df, self.rules)
        keep = list(keep)
        if label:
            c = F.col(quoted(self.roles.target))
            if self.classes is None:
                value = c.cast("double")
            else:
                text = label_text(c, df.schema[self.roles.target].dataType.simpleString())
                place = F.array_position(F.array(*[F.lit(x) for x in self.classes]), text)
                value = F.when(place > 0, (place - 1).cast("double"))
            shaped = shaped.withColumn(LABEL, value)
            keep.append(LABEL)
        result = apply_stats(shaped, self.stats, keep, vector=vector)
        return result.withColumnRenamed(LABEL, label_name) if label else result

    def save(self, spark: SparkSession, path: str) -> None:
        """Save statistics, roles and feature rules below ``path``."""
        self.stats.save(spark, f"{path}/stats")
        info = {**self.roles.__dict__, "classes": self.classes, "rules": rules_to_data(self.rules)}
        spark.createDataFrame([(json.dumps(info),)], "roles string").coalesce(1).write.text(f"{path}/roles")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Preprocessor:
        info = json.loads(spark.read.text(f"{path}/roles").first()[0])
        classes, rules = info.pop("classes"), rules_from_data(info.pop("rules"))
        return cls(ColumnRoles(**info), FittedStats.load(spark, f"{path}/stats"), classes, tuple(rules))


def fit_preprocessor(
    df: DataFrame,
    roles: ColumnRoles,
    strategy: str = "median",
    rules: Sequence[Rule] = PASSENGER_RULES,
    labels: DataFrame | None = None,
) -> Preprocessor:
    """Fit statistics on ``df`` (the training rows, to avoid leakage).

    The target classes are those of ``labels``, all rows of the table, so that
    no row drops out because its class is rare; by default those of ``df``.
    """
    shaped, _ = extract_features(df, rules)
    stats = fit_stats(shaped, roles.numeric, roles.categorical, strategy, roles.coded)
    classes = None
    if roles.task == "classification":
        source = df if labels is None else labels
        codes, _ = label_codes(source, roles.target)  # a missing label is the class nan
        classes = [r["value"] for r in codes.orderBy("code").collect()]  # every model holds its classes
    return Preprocessor(roles, stats, classes, tuple(rules))
