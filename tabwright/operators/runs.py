"""Tracking tables: experiments, runs, metric history and model versions.

Runs: run_id, experiment, run_name, status, start_time, end_time, metrics map,
params map. History: run_id, key, value, step, seq. All are append-only.
"""

from __future__ import annotations

import datetime
import time
import uuid
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabwright.operators.order import group_rank, hot_key_join

MAX_RESULTS = 100


def tracking_upsert(experiments: DataFrame, names: DataFrame) -> DataFrame:
    """Rows to append: names not yet in the experiment table, once each, with an id.

    The names are made distinct before the join, so a repeated name is one row.
    """
    wanted = names.select("name").filter(F.col("name").isNotNull()).distinct()
    return wanted.join(experiments.select("name"), "name", "left_anti").select(
        F.md5("name").alias("experiment_id"), "name"
    )


def search_runs(
    runs: DataFrame,
    experiment: str,
    predicate: str | Column | None = None,
    max_results: int | None = MAX_RESULTS,
) -> DataFrame:
    """Runs of an experiment, newest first; the predicate is a Column or SQL text.

    It may name ``metrics['x']`` and ``params['x']``. An unknown experiment has no runs.
    """
    found = runs.filter(F.col("experiment") == experiment)
    if predicate is not None:
        found = found.filter(predicate)
    found = found.orderBy(F.col("start_time").desc(), "run_id")
    return found if max_results is None else found.limit(max_results)


def get_run(runs: DataFrame, run_id: str) -> DataFrame:
    return runs.filter(F.col("run_id") == run_id)


def experiment_metrics(
    runs: DataFrame, experiment: str, max_results: int | None = None
) -> DataFrame:
    """Run id, status, times, metrics and parameters of an experiment's runs."""
    return search_runs(runs, experiment, None, max_results).select(
        "run_id", "status", "start_time", "end_time", "metrics", "params"
    )


def _comparable(value: Column, mode: str) -> Column:
    """Whether a run's value may win: a number, and not the worst one there is."""
    return value.isNotNull() & ~F.isnan(value) & (value != (float("-inf") if mode == "max" else float("inf")))


def best_run(
    runs: DataFrame,
    experiment: str,
    metric: str = "accuracy",
    mode: str = "max",
    max_results: int | None = None,
) -> DataFrame:
    """The run with the best value, the newest of equals; runs without a number never win."""
    if mode not in ("max", "min"):
        raise ValueError(f"mode must be 'max' or 'min', not {mode!r}")
    source = runs.filter(F.col("experiment") == experiment)
    if max_results is not None:
        source = source.orderBy(F.col("start_time").desc(), "run_id").limit(max_results)
    value = F.element_at("metrics", metric)
    usable = _comparable(value, mode)
    order = value.desc() if mode == "max" else value.asc()
    return source.filter(usable).orderBy(order, F.col("start_time").desc(), "run_id").limit(1)


def best_runs(runs: DataFrame, metric: str = "accuracy", mode: str = "max") -> DataFrame:
    """:func:`best_run` of every experiment at once, by one partial aggregate."""
    value = F.element_at("metrics", metric)
    place = F.struct(
        (-value if mode == "max" else value).alias("score"),
        F.col("start_time").isNull().alias("undated"),
        (-F.unix_micros(F.col("start_time").cast("timestamp"))).alias("age"),
        F.col("run_id").alias("id"),
    )
    return runs.filter(_comparable(value, mode)).groupBy("experiment").agg(
        F.min_by(F.struct("run_id", value.alias("value")), place).alias("b")
    ).select("experiment", "b.run_id", "b.value")


def metric_history_latest(history: DataFrame) -> DataFrame:
    """Last logged value of each metric of each run, by step, then by order of logging."""
    return history.groupBy("run_id", "key").agg(
        F.max_by("value", F.struct("step", "seq")).alias("value"), F.max("step").alias("step")
    )


def runs_latest(events: DataFrame) -> DataFrame:
    """Runs from their events (run_id, seq, field values): the last non-null value of each field."""
    fields = [c for c in events.columns if c not in ("run_id", "seq")]
    return events.groupBy("run_id").agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c) for c in fields]
    )


def end_run_events(run_ids: DataFrame, status: str = "FINISHED") -> DataFrame:
    """Closing events (run_id, seq, status, end_time) for the given runs."""
    return run_ids.select("run_id", "seq", F.lit(status).alias("status"), F.col("at").alias("end_time"))


def register_models(models: DataFrame, new: DataFrame) -> DataFrame:
    """Rows to append: ``new`` (name, run_id, source, created_at) with the next versions per name.

    A name may hold any share of the new rows: they are numbered by a
    distributed sort, not in one window. A name must be given.
    """
    new = new.withColumn("name", F.coalesce("name", F.raise_error(F.lit("a model version needs a name")).cast("string")))
    numbered = group_rank(new, "name", [F.col("created_at"), F.col("run_id")], "_place")
    taken = models.groupBy("name").agg(F.max("version").alias("_taken"))
    sizes = new.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    base = sizes.join(taken, "name", "left").fillna(0, ["_taken"])
    return (
        hot_key_join(numbered, base, "name", "_n")
        .withColumn("version", F.col("_taken") + F.col("_place"))
        .drop("_taken", "_place", "_n")
    )


RUN_EVENTS = (
    "run_id string, seq long, experiment string, run_name string, status string, start_time timestamp, end_time timestamp"
)
PARAMS = "run_id string, key string, value string, seq long"
HISTORY = "run_id string, key string, value double, step long, seq long"
VERSIONS = "name string, version long, run_id string, source string, created_at timestamp"


class Tracking:
    """Writers over the tracking tables below a folder; every call appends one small file.

    One writer per run is assumed: events are put in order by the writer's clock.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, table: str, schema: str, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.path}/{table}")

    def _read(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")
        except AnalysisException:  # nothing written yet
            return self.spark.createDataFrame([], schema)

    def start_run(self, experiment: str, run_name: str | None = None) -> str:
        run_id, now = uuid.uuid4().hex, datetime.datetime.now(datetime.timezone.utc)
        self._append("events", RUN_EVENTS, [(run_id, time.time_ns(), experiment, run_name, "RUNNING", now, None)])
        return run_id

    def end_run(self, run_id: str, status: str = "FINISHED") -> None:
        now = datetime.datetime.now(datetime.timezone.utc)
        self._append("events", RUN_EVENTS, [(run_id, time.time_ns(), None, None, status, None, now)])

    def log_params(self, run_id: str, params: dict[str, Any]) -> None:
        self._append("params", PARAMS, [(run_id, k, str(v), time.time_ns()) for k, v in params.items()])

    def log_metrics(self, run_id: str, metrics: dict[str, float], step: int = 0) -> None:
        self._append("history", HISTORY, [(run_id, k, float(v), step, time.time_ns()) for k, v in metrics.items()])

    def history(self) -> DataFrame:
        return self._read("history", HISTORY)

    def runs(self) -> DataFrame:
        """Runs with the last value of each metric and parameter."""
        metrics = metric_history_latest(self.history()).groupBy("run_id").agg(
            F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("metrics")
        )
        params = self._read("params", PARAMS).groupBy("run_id", "key").agg(F.max_by("value", "seq").alias("value"))
        params = params.groupBy("run_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("params"))
        return runs_latest(self._read("events", RUN_EVENTS)).join(metrics, "run_id", "left").join(params, "run_id", "left")

    def register_model(self, name: str, run_id: str, source: str) -> int:
        """Append the next version of a model and return its number."""
        taken = self.versions().filter(F.col("name") == name).agg(F.max("version")).first()[0] or 0
        self._append(
            "versions", VERSIONS, [(name, taken + 1, run_id, source, datetime.datetime.now(datetime.timezone.utc))]
        )
        return taken + 1

    def versions(self) -> DataFrame:
        return self._read("versions", VERSIONS)
