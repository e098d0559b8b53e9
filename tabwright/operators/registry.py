"""Experiment registry as an append-only event table.

An event carries the fields it changes; the rest is null. The current state of
an experiment is, per field, the value of its last event that has one. Every
aggregate here is partial, so an experiment with a third of all events costs no
more than any other.
"""

from __future__ import annotations

import json
import time
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.window import Window

EVENT_SCHEMA = (
    "id string, seq long, at timestamp, created boolean, deleted boolean, name string, status string, "
    "model_type string, metrics map<string,double>, parameters map<string,string>, artifacts_path string, "
    "run_id string, container_id string, deployed_endpoint string, error string, cleared array<string>"
)
FIELDS = [
    "name",
    "status",
    "model_type",
    "metrics",
    "parameters",
    "artifacts_path",
    "run_id",
    "container_id",
    "deployed_endpoint",
    "error",
]

# The states of an experiment and those that end a watch.
STATUSES = ["pending", "running", "completed", "failed", "stopped", "deployed"]
TERMINAL = ["completed", "failed", "stopped"]


def latest(events: DataFrame) -> DataFrame:
    """Current experiments: created, not deleted, each field at its last value; an event may clear fields.

    Of experiments created under one name by two writers at once, the one created first keeps it: ``by_name``.
    """
    seq = F.col("seq")

    def told(field):
        given = F.col(field).isNotNull()
        return given | F.coalesce(F.array_contains("cleared", field), F.lit(False)) if "cleared" in events.columns else given

    state = events.groupBy("id").agg(
        F.min(F.when(F.col("created"), F.col("at"))).alias("created_at"),
        F.max("at").alias("updated_at"),
        F.max(F.coalesce(F.col("deleted"), F.lit(False))).alias("gone"),
        *[F.max_by(c, F.when(told(c), seq)).alias(c) for c in FIELDS],
    )
    return state.filter(F.col("created_at").isNotNull() & ~F.col("gone")).drop("gone")


def create_events(current: DataFrame, requests: DataFrame) -> DataFrame:
    """Create events for requested names that are not in use (id, seq, at, name, ... rows).

    Of equal names in one batch the first request wins.
    """
    others = [c for c in requests.columns if c != "name"]
    first = requests.groupBy("name").agg(F.min_by(F.struct(*others), "seq").alias("r")).select("name", "r.*")
    fresh = first.join(current.select("name"), "name", "left_anti")
    return fresh.withColumn("created", F.lit(True)).withColumn("status", F.lit("pending"))


def by_status(current: DataFrame, status: str | None = None) -> DataFrame:
    """Experiments newest first, optionally of one status."""
    if status is not None and status not in STATUSES:
        raise ValueError(f"unknown status {status!r}")
    kept = current if status is None else current.filter(F.col("status") == status)
    return kept.orderBy(F.col("created_at").desc(), "id")


def by_id(current: DataFrame, text: str) -> DataFrame:
    """The experiment with this id; else the first two whose id starts with it, so that a second one tells ambiguity."""
    exact = F.col("id") == text
    hits = current.filter(F.col("id").startswith(text)).orderBy(~exact, "id").limit(2)
    found = F.max(exact).over(Window.partitionBy(F.lit(0)))  # over two rows at most
    return hits.withColumn("_found", found).filter(~F.col("_found") | exact).drop("_found")


def by_name(current: DataFrame, name: str) -> DataFrame:
    """The earliest experiment of this name."""
    return current.filter(F.col("name") == name).orderBy("created_at", "id").limit(1)


def metrics_of(current: DataFrame, experiment_id: str | None = None) -> DataFrame:
    """(id, metric, value) rows."""
    kept = current if experiment_id is None else current.filter(F.col("id") == experiment_id)
    return kept.select("id", F.explode("metrics").alias("metric", "value"))


def to_json(current: DataFrame) -> DataFrame:
    return current.select("id", F.to_json(F.struct(*[c for c in current.columns])).alias("document"))


def from_json(documents: DataFrame) -> DataFrame:
    """Experiments from their documents; a missing status is pending."""
    fields = [f for f in EVENT_SCHEMA.split(", ") if f.split(" ")[0] in ("id", *FIELDS)]
    schema = ", ".join([*fields, "created_at timestamp", "updated_at timestamp"])
    parsed = documents.select(F.from_json("document", schema).alias("d")).select("d.*")
    return parsed.withColumn("status", F.coalesce("status", F.lit("pending")))


class Registry:
    """The registry over a folder of event files."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def events(self) -> DataFrame:
        try:
            return self.spark.read.schema(EVENT_SCHEMA).parquet(self.path)
        except AnalysisException:  # no event yet
            return self.spark.createDataFrame([], EVENT_SCHEMA)

    def current(self) -> DataFrame:
        return latest(self.events())

    def _append(self, experiment_id: str, **fields: Any) -> None:
        names = [f.split(" ")[0] for f in EVENT_SCHEMA.split(", ")]
        row = {n: None for n in names} | {"id": experiment_id, "seq": time.time_ns()} | fields
        event = self.spark.createDataFrame([tuple(row[n] for n in names)], EVENT_SCHEMA)
        event = event.withColumn("at", F.current_timestamp())
        event.coalesce(1).write.mode("append").parquet(self.path)

    def create(self, name: str, model_type: str | None = None, parameters: dict | None = None):
        if self.get_by_name(name) is not None:
            raise ValueError(f"experiment {name!r} already exists")
        experiment_id = str(uuid.uuid4())
        texts = {k: v if isinstance(v, str) else json.dumps(v) for k, v in (parameters or {}).items()}
        self._append(
            experiment_id, created=True, name=name, status="pending", model_type=model_type, parameters=texts, metrics={}
        )
        return self.get(experiment_id)

    def get(self, text: str):
        """Experiment by id or unambiguous prefix, or None."""
        hits = by_id(self.current(), text).collect()
        if len(hits) > 1:
            raise ValueError(f"several experiments start with {text!r}")
        return hits[0] if hits else None

    def get_by_name(self, name: str):
        return by_name(self.current(), name).first()

    def resolve(self, text: str):
        """Experiment by name, else by id or prefix."""
        return self.get_by_name(text) or self.get(text)

    def list(self, status: str | None = None) -> DataFrame:
        return by_status(self.current(), status)

    def update(self, experiment_id: str, **fields: Any):
        """Set known fields, ignore others; a field given as None is cleared. None for an unknown id."""
        if self.current().filter(F.col("id") == experiment_id).isEmpty():
            return None
        known = {k: v for k, v in fields.items() if k in FIELDS}
        if known.get("status", STATUSES[0]) not in STATUSES:
            raise ValueError(f"unknown status {known['status']!r}")
        cleared = [k for k, v in known.items() if v is None]
        self._append(experiment_id, **known, cleared=cleared or None)
        return self.get(experiment_id)

    def compact(self, path: str) -> Registry:
        """Write all events, in order, to few files in another folder and return the registry over it."""
        self.events().repartitionByRange("seq").sortWithinPartitions("seq").write.parquet(path)
        return Registry(self.spark, path)

    def delete(self, experiment_id: str) -> bool:
        if self.current().filter(F.col("id") == experiment_id).isEmpty():
            return False
        self._append(experiment_id, deleted=True)
        return True

    def start(self, experiment_id: str):
        return self.update(experiment_id, status="running")

    def stop(self, experiment_id: str):
        return self.update(experiment_id, status="stopped")

    def complete(self, experiment_id: str, metrics: dict[str, float], run_id: str | None = None):
        given = {} if run_id is None else {"run_id": run_id}
        return self.update(experiment_id, status="completed", metrics=metrics, **given)

    def fail(self, experiment_id: str, error: str):
        return self.update(experiment_id, status="failed", error=error)

    def deploy(self, experiment_id: str, endpoint: str):
        return self.update(experiment_id, status="deployed", deployed_endpoint=endpoint)
