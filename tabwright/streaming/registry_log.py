"""The experiment log as a stream over the event folder."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.operators.registry import EVENT_SCHEMA, TERMINAL


def watch(spark: SparkSession, path: str, experiment_id: str | None = None) -> DataFrame:
    """Streaming rows (id, seq, at, status, error, ended) of one experiment, or of all."""
    events = spark.readStream.schema(EVENT_SCHEMA).parquet(path)
    if experiment_id is not None:
        events = events.filter(F.col("id") == experiment_id)
    return events.filter(F.col("status").isNotNull()).select(
        "id", "seq", "at", "status", "error", F.col("status").isin(TERMINAL).alias("ended")
    )


def follow(log: DataFrame, path: str, checkpoint: str, seconds: float = 2.0) -> None:
    """Append the log to a folder until an end state has come in."""
    ended = threading.Event()

    def batch(rows: DataFrame, _: int) -> None:
        rows.persist()  # written and looked through
        rows.write.mode("append").parquet(path)
        if not rows.filter("ended").isEmpty():
            ended.set()
        rows.unpersist()

    writer = log.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    query = writer.trigger(processingTime=f"{seconds} seconds").start()
    try:
        while query.isActive and not ended.wait(0.2):
            pass
    finally:
        query.stop()
    if query.exception() is not None:
        raise query.exception()


def write_log(log: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append the log to a folder; ``once`` stops when what is there has been read."""
    writer = log.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="2 seconds")
    return writer.start(path)
