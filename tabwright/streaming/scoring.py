"""Scoring of batches and streams with saved statistics and a saved model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabwright.functions.schema import quoted
from tabwright.plans.experiment import Neighbours
from tabwright.plans.preprocess import Preprocessor


class Scorer:
    """A saved scorer; the same projection serves a table and a stream."""

    def __init__(self, preprocessor: Preprocessor, names: Sequence[str], model: PipelineModel | Neighbours):
        self.preprocessor, self.names, self.model = preprocessor, list(names), model

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Scorer:
        names = [r["name"] for r in spark.read.parquet(f"{path}/names").collect()]
        model = Neighbours.load(spark, path) or PipelineModel.load(f"{path}/model")
        return cls(Preprocessor.load(spark, f"{path}/preprocess"), names, model)

    def score(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns with ``prediction`` and, for classes, ``predicted_class``."""
        shown = [f"_keep{i}" for i in range(len(keep))]
        tagged = df.withColumns({s: F.col(c) for s, c in zip(shown, keep)})
        table = self.preprocessor.transform(tagged, shown, label=False, vector=None)
        scalars = [f"_x{i}" for i in range(len(self.names))]
        ready = table.select(*shown, *[F.col(quoted(n)).alias(s) for s, n in zip(scalars, self.names)])
        ready = VectorAssembler(inputCols=scalars, outputCol="features").transform(ready).drop(*scalars)
        scored = self.model.transform(ready)
        out = [F.col(s).alias(c) for s, c in zip(shown, keep)] + [F.col("prediction")]
        if self.preprocessor.classes:
            classes = F.array(*[F.lit(c) for c in self.preprocessor.classes])
            out.append(F.get(classes, F.col("prediction").cast("int")).alias("predicted_class"))
        return scored.select(*out)

    def score_stream(
        self, stream: DataFrame, path: str, checkpoint: str, keep: Sequence[str] = (), once: bool = True
    ) -> StreamingQuery:
        """Score a stream into a folder of Parquet files; the neighbour model scores each batch by itself."""
        if isinstance(self.model, Neighbours):
            started = stream.writeStream.foreachBatch(
                lambda batch, _: self.score(batch, keep).write.mode("append").parquet(path)
            ).option("checkpointLocation", checkpoint)
            started = started.trigger(availableNow=True) if once else started.trigger(processingTime="10 seconds")
            return started.start()
        writer = (
            self.score(stream, keep)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
        )
        writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="10 seconds")
        return writer.start(path)
