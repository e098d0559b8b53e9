"""Regression trees of MLlib on large tables, trained on rows of equal bins.

MLlib cuts a feature at up to ``maxBins`` - 1 places that it draws from a sample,
and with squared errors its cuts and leaves depend on the rows of equal bins
through their number and mean label alone. So the bins are settled first, by the
same rule from a sample of the same size, and the learner is fitted to one row
for all rows of equal bins, weighted by their number: the same trees, up to the
sample and the last digits of the sums.

A learner that draws rows gets them in parts, each drawn as one. Rows are dealt
into parts at random; there are about ``PART_ROWS`` of them, and a part holds at
most one row in ``HOT`` or about as many as one of ``PART_ROWS`` equal parts.

Tables of up to ``PART_ROWS`` rows or over ``WIDTH`` features, and those whose
rows of equal bins are fewer than ``REPEATS`` on average, are left to the learner
as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasInputCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.session import written

PART_ROWS = 4_000_000
REPEATS = 4  # rows to a different row of bins from which they are trained on as one
HOT = 100_000
WIDTH = 64
SAMPLE_ROWS = 10_000  # as MLlib's
BINNED = "_binned"


def candidate_cuts(values, bins: int) -> list[float]:
    """Where MLlib would cut a feature with these sampled values."""
    import numpy as np

    seen, counts = np.unique(values[~np.isnan(values)], return_counts=True)
    middles = (seen[:-1] + seen[1:]) / 2
    if len(middles) < bins:
        return middles.tolist()
    stride = counts.sum() / bins
    cuts, target, total = [], stride, int(counts[0])
    for middle, count in zip(middles.tolist(), counts[1:].tolist()):
        if abs(total - target) < abs(total + count - target):
            cuts.append(middle)
            target += stride
        total += count
    return cuts


def _codes(x, cuts: list[list[float]]):
    """The bin of each value of a matrix; a value belongs to the first cut it does not exceed."""
    import numpy as np

    out = np.empty(x.shape, np.uint8)
    for j, own in enumerate(cuts):
        out[:, j] = np.searchsorted(own, x[:, j], side="left")
    return out


class ToBins(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A vector of values as the vector of their bins; ``cuts`` are the ascending cuts of each feature as JSON."""

    cuts = Param(Params._dummy(), "cuts", "cuts of each feature as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, cuts=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cuts = json.loads(self.getOrDefault(self.cuts))

        @F.arrow_udf("array<double>")
        def place(x):
            import numpy as np
            import pyarrow as pa

            codes = _codes(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), cuts).astype(float)
            offsets = np.arange(0, codes.size + 1, codes.shape[1], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel()))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(place(vector_to_array(self.getInputCol()))))


class EqualBinsAsOne(Estimator, HasFeaturesCol, HasLabelCol):
    """Fit ``learner``, regression trees with squared errors, or ``plain`` where binning does not pay; ``draws``: it draws rows."""

    @keyword_only
    def __init__(self, *, learner=None, plain=None, draws=False, featuresCol="features", labelCol="label"):
        super().__init__()
        self.learner, self.plain, self.draws = learner, plain or learner, draws
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def _fit(self, dataset: DataFrame):
        features, label = self.getFeaturesCol(), self.getLabelCol()
        rows = dataset.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
        if n <= PART_ROWS or not 0 < width <= WIDTH:
            return self.plain.fit(dataset)
        cuts = self._cuts(rows, n, width)
        placed = written(rows.mapInArrow(_placer(cuts), "bins binary, y double"), "binned-rows")
        different = placed.agg(F.approx_count_distinct("bins")).first()[0]
        if n < REPEATS * different:
            return self.plain.fit(dataset)
        weighted = self._weighted(placed, n, different).mapInArrow(_unpack, f"{BINNED} array<double>, y double, rows double")
        weighted = written(weighted.withColumn(BINNED, array_to_vector(BINNED)), "equal-bins")
        learner = self.learner.copy({self.learner.weightCol: "rows", self.learner.featuresCol: BINNED, self.learner.labelCol: "y"})
        return PipelineModel([ToBins(inputCol=features, outputCol=BINNED, cuts=json.dumps(cuts)), learner.fit(weighted)])

    def _cuts(self, rows: DataFrame, n: int, width: int) -> list[list[float]]:
        import numpy as np

        bins = self.learner.getMaxBins()
        wanted = max(bins**2, SAMPLE_ROWS)
        drawn = rows.select("x").sample(min(1.0, wanted / n), seed=self.learner.getSeed()).toArrow()
        x = drawn["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        return [candidate_cuts(np.asarray(x[:, j]), bins) for j in range(width)]

    def _weighted(self, placed: DataFrame, n: int, different: int) -> DataFrame:
        """(bins, y, rows): the mean label and the number of rows of equal bins, or of each part of them."""
        figures = F.avg("y").alias("y"), F.count(F.lit(1)).cast("double").alias("rows")
        if not self.draws:
            return placed.groupBy("bins").agg(*figures).select("bins", "y", "rows")
        sizes = placed.groupBy("bins").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > n / HOT)  # fewer than HOT
        hot = sizes.select("bins", F.ceil(F.col("n") * (PART_ROWS / n)).alias("parts"))
        dealt = placed.join(F.broadcast(hot), "bins", "left")
        parts = F.coalesce("parts", F.lit(max(1, PART_ROWS // different)))
        dealt = dealt.withColumn("part", F.floor(F.rand(self.learner.getSeed()) * parts).cast("int"))
        return dealt.groupBy("bins", "part").agg(*figures).select("bins", "y", "rows")


def _placer(cuts: list[list[float]]):
    def kernel(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(cuts))
                packed = pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(len(cuts)), batch.num_rows, [None, pa.py_buffer(_codes(x, cuts).tobytes())]
                )
                yield pa.RecordBatch.from_arrays([packed.cast(pa.binary()), batch["y"]], ["bins", "y"])

    return kernel


def _unpack(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        if batch.num_rows:
            raw = b"".join(batch["bins"].to_pylist())
            values = pa.array(np.frombuffer(raw, np.uint8).astype(float))
            offsets = pa.array(np.arange(0, len(raw) + 1, len(raw) // batch.num_rows, dtype=np.int32))
            bins = pa.ListArray.from_arrays(offsets, values)
            yield pa.RecordBatch.from_arrays([bins, batch["y"], batch["rows"]], [BINNED, "y", "rows"])
