"""Random Fourier features of the Gaussian kernel (Rahimi and Recht, 2007)."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 128


def projection(d: int, n: int, gamma: float, seed: int):
    """Weights (d x n) and shifts of ``n`` waves."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * gamma), (d, n)), rng.uniform(0.0, 2.0 * math.pi, n)


class FourierFeatures(
    Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable
):
    """cos(Wx + b) with weights drawn from the seed, so only parameters are saved."""

    dim = Param(Params._dummy(), "dim", "number of input features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    components = Param(Params._dummy(), "components", "number of output features", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, dim=None, gamma=None, seed=None, components=COMPONENTS
    ):
        super().__init__()
        self._setDefault(components=COMPONENTS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        d, n = self.getOrDefault(self.dim), self.getOrDefault(self.components)
        weights, shifts = projection(d, n, self.getOrDefault(self.gamma), self.getSeed())

        @F.arrow_udf("array<double>")
        def project(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            waves = math.sqrt(2.0 / n) * np.cos(rows @ weights + shifts)
            offsets = np.arange(0, (len(rows) + 1) * n, n, dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(waves.ravel()))

        wave = project(vector_to_array(F.col(self.getInputCol())))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(wave))
