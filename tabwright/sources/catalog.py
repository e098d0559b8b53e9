"""Dataset folder: upload with profile, and a catalog of what it holds."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tabwright.functions.schema import NUMBER, TEXT, type_class
from tabwright.operators.profile import PROFILE_SCHEMA, mark_target, profile
from tabwright.operators.target import infer_target


def upload(df: DataFrame, folder: str, name: str, target: str | None = None) -> DataFrame:
    """Save a table as Parquet with its profile beside it; returns the profile."""
    spark = df.sparkSession
    df.write.mode("errorifexists").parquet(f"{folder}/{name}/data")
    saved = spark.read.schema(df.schema).parquet(f"{folder}/{name}/data")
    profiled = profile(saved, distinct="adaptive")
    target = infer_target(profiled, target).first()[0]
    profiled = mark_target(profiled, target)
    profiled.coalesce(1).write.json(f"{folder}/{name}/profile")
    return profiled


def dataset_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the datasets of a folder: uploaded ones, and Parquet files or folders named ``<name>.parquet``.

    The listing goes through Spark's own reader, so the folder may be in any store it reads; no content is read.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    base = folder.rstrip("/").rsplit("/", 1)[-1]
    inside = F.regexp_extract("path", f"/{re.escape(base)}/(.+)$", 1)
    named = F.coalesce(
        F.nullif(F.regexp_extract(inside, r"^([^/]+)\.parquet(/|$)", 1), F.lit("")),
        F.nullif(F.regexp_extract(inside, r"^([^/]+)/data/", 1), F.lit("")),
    )
    names = files.select(named.alias("name")).filter("name IS NOT NULL").distinct()
    return sorted(r["name"] for r in names.collect())  # one row per dataset


def open_dataset(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A dataset by its name: uploaded, or a Parquet file or folder."""
    if name not in dataset_names(spark, folder):
        raise ValueError(f"no dataset {name!r} in {folder}")
    try:
        return spark.read.parquet(f"{folder}/{name}/data")
    except AnalysisException:
        return spark.read.parquet(f"{folder}/{name}.parquet")


def folder_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """:func:`catalog` of all datasets of a folder; saved profiles decide the kinds where there are any."""
    tables, profiles = {}, {}
    for name in dataset_names(spark, folder):
        tables[name] = open_dataset(spark, folder, name)
        with contextlib.suppress(AnalysisException):
            profiles[name] = saved_profile(spark, folder, name)
            profiles[name].limit(1).count()
    return catalog(tables, {k: p for k, p in profiles.items() if k in tables})


def saved_profile(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(PROFILE_SCHEMA).json(f"{folder}/{name}/profile")


def catalog(
    tables: Mapping[str, DataFrame], profiles: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows, columns, numerical and categorical columns per dataset.

    Kinds come from a saved profile; without one they are counted by type.
    """
    profiles = profiles or {}
    parts = []
    for name, df in tables.items():
        # the count reads no column, only Parquet footers
        shape = df.agg(F.count(F.lit(1)).alias("n_rows"))
        if name in profiles:
            kinds = profiles[name].agg(
                F.count_if(F.col("kind").isin("numerical", "binary")).alias("n_numerical"),
                F.count_if(F.col("kind") == "categorical").alias("n_categorical"),
            )
            # two rows folded into one
            both = shape.unionByName(kinds, allowMissingColumns=True)
            shape = both.agg(*[F.max(c).alias(c) for c in both.columns])
        else:
            classes = [type_class(f.dataType) for f in df.schema.fields]
            shape = shape.withColumns(
                {
                    "n_numerical": F.lit(classes.count(NUMBER)).cast("long"),
                    "n_categorical": F.lit(classes.count(TEXT)).cast("long"),
                }
            )
        width = F.lit(len(df.columns)).cast("long")
        parts.append(
            shape.select(
                F.lit(name).alias("dataset"), "n_rows", width.alias("n_columns"), "n_numerical", "n_categorical"
            )
        )
    return reduce(DataFrame.unionByName, parts)
