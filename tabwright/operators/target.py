"""Target column, target classes and task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import TEXT, is_fractional, quoted, type_class

# Names searched for a target, in order of preference.
TARGET_NAMES = ["target", "label", "class", "y", "survived", "price", "outcome", "result"]
SEARCH_TARGET_NAMES = ["target", "label", "class", "y", "survived", "price", "outcome"]

MAX_CLASSES = 20


def infer_target(
    profiled: DataFrame,
    target: str | None = None,
    names: Sequence[str] = TARGET_NAMES,
    by_kind: bool = True,
) -> DataFrame:
    """One row ``target``: the column ranked first over the profile rows.

    Ranks: a listed name (list order, then table order); the rightmost
    categorical or binary column of at most 20 values; the rightmost column
    that is not an identifier; the last column. ``by_kind=False`` leaves the
    two middle ranks out.
    """
    spark = profiled.sparkSession
    if target:
        return spark.createDataFrame([(target,)], "target string")
    name_rank = F.array_position(F.array(*[F.lit(n) for n in names]), F.lower("column"))
    few_values = F.col("kind").isin("categorical", "binary") & (F.col("n_distinct") <= MAX_CLASSES)
    tier = F.when(name_rank > 0, 1)
    if by_kind:
        tier = tier.when(few_values, 2).when(F.col("kind") != "id", 3)
    tier = tier.otherwise(4)
    place = F.when(name_rank > 0, F.col("pos")).otherwise(-F.col("pos"))
    return profiled.agg(F.min_by("column", F.struct(tier, name_rank, place)).alias("target"))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value; partial aggregation keeps hot labels cheap."""
    c = F.col(quoted(label))
    if is_fractional(df.schema[label].dataType):
        c = F.when(~F.isnan(c), c)
    return df.groupBy(c.alias("label")).agg(F.count(F.lit(1)).alias("n"))


def target_classes(df: DataFrame, label: str) -> DataFrame:
    """One row: number of distinct labels and, up to 20, the sorted labels.

    Only the 21 smallest labels are ever gathered: enough to tell a class
    target from a regression one.
    """
    counts = class_counts(df, label).filter(F.col("label").isNotNull())
    smallest = (
        counts.orderBy("label")
        .limit(MAX_CLASSES + 1)
        .agg(F.array_sort(F.collect_list("label")).alias("seen"))
    )
    total = counts.agg(F.count(F.lit(1)).alias("n_classes"))
    # two rows folded into one
    both = total.unionByName(smallest, allowMissingColumns=True)
    few = F.col("n_classes") <= MAX_CLASSES
    return both.agg(F.max("n_classes").alias("n_classes"), F.max("seen").alias("seen")).select(
        "n_classes",
        F.when(few, F.col("seen")).alias("classes"),
        F.when(few, "classification").otherwise("regression").alias("target_type"),
    )


def detect_task(df: DataFrame, label: str) -> DataFrame:
    """One row ``n_classes, task``: over 20 labels or a float label is regression, a text label never.

    This is the one rule of preparing, evaluating and describing a target.
    """
    fractional = is_fractional(df.schema[label].dataType)
    many = (F.col("n_classes") > MAX_CLASSES) & F.lit(type_class(df.schema[label].dataType) != TEXT)
    counts = class_counts(df, label).filter(F.col("label").isNotNull())
    return counts.agg(F.count(F.lit(1)).alias("n_classes")).withColumn(
        "task",
        F.when(many | F.lit(fractional), "regression").otherwise("classification"),
    )
