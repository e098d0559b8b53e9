"""Classification and regression metrics as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import quoted
from tabwright.operators.target import detect_task


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction)."""
    return df.groupBy(
        F.col(quoted(label)).alias("label"), F.col(quoted(prediction)).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def _ratio(a, b):
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def per_class_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Support, precision, recall and f1 of each class; division by zero gives 0."""
    n, zero = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(F.col("label").alias("cls"), n.alias("support"), zero.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("cls"), zero.alias("support"), n.alias("predicted"), zero.alias("hits")),
    )
    totals = (
        confusion_matrix(df, label, prediction)
        .select(F.inline(sides))
        .groupBy("cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    scored = totals.withColumn("precision", _ratio(F.col("hits"), F.col("predicted"))).withColumn(
        "recall", _ratio(F.col("hits"), F.col("support"))
    )
    p, r = F.col("precision"), F.col("recall")
    return scored.withColumn("f1", _ratio(2 * p * r, p + r))


def classification_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1.

    Up to two label classes: the scores of the positive class, which is the
    larger label (1 of 0/1); a class that is only predicted is none of them. More:
    averages weighted by support.
    """
    scores = per_class_metrics(df, label, prediction)
    support, names = F.col("support"), ("precision", "recall", "f1")
    numeric = dict(scores.dtypes)["cls"] not in ("string", "boolean")
    labelled = F.when(support > 0, F.col("cls"))
    alone_and_negative = (F.count(labelled) == 1) & (F.max(labelled) == F.lit(0) if numeric else F.lit(False))
    positive = F.max_by(F.struct(*names), labelled)
    many = F.count_if(support > 0) > 2
    return scores.agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        *[
            F.when(many, F.sum(F.col(m) * support) / F.sum("support"))
            .when(alone_and_negative, 0.0)
            .otherwise(positive[m])
            .alias(m)
            for m in names
        ],
    )


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mse, rmse, mae, r2; a constant label gives r2 1 if exact, else 0."""
    y = F.col(quoted(label)).cast("double")
    error = y - F.col(quoted(prediction)).cast("double")
    squared, spread = F.sum(error * error), F.var_pop(y) * F.count(y)
    return df.agg(
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(spread > 0, 1 - squared / F.nullif(spread, F.lit(0.0)))
        .when(squared == 0, 1.0)
        .otherwise(0.0)
        .alias("r2"),
    )


def evaluate(df: DataFrame, label: str, prediction: str, task: str | None = None) -> DataFrame:
    """(metric, value) rows of the metric family of the task.

    Without a task the test labels decide, by :func:`detect_task`.
    """
    if task is None:
        task = detect_task(df, label).first()["task"]
    family = regression_metrics if task == "regression" else classification_metrics
    return family(df, label, prediction).unpivot([], None, "metric", "value")
