"""Feature scores and selection of the best k."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import quoted
from tabwright.operators.information import neighbour_information
from tabwright.operators.order import exact_quantiles
from tabwright.session import written

BATCH = 64
LABEL_BINS = 10  # of a numeric label


def _batches(features: Sequence[str]) -> list[list[tuple[int, str]]]:
    numbered = list(enumerate(features))
    return [numbered[i : i + BATCH] for i in range(0, len(numbered), BATCH)]


def _class_moments(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, pos, n, mean, var) per class; one grouped aggregate for many features."""
    parts = []
    for batch in _batches(features):
        sums = df.groupBy(F.col(quoted(label)).alias("label")).agg(
            *[
                F.struct(
                    F.lit(name).alias("feature"),
                    F.lit(pos).alias("pos"),
                    F.count(F.col(quoted(name))).alias("n"),
                    F.avg(F.col(quoted(name)).cast("double")).alias("mean"),
                    F.var_pop(F.col(quoted(name)).cast("double")).alias("var"),
                ).alias(f"s{pos}")
                for pos, name in batch
            ]
        )
        parts.append(sums.select(F.inline(F.array(*[F.col(f"s{pos}") for pos, _ in batch]))))
    return reduce(DataFrame.unionByName, parts).filter(F.col("n") > 0)


def anova_f(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, pos, f_score): between-class over within-class variance.

    A constant feature has no score (null); perfect separation scores infinity.
    """
    groups = _class_moments(df, features, label)
    grand = groups.groupBy("pos").agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("classes"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
    )
    n, k = F.max("total"), F.max("classes")
    between = F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)) / F.nullif(k - 1, F.lit(0))
    within = F.sum(F.col("n") * F.col("var")) / F.nullif(n - k, F.lit(0))
    return (
        groups.join(F.broadcast(grand), "pos")  # one row per feature
        .groupBy("feature", "pos")
        .agg(between.alias("between"), within.alias("within"))
        .select(
            "feature",
            "pos",
            F.when(F.col("within") > 0, F.col("between") / F.nullif(F.col("within"), F.lit(0.0)))
            .when(F.col("between") > 0, float("inf"))
            .alias("f_score"),
        )
    )


def f_regression(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(feature, pos, f_score) from the correlation with a numeric label."""
    y, parts = F.col(quoted(label)).cast("double"), []
    for batch in _batches(features):
        row = df.agg(
            *[
                F.struct(
                    F.lit(name).alias("feature"),
                    F.lit(pos).alias("pos"),
                    F.corr(F.col(quoted(name)).cast("double"), y).alias("r"),
                    F.count(F.when(y.isNotNull(), F.col(quoted(name)))).alias("n"),
                ).alias(f"s{pos}")
                for pos, name in batch
            ]
        )
        parts.append(row.select(F.inline(F.array(*[F.col(f"s{pos}") for pos, _ in batch]))))
    r2 = F.col("r") * F.col("r")
    score = F.when(r2 < 1, r2 / F.nullif(1 - r2, F.lit(0.0)) * (F.col("n") - 2)).when(r2 >= 1, float("inf"))
    return reduce(DataFrame.unionByName, parts).select("feature", "pos", score.alias("f_score"))


def _bins(c: Column, cuts: Sequence[float]) -> Column:
    """Number of cuts below a value; -1 where it is missing."""
    above = F.lit(0)
    for cut in cuts:
        above = above + (c > cut).cast("int")
    return F.when(c.isNotNull(), above).otherwise(-1)


def mutual_information(
    df: DataFrame, features: Sequence[str], label: str, bins: int = 10, label_bins: int | None = None
) -> DataFrame:
    """(feature, pos, mi): mutual information of label and feature in quantile bins.

    Bin edges are exact quantiles of each feature, so the score is repeatable.
    ``label_bins`` cuts a numeric label the same way; without it every label is
    a class, and the joint table has bins times classes rows per feature.
    """
    cut = {name: bins for name in features} | ({label: label_bins} if label_bins else {})
    probs = {name: [k / n for k in range(1, n)] for name, n in cut.items()}
    cuts: dict[str, list[float]] = {}
    for n in sorted(set(cut.values())):
        names = [name for name in cut if cut[name] == n]
        edges, _ = exact_quantiles(df, names, probs[names[0]], interpolate=False)
        cuts |= {c: sorted({edges[(c, p)] for p in probs[c] if edges[(c, p)] is not None}) for c in names}
    value = F.col(quoted(label))
    marked = df.withColumn("_label", _bins(value.cast("double"), cuts[label]) if label_bins else value)
    joint = written(
        reduce(
            DataFrame.unionByName,
            [
                marked.select(_bins(F.col(quoted(name)).cast("double"), cuts[name]).alias("bin"), "_label")
                .groupBy("bin", "_label")
                .agg(F.count(F.lit(1)).alias("n"))
                .select(F.lit(name).alias("feature"), F.lit(pos).alias("pos"), "bin", F.col("_label").alias("label"), "n")
                for pos, name in enumerate(features)
            ],
        ),
        "joint-counts",
    )
    by_bin = joint.groupBy("pos", "bin").agg(F.sum("n").alias("n_bin"))
    # every feature has the same rows, so the first one tells the labels
    by_label = joint.filter("pos = 0").groupBy(F.col("label").alias("own")).agg(F.sum("n").alias("n_label"))
    total = by_label.agg(F.sum("n_label")).first()[0] or 0
    n, expected = F.col("n"), F.col("n_bin") * F.col("n_label") / F.lit(float(total))
    return (
        joint.join(F.broadcast(by_bin), ["pos", "bin"])  # bins of each feature
        .join(by_label, F.col("label").eqNullSafe(F.col("own")))
        .groupBy("feature", "pos")
        .agg(F.sum(n / F.lit(float(total)) * F.log(n / expected)).alias("mi"))
    )


def _binned(df: DataFrame, label: str) -> DataFrame:
    """``df`` with the quantile bin of a numeric label as ``_label``; a missing one stays missing."""
    probs = [k / LABEL_BINS for k in range(1, LABEL_BINS)]
    edges, _ = exact_quantiles(df, [label], probs, interpolate=False)
    value = F.col(quoted(label)).cast("double")
    cuts = sorted({e for e in edges.values() if e is not None})
    return df.withColumn("_label", F.when(value.isNotNull() & ~F.isnan(value), _bins(value, cuts)))


def select_k_best(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    k: int | None = None,
    method: str = "f_classif",
    task: str = "classification",
) -> DataFrame:
    """(feature, pos, score) of the k best features; of equal scores the later column wins.

    A regression target is scored by correlation under either F method; it is cut
    into quantile bins for ``mutual_info`` and, as classes, for ``mutual_info_knn``.
    """
    if method == "f_classif" and task == "regression":
        scores = f_regression(df, features, label).withColumnRenamed("f_score", "score")
    elif method == "f_classif":
        scores = anova_f(df, features, label).withColumnRenamed("f_score", "score")
    elif method == "mutual_info":
        label_bins = LABEL_BINS if task == "regression" else None
        scores = mutual_information(df, features, label, label_bins=label_bins).withColumnRenamed("mi", "score")
    elif method == "mutual_info_knn":
        if task == "regression":
            df, label = _binned(df, label), "_label"
        scores = neighbour_information(df, features, label).withColumnRenamed("mi", "score")
    else:
        raise ValueError(f"unknown method {method!r}")
    keep = min(k or len(features), len(features))
    return scores.orderBy(F.col("score").desc_nulls_last(), F.col("pos").desc()).limit(keep)


def selected_features(selected: DataFrame) -> list[str]:
    """Names of the chosen features in table order."""
    return [r["feature"] for r in sorted(selected.collect(), key=lambda r: r["pos"])]
