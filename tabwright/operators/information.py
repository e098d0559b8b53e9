"""Mutual information of a number and a class by nearest neighbours.

For each row the distance to its k-th nearest row of the same class is taken,
and all rows within that distance are counted. With digamma P, N rows, N_c of
the row's class, k_i rows of the class and m_i rows in all within the distance
(both without the row itself), the score is P(N) - mean P(N_c) + mean P(k_i) -
mean P(m_i), and not below 0. Ties need no jitter: both counts include
rows at the very distance, so copies of a value count as what they are and the
score is repeatable.

Equal values of a class are one weighted point. The k-th distance needs the k
points before and after in the order of class and value, read in blocks of
ranks. The range counts are differences of a running total over values and range
ends in one order. No pair of points is emitted, and no class or feature has to
fit into a task.

Decisions: missing and non-finite values and rows without a class do not count
for a feature; a class of one row does not count either; a class of at most k
rows takes all its others as neighbours; a feature without two rows of one class
has no score (null).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import quoted
from tabwright.operators.order import global_rank, hot_key_join, neighbouring, running_total
from tabwright.session import written

NEIGHBOURS = 3
SHIFT = 10  # steps of the recurrence before the series


def digamma(x: Column) -> Column:
    """Digamma of a number of at least 1: the recurrence up to x + SHIFT, then the asymptotic series."""
    z = x.cast("double") + SHIFT
    w = 1.0 / (z * z)
    series = F.log(z) - 0.5 / z - w * (1 / 12 - w * (1 / 120 - w * (1 / 252 - w * (1 / 240 - w / 132))))
    return series - sum((1.0 / (x + i) for i in range(1, SHIFT)), 1.0 / x)


def _points(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(pos, class, v, n): the rows of each feature by class and value, from one scan."""

    def number(name: str) -> Column:
        c = F.col(quoted(name)).cast("double")
        return F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)

    values = F.array(*[F.struct(F.lit(i).alias("pos"), number(c).alias("v")) for i, c in enumerate(features)])
    named = F.col(quoted(label)).cast("string")
    return (
        df.filter(named.isNotNull())
        .select(named.alias("label"), F.inline(values))
        .filter(F.col("v").isNotNull())
        .groupBy("pos", F.concat_ws(":", "pos", "label").alias("class"), "v")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def _reach(points: DataFrame, k: int) -> DataFrame:
    """Each point with its range of values, and ``near``: rows of its class in there but one."""
    ranked = global_rank(points, [F.col("pos"), F.col("class"), F.col("v")], "id")
    around = neighbouring(ranked, "id", k, ["class", "v", "n"], "around")
    own = F.filter("around", lambda p: p["class"] == F.col("class"))
    apart = F.transform(
        own,
        lambda p: F.struct(
            F.abs(p["v"] - F.col("v")).alias("d"),
            (p["n"] - (p["v"] == F.col("v")).cast("long")).alias("n"),
            p["v"].alias("v"),
        ),
    )
    start = F.struct(F.least(F.lit(k), F.col("n_class") - 1).cast("long").alias("left"), F.lit(0.0).alias("d"))
    kth = F.aggregate(
        F.array_sort("apart"),
        start,
        lambda acc, p: F.struct(
            (acc["left"] - p["n"]).alias("left"), F.when(acc["left"] > 0, p["d"]).otherwise(acc["d"]).alias("d")
        ),
    )["d"]
    inside = F.filter("apart", lambda p: p["d"] <= F.col("r"))
    held = F.transform("inside", lambda p: p["v"])
    return (
        around.withColumn("apart", apart)
        .withColumn("r", kth)
        .withColumn("inside", inside)
        .select(
            "id", "pos", "n", "n_class",
            F.aggregate("inside", F.lit(0).cast("long"), lambda acc, p: acc + p["n"]).alias("near"),
            # the ends are never rounded past a neighbour
            F.least(F.col("v") - F.col("r"), F.array_min(held)).alias("low"),
            F.greatest(F.col("v") + F.col("r"), F.array_max(held)).alias("high"),
        )
    )


def _range_counts(points: DataFrame, reach: DataFrame) -> DataFrame:
    """``reach`` with ``all``: rows of the feature in each range but one."""
    nothing = F.lit(0).cast("long")
    carried = ["id", "n_class", "near", F.col("n").alias("weight")]
    values = points.groupBy("pos", F.col("v").alias("at")).agg(F.sum("n").alias("n"))
    values = values.select(
        "pos", "at", F.lit(1).alias("side"), "n", *[F.lit(None).cast("long").alias(c) for c in ("id", "n_class", "near", "weight")]
    )
    low = reach.select("pos", F.col("low").alias("at"), F.lit(0).alias("side"), nothing.alias("n"), *carried)
    high = reach.select("pos", F.col("high").alias("at"), F.lit(2).alias("side"), nothing.alias("n"), *carried)
    events = values.unionByName(low).unionByName(high)
    totals = running_total(events, [F.col("pos"), F.col("at"), F.col("side"), F.col("id")], "n")
    sign = F.when(F.col("side") == 2, F.col("running")).otherwise(-F.col("running"))
    return (
        totals.filter("side != 1")
        .groupBy("id", "pos", "n_class", "near", "weight")
        .agg((F.sum(sign) - 1).alias("all"))
    )


def neighbour_information(df: DataFrame, features: Sequence[str], label: str, k: int = NEIGHBOURS) -> DataFrame:
    """(feature, pos, mi): mutual information of each numeric feature with the class ``label``."""
    if k < 1:
        raise ValueError("k is at least 1")
    points = written(_points(df, features, label), "information-points")
    classes = points.groupBy("class").agg(F.sum("n").alias("n_class"), F.count(F.lit(1)).alias("_rows"))
    points = written(hot_key_join(points, classes, "class", "_rows").filter("n_class > 1"), "information-classes")
    # both ends of a range and the sample of their order read it
    reach = written(_reach(points, k), "information-reach")
    counted = _range_counts(points, reach)
    total = F.sum("weight")

    def mean(c: str) -> Column:
        return F.sum(F.col("weight") * digamma(F.col(c))) / total

    scores = counted.groupBy("pos").agg(
        F.greatest(digamma(total) - mean("n_class") + mean("near") - mean("all"), F.lit(0.0)).alias("mi")
    )
    names = df.sparkSession.createDataFrame(list(enumerate(features)), "pos int, feature string")
    return names.join(F.broadcast(scores), "pos", "left").select("feature", "pos", "mi")  # one row per feature
