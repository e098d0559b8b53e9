"""Parameter grids, trial plans and rankings as tables.

Trial rows: trial_id, trial_no, model_name, model_type, params, metrics, status,
error, run_id, dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwright.operators.models import GRIDS
from tabwright.operators.order import global_rank

TRIAL_SCHEMA = (
    "trial_id string, trial_no long, model_name string, model_type string, params map<string,string>, "
    "metrics map<string,double>, status string, error string, run_id string, dropped array<string>"
)
GRID_SCHEMA = (
    "family_pos int, model_name string, model_type string, param_pos int, param string, value_pos int, value string"
)
ERROR_METRICS = ("mse", "rmse", "mae")
PER_FAMILY = 3
MAX_TRIALS = 10
TOP = 10


def grid_table(spark: SparkSession, grids=GRIDS) -> DataFrame:
    """The search space as rows, one per parameter value; its size is that of the definition."""
    rows = [
        (f, name, kind, p, param, v, str(value))
        for f, (name, kind, space) in enumerate(grids)
        for p, (param, values) in enumerate(space.items())
        for v, value in enumerate(values)
    ]
    return spark.createDataFrame(rows, GRID_SCHEMA)


def param_grid(grid: DataFrame) -> DataFrame:
    """Every combination of each family's values, numbered; the last parameter varies fastest.

    A combination's number is read as mixed-radix digits, one digit per
    parameter, so nothing is joined.
    """
    values = grid.groupBy("family_pos", "model_name", "model_type", "param_pos", "param").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("value_pos", "value"))), lambda s: s["value"]).alias("values")
    )
    families = values.groupBy("family_pos", "model_name", "model_type").agg(
        F.array_sort(F.collect_list(F.struct("param_pos", "param", "values"))).alias("space")
    )

    def product(space):
        return F.aggregate(space, F.lit(1).cast("long"), lambda acc, s: acc * F.size(s["values"]))

    space = F.col("space")
    numbered = families.withColumn(
        "combo_pos", F.explode(F.sequence(F.lit(0).cast("long"), product(space) - 1))
    )

    def digit(entry, i):
        stride = product(F.slice(space, i + 2, F.size(space)))
        place = F.pmod(F.floor(F.col("combo_pos") / stride), F.size(entry["values"]))
        return F.struct(entry["param"].alias("key"), F.get(entry["values"], place.cast("int")).alias("value"))

    return numbered.select(
        "family_pos",
        "model_name",
        "model_type",
        "combo_pos",
        F.map_from_entries(F.transform(space, digit)).alias("params"),
    )


def trial_plan(
    combos: DataFrame,
    families: Sequence[str] | None = None,
    n_trials: int = MAX_TRIALS,
    per_family: int = PER_FAMILY,
) -> DataFrame:
    """The first combinations of each family in list order, up to ``n_trials``.

    The trial number is also the seed.
    """
    kept = combos.filter(F.col("combo_pos") < per_family)
    if families:
        kept = kept.filter(F.col("model_type").isin(list(families)))
    first = kept.orderBy("family_pos", "combo_pos").limit(n_trials)
    order = Window.orderBy("family_pos", "combo_pos")  # over n_trials rows at most
    return first.withColumn("trial_no", F.row_number().over(order).cast("long")).withColumn(
        "seed", F.col("trial_no")
    )


def _ranked_by(metric: str):
    value = F.element_at(F.col("metrics"), metric)
    return value.asc() if metric in ERROR_METRICS else value.desc()


def _scored(trials: DataFrame, metric: str) -> DataFrame:
    return trials.filter((F.col("status") == "completed") & F.map_contains_key("metrics", metric))


def rank(trials: DataFrame, metric: str = "accuracy") -> DataFrame:
    """Completed trials with the metric, ranked best first; ties keep trial order."""
    return global_rank(_scored(trials, metric), [_ranked_by(metric), F.col("trial_no")], "rank")


def leaderboard(trials: DataFrame, metric: str = "accuracy", n: int = TOP) -> DataFrame:
    """The n best trials with their scores; a missing score shows as 0."""
    m = F.col("metrics")

    def score(*names):
        return F.coalesce(*[F.element_at(m, x) for x in names], F.lit(0.0))

    best = _scored(trials, metric).orderBy(_ranked_by(metric), "trial_no").limit(n)
    order = Window.orderBy(_ranked_by(metric), "trial_no")  # over n rows at most
    return best.withColumn("rank", F.row_number().over(order)).select(
        "rank",
        "trial_no",
        "model_name",
        score("accuracy", "r2").alias("accuracy"),
        *[score(x).alias(x) for x in ("precision", "recall", "f1")],
    )


def trial_summary(trials: DataFrame) -> DataFrame:
    """One row: number of trials and how many completed."""
    return trials.agg(
        F.count(F.lit(1)).alias("total_trials"),
        F.count_if(F.col("status") == "completed").alias("successful"),
    )
