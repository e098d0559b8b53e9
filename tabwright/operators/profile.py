"""Column profile: counts, ranges, distinct values and the kind of every column.

* ``exact``: per column, distinct values with their counts, then figures over
  the distinct values. A column is read once and alone, and the count is a
  partial aggregate, so a value held by a third of the rows crosses the shuffle
  once per task. One aggregate over many distinct counts would copy each row
  once per column instead.
* ``adaptive``: one scan without a value shuffle gives counts, ranges and a
  sketch of the distinct count; only columns whose sketch lies near a threshold
  that decides their kind (or near the row count) are counted exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.functions.schema import (
    NUMBER,
    OTHER,
    TEXT,
    UNSUPPORTED,
    is_fractional,
    quoted,
    type_class,
)
from tabwright.functions.values import is_number_text, nan_to_null

# Distinct-count limits of the kind rules.
BINARY_MAX = 10
NUMERIC_CATEGORY_MAX = 20
TEXT_CATEGORY_MAX = 50
ENCODE_MAX = 1000
THRESHOLDS = (BINARY_MAX, NUMERIC_CATEGORY_MAX, TEXT_CATEGORY_MAX, ENCODE_MAX)

SKETCH_RSD = 0.05
SKETCH_MARGIN = 0.35
LONG_TEXT = 64

PROFILE_SCHEMA = (
    "column string, pos int, dtype string, n_rows long, n_missing long, n_distinct long, "
    "min double, max double, all_numeric boolean, kind string, is_target boolean"
)


def _clean(df: DataFrame, name: str) -> Column:
    c = F.col(quoted(name))
    return nan_to_null(c) if is_fractional(df.schema[name].dataType) else c


def _distinct_key(df: DataFrame, name: str) -> Column:
    """Column whose distinct values are counted; long texts are replaced by their digest."""
    c, data_type = _clean(df, name), df.schema[name].dataType
    cls = type_class(data_type)
    if cls == TEXT:
        return F.when(F.length(c) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(c, 256))).otherwise(c)
    if cls == UNSUPPORTED:
        return F.when(c.isNotNull(), F.lit(0))
    return c


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """One row per distinct value of a column (missing included) with its count."""
    c = _clean(df, name)
    return df.groupBy(c.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def _column_figures(df: DataFrame, pos: int) -> DataFrame:
    """One row of figures for the column at ``pos``: distinct values first, then their totals."""
    field = df.schema.fields[pos]
    cls = type_class(field.dataType)
    bad = ~is_number_text(_clean(df, field.name)) if cls == TEXT else F.lit(None).cast("boolean")
    values = (
        df.select(_distinct_key(df, field.name).alias("value"), bad.alias("bad"))
        .groupBy("value", "bad")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    number = F.col("value").cast("double") if cls == NUMBER else F.lit(None).cast("double")
    total = F.coalesce(F.sum("n"), F.lit(0))
    present = F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0))
    return values.agg(
        F.lit(field.name).alias("column"),
        F.lit(pos).alias("pos"),
        F.lit(field.dataType.simpleString()).alias("dtype"),
        F.lit(cls).alias("cls"),
        total.alias("n_rows"),
        present.alias("n_present"),
        F.count("value").alias("n_distinct"),
        F.min(number).alias("min"),
        F.max(number).alias("max"),
        F.count_if(F.col("bad")).alias("n_bad"),
    )


def _kind(cls: Column, n_present: Column) -> Column:
    d = F.col("n_distinct")
    text_kind = (
        F.when(F.col("all_numeric"), "numerical")
        .when(d <= TEXT_CATEGORY_MAX, "categorical")
        .when(d == F.col("n_rows"), "id")
        .otherwise("text")
    )
    number_kind = (
        F.when((d <= BINARY_MAX) & (F.col("min") >= 0) & (F.col("max") <= 1), "binary")
        .when(d <= NUMERIC_CATEGORY_MAX, "categorical")
        .otherwise("numerical")
    )
    return (
        F.when(n_present == 0, "drop")
        .when(cls == UNSUPPORTED, UNSUPPORTED)
        .when(cls == TEXT, text_kind)
        .when(cls == NUMBER, number_kind)
        .otherwise("numerical")
    )


def _finish(figures: DataFrame) -> DataFrame:
    """Shape per-column figures (column, pos, dtype, cls, n_rows, n_present, ...) as a profile."""
    return (
        figures.withColumn(
            "all_numeric",
            F.when(F.col("cls") == TEXT, (F.col("n_bad") == 0) & (F.col("n_present") > 0)).otherwise(
                F.col("cls") == NUMBER
            ),
        )
        .withColumn("kind", _kind(F.col("cls"), F.col("n_present")))
        .select(
            "column",
            "pos",
            "dtype",
            "n_rows",
            (F.col("n_rows") - F.col("n_present")).alias("n_missing"),
            F.when(F.col("kind") != UNSUPPORTED, F.col("n_distinct")).alias("n_distinct"),
            "min",
            "max",
            "all_numeric",
            "kind",
            F.lit(False).alias("is_target"),
        )
    )


def _exact_profile(df: DataFrame) -> DataFrame:
    parts = [_column_figures(df, pos) for pos in range(len(df.columns))]
    return _finish(reduce(DataFrame.unionByName, parts))


def _scan_figures(df: DataFrame) -> list[tuple]:
    """Counts, ranges and distinct sketches of all columns in one scan."""
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, field in enumerate(df.schema.fields):
        c, cls = _clean(df, field.name), type_class(field.dataType)
        null_double = F.lit(None).cast("double")
        numeric = c.cast("double") if cls == NUMBER else None
        sketch = (
            F.approx_count_distinct(c, SKETCH_RSD)
            if cls in (TEXT, NUMBER, OTHER)
            else F.count_if(c.isNotNull())
        )
        aggregates.append(
            F.struct(
                F.count(c).alias("n_present"),
                sketch.alias("n_distinct"),
                (F.min(numeric) if numeric is not None else null_double).alias("min"),
                (F.max(numeric) if numeric is not None else null_double).alias("max"),
                (F.count_if(~is_number_text(c)) if cls == TEXT else F.lit(0).cast("long")).alias("n_bad"),
            ).alias(f"f{i}")
        )
    row = df.agg(*aggregates).first()
    return [
        (f.name, i, f.dataType.simpleString(), type_class(f.dataType), row["n_rows"], *row[f"f{i}"])
        for i, f in enumerate(df.schema.fields)
    ]


def _undecided(figure: tuple) -> bool:
    """True where the sketch cannot settle which side of a limit the column is on."""
    cls, n_rows, n_present, estimate = figure[3], figure[4], figure[5], figure[6]
    if n_present == 0 or cls not in (TEXT, NUMBER):
        return False
    limits = [*THRESHOLDS, n_rows] if cls == TEXT else [BINARY_MAX, NUMERIC_CATEGORY_MAX]
    return any(abs(estimate - limit) <= SKETCH_MARGIN * limit + 1 for limit in limits)


def _adaptive_profile(df: DataFrame) -> DataFrame:
    figures = _scan_figures(df)
    undecided = [f[0] for f in figures if _undecided(f)]
    exact = {}
    if undecided:
        parts = [_column_figures(df, df.columns.index(name)) for name in undecided]
        counted = reduce(DataFrame.unionByName, parts).select("pos", "n_distinct")
        exact = {r["pos"]: r["n_distinct"] for r in counted.collect()}  # one row per column
    rows = [f[:6] + (exact.get(f[1], f[6]),) + f[7:] for f in figures]
    table = df.sparkSession.createDataFrame(
        rows,
        "column string, pos int, dtype string, cls string, n_rows long, n_present long, "
        "n_distinct long, min double, max double, n_bad long",
    )
    return _finish(table)


def profile(df: DataFrame, distinct: str = "exact") -> DataFrame:
    """Profile of every column; ``distinct`` is ``exact`` or ``adaptive``.

    Kinds agree between the two. With ``adaptive`` the distinct count of a
    column far from every limit is an estimate.
    """
    if distinct == "exact":
        return _exact_profile(df)
    if distinct == "adaptive":
        return _adaptive_profile(df)
    raise ValueError(f"distinct must be 'exact' or 'adaptive', not {distinct!r}")


def mark_target(profiled: DataFrame, target: str) -> DataFrame:
    return profiled.withColumn("is_target", F.col("column") == F.lit(target))


def profile_groups(profiled: DataFrame) -> DataFrame:
    """Column names per group, in table order; id and drop columns are in none."""
    group = (
        F.when(F.col("kind").isin("numerical", "binary"), "numerical")
        .when(F.col("kind") == "categorical", "categorical")
        .when(F.col("kind") == "text", "text")
    )
    return (
        profiled.withColumn("column_group", group)
        .filter(F.col("column_group").isNotNull())
        .groupBy("column_group")
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.transform(
                F.array_sort(F.collect_list(F.struct("pos", "column"))), lambda s: s["column"]
            ).alias("columns"),
        )
    )


def missing_counts(profiled: DataFrame) -> DataFrame:
    """Columns that have missing values, with how many."""
    return profiled.filter(F.col("n_missing") > 0).select("column", "n_missing")


def profile_summary(profiled: DataFrame, target: str | None = None) -> DataFrame:
    """One row: shape, columns per group, types, target, missing counts."""

    def names(keep: Column) -> Column:
        kept = F.array_sort(F.collect_list(F.when(keep, F.struct("pos", "column"))))
        return F.transform(kept, lambda s: s["column"])

    kind = F.col("kind")
    return profiled.agg(
        F.max("n_rows").alias("n_rows"),
        F.count(F.lit(1)).alias("n_columns"),
        names(F.lit(True)).alias("columns"),
        names(kind.isin("numerical", "binary")).alias("numerical"),
        names(kind == "categorical").alias("categorical"),
        names(kind == "text").alias("text"),
        F.map_from_entries(F.collect_list(F.struct("column", "kind"))).alias("types"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("n_missing") > 0, F.struct("column", "n_missing")))
        ).alias("missing"),
        F.lit(target).alias("target"),
    )


def feature_columns(profiled: DataFrame, target: str) -> DataFrame:
    """Usable feature columns with their group, target left out."""
    group = (
        F.when(F.col("kind").isin("numerical", "binary"), "numerical")
        .when(F.col("kind") == "categorical", "categorical")
        .when(F.col("kind") == "text", "text")
    )
    return (
        profiled.filter(F.col("column") != target)
        .select("column", "pos", group.alias("column_group"))
        .filter(F.col("column_group").isNotNull())
    )


def drop_columns(profiled: DataFrame, target: str) -> DataFrame:
    """Columns to drop: empty ones, and identifiers other than the target."""
    kind = F.col("kind")
    return profiled.filter(
        (kind == "drop") | ((kind == "id") & (F.col("column") != target))
    ).select("column", "pos", "kind")
