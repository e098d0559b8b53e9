"""Profile, target and task queries."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from suite import query, table
from suite.views import (
    COLUMNS,
    LINEITEM_NULLS_COLUMNS,
    LINEITEM_NULLS_SQL,
    NUMERIC_TEXT_COLUMNS,
    NUMERIC_TEXT_SQL,
    columns_of,
    lineitem_nulls,
    numeric_text,
    profile_sql,
)
from tabwright.functions.values import NA_TOKENS
from tabwright.operators import profile as P
from tabwright.operators import target as TG
from tabwright.sources.csv import normalize_missing

SHOWN = ["column", "pos", "n_rows", "n_missing", "n_distinct", "min", "max", "all_numeric", "kind"]

LINEITEM_PROFILE_SQL = profile_sql("lineitem", columns_of("lineitem"))
NULLS_PROFILE_SQL = profile_sql(LINEITEM_NULLS_SQL, LINEITEM_NULLS_COLUMNS)
TOKENS_SQL = ", ".join("'" + t + "'" for t in NA_TOKENS)
NORMALIZED_SQL = f"""(SELECT c_custkey,
    CASE WHEN clean NOT IN ({TOKENS_SQL}) THEN clean END AS clean,
    CASE WHEN with_na NOT IN ({TOKENS_SQL}) THEN with_na END AS with_na,
    CASE WHEN with_bad NOT IN ({TOKENS_SQL}) THEN with_bad END AS with_bad FROM {NUMERIC_TEXT_SQL})"""


def profiled_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """Sketch-first profile of every table; small jobs of several tables run side by side."""
    with ThreadPoolExecutor(6) as pool:
        found = pool.map(lambda t: P.profile(table(spark, sf_dir, t), distinct="adaptive"), COLUMNS)
        return dict(zip(COLUMNS, found))


def union_all(parts) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


@query("profile_columns", LINEITEM_PROFILE_SQL)
def profile_columns(spark, sf_dir):
    return P.profile(table(spark, sf_dir, "lineitem")).select(*SHOWN)


@query("profile_columns_with_nulls", NULLS_PROFILE_SQL)
def profile_columns_with_nulls(spark, sf_dir):
    return P.profile(lineitem_nulls(spark, sf_dir)).select(*SHOWN)


@query("profile_documents", profile_sql("documents", columns_of("documents")))
def profile_documents(spark, sf_dir):
    return P.profile(table(spark, sf_dir, "documents")).select(*SHOWN)


@query(
    "profile_kinds",
    "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, \"column\", kind FROM ({profile_sql(t, columns_of(t))})" for t in COLUMNS
    ),
)
def profile_kinds(spark, sf_dir):
    """Kinds of every column of every table by the sketch-first profile."""
    return union_all(
        profiled.select(F.lit(t).alias("table_name"), "column", "kind")
        for t, profiled in profiled_tables(spark, sf_dir).items()
    )


@query("profile_numeric_strings", profile_sql(NORMALIZED_SQL, NUMERIC_TEXT_COLUMNS))
def profile_numeric_strings(spark, sf_dir):
    return P.profile(normalize_missing(numeric_text(spark, sf_dir))).select(*SHOWN)


@query("normalize_missing", f"SELECT * FROM {NORMALIZED_SQL}")
def normalized(spark, sf_dir):
    return normalize_missing(numeric_text(spark, sf_dir))


@query(
    "profile_groups",
    f"""SELECT column_group, count(*) AS n_columns, string_agg("column", ',' ORDER BY pos) AS columns
    FROM (SELECT *, CASE WHEN kind IN ('numerical', 'binary') THEN 'numerical'
        WHEN kind IN ('categorical', 'text') THEN kind END AS column_group FROM ({LINEITEM_PROFILE_SQL}))
    WHERE column_group IS NOT NULL GROUP BY column_group""",
)
def profile_groups(spark, sf_dir):
    groups = P.profile_groups(P.profile(table(spark, sf_dir, "lineitem")))
    return groups.withColumn("columns", F.array_join("columns", ","))


@query(
    "missing_counts",
    f'SELECT "column", n_missing FROM ({NULLS_PROFILE_SQL}) WHERE n_missing > 0',
)
def missing_counts(spark, sf_dir):
    return P.missing_counts(P.profile(lineitem_nulls(spark, sf_dir)))


@query(
    "profile_summary",
    f"""SELECT max(n_rows) AS n_rows, count(*) AS n_columns,
    string_agg("column", ',' ORDER BY pos) FILTER (WHERE kind IN ('numerical', 'binary')) AS numerical,
    string_agg("column", ',' ORDER BY pos) FILTER (WHERE kind = 'categorical') AS categorical,
    coalesce(string_agg("column", ',' ORDER BY pos) FILTER (WHERE kind = 'text'), '') AS text,
    string_agg("column" || '=' || n_missing, ',' ORDER BY "column") FILTER (WHERE n_missing > 0) AS missing,
    'l_returnflag' AS target FROM ({NULLS_PROFILE_SQL})""",
)
def profile_summary(spark, sf_dir):
    summary = P.profile_summary(P.profile(lineitem_nulls(spark, sf_dir)), "l_returnflag")
    missing = F.transform(
        F.array_sort(F.map_entries("missing")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return summary.select(
        "n_rows",
        "n_columns",
        F.array_join("numerical", ",").alias("numerical"),
        F.array_join("categorical", ",").alias("categorical"),
        F.array_join("text", ",").alias("text"),
        F.array_join(missing, ",").alias("missing"),
        "target",
    )


def infer_target_sql(name: str, by_kind: bool = True, names=TG.TARGET_NAMES) -> str:
    ranks = " ".join(f"WHEN lower(\"column\") = '{n}' THEN {i}" for i, n in enumerate(names))
    middle = (
        "WHEN kind IN ('categorical', 'binary') AND n_distinct <= 20 THEN 1000 - pos "
        "WHEN kind <> 'id' THEN 2000 - pos"
        if by_kind
        else ""
    )
    return (
        f"SELECT '{name}' AS table_name, arg_min(\"column\", CASE {ranks} {middle} ELSE 3000 - pos END) AS target "
        f"FROM ({profile_sql(name, columns_of(name))})"
    )


@query("infer_target", "\nUNION ALL\n".join(infer_target_sql(t) for t in COLUMNS))
def infer_target(spark, sf_dir):
    return union_all(
        TG.infer_target(profiled).select(F.lit(t).alias("table_name"), "target")
        for t, profiled in profiled_tables(spark, sf_dir).items()
    )


@query(
    "infer_target_names_only",
    "\nUNION ALL\n".join(infer_target_sql(t, False, TG.SEARCH_TARGET_NAMES) for t in COLUMNS),
)
def infer_target_names_only(spark, sf_dir):
    return union_all(
        TG.infer_target(profiled, names=TG.SEARCH_TARGET_NAMES, by_kind=False).select(
            F.lit(t).alias("table_name"), "target"
        )
        for t, profiled in profiled_tables(spark, sf_dir).items()
    )


def classes_sql(label: str, source: str) -> str:
    return f"""SELECT '{label}' AS label, count(DISTINCT {label}) AS n_classes,
        CASE WHEN count(DISTINCT {label}) <= 20 THEN
            (SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) FROM (SELECT DISTINCT {label} AS v FROM {source} WHERE {label} IS NOT NULL)) END AS classes,
        CASE WHEN count(DISTINCT {label}) <= 20 THEN 'classification' ELSE 'regression' END AS target_type FROM {source}"""


CLASS_TARGETS = [
    ("quality", "labels"),
    ("l_returnflag", "lineitem"),
    ("l_linenumber", "lineitem"),
    ("l_partkey", "lineitem"),
    ("label", "embeddings"),
]


@query("target_classes", "\nUNION ALL\n".join(classes_sql(*t) for t in CLASS_TARGETS))
def target_classes(spark, sf_dir):
    return union_all(
        TG.target_classes(table(spark, sf_dir, t), label).select(
            F.lit(label).alias("label"),
            "n_classes",
            F.array_join(F.col("classes").cast("array<string>"), ",").alias("classes"),
            "target_type",
        )
        for label, t in CLASS_TARGETS
    )


TASK_TARGETS = [*CLASS_TARGETS, ("l_tax", "lineitem"), ("o_totalprice", "orders")]
FLOAT_TARGETS = ("l_tax", "o_totalprice")


@query(
    "detect_task",
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS label, count(DISTINCT {c}) AS n_classes, CASE WHEN count(DISTINCT {c}) > 20 "
        f"OR {str(c in FLOAT_TARGETS).lower()} THEN 'regression' ELSE 'classification' END AS task FROM {t}"
        for c, t in TASK_TARGETS
    ),
)
def detect_task(spark, sf_dir):
    return union_all(
        TG.detect_task(table(spark, sf_dir, t), c).select(F.lit(c).alias("label"), "n_classes", "task")
        for c, t in TASK_TARGETS
    )


@query(
    "feature_columns",
    "SELECT \"column\", pos, CASE WHEN kind IN ('numerical', 'binary') THEN 'numerical' ELSE kind END AS column_group "
    f"FROM ({profile_sql('customer', columns_of('customer'))}) "
    "WHERE \"column\" <> 'c_mktsegment' AND kind IN ('numerical', 'binary', 'categorical', 'text')",
)
def feature_columns(spark, sf_dir):
    return P.feature_columns(P.profile(table(spark, sf_dir, "customer"), distinct="adaptive"), "c_mktsegment")


@query(
    "drop_columns",
    f"""SELECT 'customer' AS table_name, "column", kind FROM ({profile_sql('customer', columns_of('customer'))})
    WHERE kind = 'drop' OR (kind = 'id' AND "column" <> 'c_mktsegment')
    UNION ALL SELECT 'lineitem_nulls', "column", kind FROM ({NULLS_PROFILE_SQL})
    WHERE kind = 'drop' OR (kind = 'id' AND "column" <> 'l_returnflag')""",
)
def drop_columns(spark, sf_dir):
    customer = P.profile(table(spark, sf_dir, "customer"), distinct="adaptive")
    nulls = P.profile(lineitem_nulls(spark, sf_dir), distinct="adaptive")
    return union_all(
        [
            P.drop_columns(customer, "c_mktsegment").select(F.lit("customer").alias("table_name"), "column", "kind"),
            P.drop_columns(nulls, "l_returnflag").select(F.lit("lineitem_nulls").alias("table_name"), "column", "kind"),
        ]
    )
