"""Derived inputs, stated once for Spark and once for SQL.

The given tables hold no missing values, numeric texts or passenger columns, so
the views derive such columns from whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from suite import table

# Column names of the given tables by type class: n number, t text, o other, u unsupported.
COLUMNS = {
    "region": "r_regionkey:n r_name:t",
    "nation": "n_nationkey:n n_name:t n_regionkey:n",
    "customer": "c_custkey:n c_name:t c_nationkey:n c_acctbal:n c_mktsegment:t",
    "supplier": "s_suppkey:n s_name:t s_nationkey:n s_acctbal:n",
    "part": "p_partkey:n p_name:t p_brand:t p_type:t p_size:n p_retailprice:n",
    "orders": "o_orderkey:n o_custkey:n o_orderstatus:t o_totalprice:n o_orderdate:o o_orderpriority:t",
    "lineitem": "l_orderkey:n l_partkey:n l_suppkey:n l_linenumber:n l_quantity:n l_extendedprice:n "
    "l_discount:n l_tax:n l_returnflag:t l_linestatus:t l_shipdate:o",
    "events": "event_id:n ts:o user_id:n event_type:t value:n props:t",
    "documents": "doc_id:n text:t lang:t source:t n_chars:n",
    "embeddings": "vec_id:n embedding:u label:n",
    "pages": "page_id:n url:t html:t",
    "benchmark": "item_id:n text:t",
    "labels": "doc_id:n quality:n toxic:n",
    "conversations": "conv_id:n turn:n role:t text:t",
}

NUMBER_SQL = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def columns_of(name: str) -> list[tuple[str, str]]:
    return [tuple(c.split(":")) for c in COLUMNS[name].split()]


def profile_sql(source: str, columns: list[tuple[str, str]]) -> str:
    """SELECT giving one profile row per column of ``source``."""
    parts = []
    for pos, (name, cls) in enumerate(columns):
        c = f'"{name}"'
        numeric = cls == "n"
        low = f"CAST(min({c}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        high = f"CAST(max({c}) AS DOUBLE)" if numeric else "CAST(NULL AS DOUBLE)"
        distinct = "CAST(NULL AS BIGINT)" if cls == "u" else f"count(DISTINCT {c})"
        if cls == "t":
            bad = f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT regexp_matches({c}, '{NUMBER_SQL}'))"
            all_numeric = f"({bad} = 0 AND count({c}) > 0)"
            kind = (
                f"CASE WHEN count({c}) = 0 THEN 'drop' WHEN {bad} = 0 THEN 'numerical' "
                f"WHEN {distinct} <= 50 THEN 'categorical' WHEN {distinct} = count(*) THEN 'id' ELSE 'text' END"
            )
        elif cls == "n":
            all_numeric = "true"
            kind = (
                f"CASE WHEN count({c}) = 0 THEN 'drop' "
                f"WHEN {distinct} <= 10 AND min({c}) >= 0 AND max({c}) <= 1 THEN 'binary' "
                f"WHEN {distinct} <= 20 THEN 'categorical' ELSE 'numerical' END"
            )
        else:
            all_numeric = "false"
            other = "unsupported" if cls == "u" else "numerical"
            kind = f"CASE WHEN count({c}) = 0 THEN 'drop' ELSE '{other}' END"
        parts.append(
            f"SELECT '{name}' AS \"column\", {pos} AS pos, count(*) AS n_rows, "
            f"count(*) - count({c}) AS n_missing, {distinct} AS n_distinct, {low} AS min, {high} AS max, "
            f"{all_numeric} AS all_numeric, {kind} AS kind FROM {source}"
        )
    return "\nUNION ALL\n".join(parts)


# lineitem with missing quantities and line numbers and one empty column
LINEITEM_NULLS_COLUMNS = [*columns_of("lineitem"), ("empty", "t")]
LINEITEM_NULLS_SQL = """(SELECT * REPLACE (
    CASE WHEN l_orderkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber),
    CAST(NULL AS VARCHAR) AS empty FROM lineitem)"""


def lineitem_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("l_quantity", F.when(F.col("l_orderkey") % 7 != 0, F.col("l_quantity")))
        .withColumn("l_linenumber", F.when(F.col("l_orderkey") % 11 != 0, F.col("l_linenumber")))
        .withColumn("empty", F.lit(None).cast("string"))
    )


# customer with its nation spelled as text: clean, with missing tokens, with texts that are no number
NUMERIC_TEXT_COLUMNS = [("c_custkey", "n"), ("clean", "t"), ("with_na", "t"), ("with_bad", "t")]
NUMERIC_TEXT_SQL = """(SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS clean,
    CASE WHEN c_custkey % 5 = 0 THEN 'NA' ELSE CAST(c_nationkey AS VARCHAR) END AS with_na,
    CASE WHEN c_custkey % 5 = 0 THEN '1d' WHEN c_custkey % 5 = 1 THEN 'nan'
         ELSE CAST(c_nationkey AS VARCHAR) END AS with_bad FROM customer)"""


def numeric_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, text = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    return table(spark, sf_dir, "customer").select(
        key,
        text.alias("clean"),
        F.when(key % 5 == 0, "NA").otherwise(text).alias("with_na"),
        F.when(key % 5 == 0, "1d").when(key % 5 == 1, "nan").otherwise(text).alias("with_bad"),
    )


# customer dressed up as a passenger list
PASSENGERS_SQL = """(SELECT c_custkey,
    CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment || ', ' ||
        (['Mr.', 'Miss.', 'Dr.', 'Sir.', 'Zed.', 'none'])[CAST(c_custkey % 6 AS INTEGER) + 1] || ' X' END AS "Name",
    CASE WHEN c_custkey % 3 = 0 THEN chr(CAST(65 + c_custkey % 5 AS INTEGER)) || CAST(c_nationkey AS VARCHAR) END AS "Cabin",
    (['A/5 21171', '113803', 'PC 17599', 'LINE', 'STON/O2. 31'])[CAST(c_custkey % 5 AS INTEGER) + 1] AS "Ticket",
    CASE WHEN c_custkey % 17 <> 0 THEN c_nationkey % 3 END AS "SibSp",
    c_custkey % 2 AS "Parch", c_acctbal AS "Fare",
    CASE WHEN c_acctbal > 5000 THEN 1 ELSE 0 END AS survived FROM customer)"""

TITLES = ["Mr.", "Miss.", "Dr.", "Sir.", "Zed.", "none"]
TICKETS = ["A/5 21171", "113803", "PC 17599", "LINE", "STON/O2. 31"]


def passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")

    def pick(values, index):
        return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))

    return table(spark, sf_dir, "customer").select(
        key,
        F.when(
            key % 13 != 0, F.concat("c_mktsegment", F.lit(", "), pick(TITLES, key % 6), F.lit(" X"))
        ).alias("Name"),
        F.when(
            key % 3 == 0, F.concat(F.chr(65 + key % 5), F.col("c_nationkey").cast("string"))
        ).alias("Cabin"),
        pick(TICKETS, key % 5).alias("Ticket"),
        F.when(key % 17 != 0, F.col("c_nationkey") % 3).alias("SibSp"),
        (key % 2).alias("Parch"),
        F.col("c_acctbal").alias("Fare"),
        F.when(F.col("c_acctbal") > 5000, 1).otherwise(0).alias("survived"),
    )
