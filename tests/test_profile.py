"""Kinds at their limits, missing values, numeric texts and target choice."""

import pytest
from pyspark.sql import functions as F

from tabwright.operators import profile as P
from tabwright.operators import target as TG
from tabwright.sources.csv import header_names, infer_types, load_csv, normalize_missing


def kinds(df, distinct):
    return {r["column"]: r for r in P.profile(df, distinct).collect()}


@pytest.fixture(scope="module")
def limits(spark):
    i = F.col("id")
    return spark.range(2000).select(
        *[F.concat(F.lit("v"), i % n).alias(f"t{n}") for n in (10, 11, 50, 51, 999, 1000)],
        *[(i % n).alias(f"n{n}") for n in (2, 10, 11, 20, 21)],
        ((i % 10) / 9.0).alias("unit10"),
        ((i % 11) / 10.0).alias("unit11"),
        F.concat(F.lit("k"), i).alias("key"),
        F.when(i > 0, F.concat(F.lit("k"), i)).alias("key_with_null"),
        F.lit(None).cast("string").alias("empty"),
        F.when(i % 2 == 0, float("nan")).otherwise(i % 2).alias("with_nan"),
        i.cast("string").alias("digits"),
        (i % 2 == 0).alias("flag"),
        F.array(i).alias("list"),
        F.current_timestamp().alias("moment"),
    )


@pytest.mark.parametrize("distinct", ["exact", "adaptive"])
def test_kinds_at_limits(limits, distinct):
    want = {
        "t10": "categorical",
        "t11": "categorical",
        "t50": "categorical",
        "t51": "text",
        "t999": "text",
        "t1000": "text",
        "n2": "binary",
        "n10": "categorical",
        "n11": "categorical",
        "n20": "categorical",
        "n21": "numerical",
        "unit10": "binary",
        "unit11": "categorical",
        "key": "id",
        "key_with_null": "text",
        "empty": "drop",
        "with_nan": "binary",
        "digits": "numerical",
        "flag": "numerical",
        "list": "unsupported",
        "moment": "numerical",
    }
    got = kinds(limits, distinct)
    assert {c: got[c]["kind"] for c in want} == want
    assert got["t999"]["n_distinct"] == 999 and got["t1000"]["n_distinct"] == 1000
    assert got["with_nan"]["n_missing"] == 1000 and got["with_nan"]["n_distinct"] == 1
    assert got["key_with_null"]["n_missing"] == 1


def test_long_texts_that_share_a_prefix_differ(spark):
    df = spark.range(60).select(F.concat(F.repeat(F.lit("x"), 500), F.col("id")).alias("t"))
    assert kinds(df, "exact")["t"]["n_distinct"] == 60


def test_empty_table(spark):
    for distinct in ("exact", "adaptive"):
        got = kinds(spark.createDataFrame([], "a string, b double"), distinct)
        assert got["a"]["kind"] == got["b"]["kind"] == "drop"
        assert got["a"]["n_rows"] == 0


def test_number_spellings(spark):
    good = ["1", " 2 ", "-3.5", "+4", ".5", "6.", "1e5", "-inf", "Infinity"]
    bad = ["nan", "1d", "0x10", "1,000", "", "e5", "."]
    df = spark.createDataFrame([(x,) for x in good], "t string")
    assert kinds(df, "exact")["t"]["kind"] == "numerical"
    for b in bad:
        one = df.union(spark.createDataFrame([(b,)], "t string"))
        assert kinds(one, "exact")["t"]["kind"] == "categorical", b


def test_target_order(spark):
    def pick(ddl, rows, **kw):
        return TG.infer_target(P.profile(spark.createDataFrame(rows, ddl)), **kw).first()[0]

    rows = [(float(i), i % 2, f"k{i}") for i in range(60)]
    assert pick("x double, b long, k string", rows) == "b"
    assert pick("Price double, b long, Label string", rows) == "Label"
    assert pick("Survived double, y long, k string", rows) == "y"
    assert pick("x double, b long, k string", rows, by_kind=False) == "k"
    assert pick("x double, b long, k string", rows, target="elsewhere") == "elsewhere"
    ids = [(float(i), f"k{i}") for i in range(60)]
    assert pick("x double, k string", ids) == "x"
    assert pick("k string", [(f"k{i}",) for i in range(60)]) == "k"


def test_task_rules(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("a"), (F.col("id") % 2).cast("double").alias("b"), "id")
    task = {c: TG.detect_task(df, c).first()["task"] for c in df.columns}
    assert task == {"a": "classification", "b": "regression", "id": "regression"}
    row = TG.target_classes(df, "id").first()
    assert row["n_classes"] == 100 and row["classes"] is None and row["target_type"] == "regression"


def test_missing_tokens(spark):
    df = spark.createDataFrame([("NA", 1.0), ("", float("nan")), ("None", None), ("na", 2.0)], "t string, x double")
    rows = normalize_missing(df).collect()
    assert [r["t"] for r in rows] == [None, None, None, "na"]
    assert [r["x"] for r in rows] == [1.0, None, None, 2.0]


def test_header_names():
    assert header_names(["a", "a", None, "a", "b"]) == ["a", "a.1", "Unnamed: 2", "a.2", "b"]


def test_csv_with_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,a,t,flag,f\n1,2,"line one\nline ""two""",True,1.5\n3,NA,"x,y",False,\n')
    df = load_csv(spark, str(path))
    assert df.columns == ["a", "a.1", "t", "flag", "f"]
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "bigint", "string", "boolean", "double"]
    rows = df.collect()
    assert rows[0]["t"] == 'line one\nline "two"' and rows[1]["a.1"] is None and rows[1]["t"] == "x,y"


def test_csv_separator(spark, tmp_path):
    path = tmp_path / "y.csv"
    path.write_text("a;b\n1;x\n2;y\n")
    assert load_csv(spark, str(path), sep=";").collect() == [(1, "x"), (2, "y")]


def test_types_need_every_value(spark):
    df = spark.createDataFrame([("1", "1.5", "x"), ("2", "z", None)], "a string, b string, c string")
    assert [t for _, t in infer_types(df).dtypes] == ["bigint", "string", "string"]
