"""CSV input: text scan, missing tokens, inferred types."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.schema import TEXT, is_fractional, quoted, type_class
from tabwright.functions.values import (
    BOOLEAN_TEXTS,
    INTEGER_PATTERN,
    is_number_text,
    missing_to_null,
    nan_to_null,
    number_from_text,
)


def normalize_missing(df: DataFrame) -> DataFrame:
    """Turn missing tokens in texts and NaN in floats into null; one projection."""
    out = []
    for field in df.schema.fields:
        c = F.col(quoted(field.name))
        if type_class(field.dataType) == TEXT:
            c = missing_to_null(c)
        elif is_fractional(field.dataType):
            c = nan_to_null(c)
        out.append(c.alias(field.name))
    return df.select(*out)


def header_names(raw: list[str | None]) -> list[str]:
    """Column names for a header row: repeats get .1, .2, ...; blanks a position name."""
    names, seen = [], Counter()
    for i, name in enumerate(raw):
        name = f"Unnamed: {i}" if name in (None, "") else name
        unique = name
        while unique in seen:
            unique = f"{name}.{seen[name]}"
            seen[name] += 1
        seen[unique] += 1
        names.append(unique)
    return names


def _has_quoted_newlines(spark: SparkSession, path: str) -> bool:
    """True if some line holds an odd number of quotes, so a record spans lines."""
    quotes = F.length(F.regexp_replace("value", '[^"]', ""))
    return not spark.read.text(path).filter(quotes % 2 == 1).isEmpty()


def load_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    multi_line: bool | None = None,
    typed: bool = True,
) -> DataFrame:
    """Read CSV files with a header, missing tokens as null and inferred types.

    Records that span lines force one task per file. ``multi_line=None`` looks
    for such records first, so files without them are read in splits.
    """
    if multi_line is None:
        multi_line = _has_quoted_newlines(spark, path)
    options = {
        "sep": sep,
        "quote": '"',
        "escape": '"',
        "multiLine": multi_line,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
    }
    head = spark.read.options(header=False, **options).csv(path).first()
    names = header_names(list(head) if head is not None else [])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.options(header=True, enforceSchema=True, **options).schema(schema).csv(path)
    raw = normalize_missing(raw)
    return infer_types(raw) if typed else raw


def infer_types(df: DataFrame) -> DataFrame:
    """Cast text columns to long, double or boolean where every value allows it.

    One aggregate over all columns; its single row has a few numbers per column.
    """
    names = [f.name for f in df.schema.fields if type_class(f.dataType) == TEXT]
    if not names:
        return df
    tests = []
    for i, name in enumerate(names):
        c = F.col(quoted(name))
        tests.append(
            F.struct(
                F.count(c).alias("present"),
                F.count_if(c.rlike(INTEGER_PATTERN)).alias("whole"),
                F.count_if(is_number_text(c)).alias("number"),
                F.count_if(c.isin(BOOLEAN_TEXTS)).alias("truth"),
            ).alias(f"t{i}")
        )
    row = df.agg(*tests).first()
    verdict = {name: row[f"t{i}"] for i, name in enumerate(names)}
    out = []
    for field in df.schema.fields:
        c, v = F.col(quoted(field.name)), verdict.get(field.name)
        if v is not None and v["present"] > 0:
            if v["whole"] == v["present"]:
                c = F.trim(c).cast("long")
            elif v["number"] == v["present"]:
                c = number_from_text(c)
            elif v["truth"] == v["present"]:
                c = F.lower(c) == "true"
        out.append(c.alias(field.name))
    return df.select(*out)
