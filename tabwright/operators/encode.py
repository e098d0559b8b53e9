"""Label codes, imputation, scaling and one-hot columns.

Fitting is an aggregate that yields a small table of statistics; applying it is
one projection (plus a broadcast join of at most 1000 rows per coded column).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions.schema import RESERVED, TEXT, quoted, type_class
from tabwright.functions.values import label_text, nan_to_null, number_from_text
from tabwright.operators.order import exact_quantiles, global_rank, hot_key_join
from tabwright.operators.profile import ENCODE_MAX

STATS_SCHEMA = "column string, pos int, role string, stat string, num double, txt string"
MAX_CATEGORIES = 1000
LABEL_TEXT, LABEL_ROWS = f"{RESERVED}label_text", f"{RESERVED}label_rows"


# ---- label codes -----------------------------------------------------------------------------


def label_codes(df: DataFrame, column: str) -> tuple[DataFrame, bool]:
    """(value, n, code): codes rank the distinct label texts; and whether there are under 1000.

    Up to 1000 values are fetched and sorted. More are ranked by a distributed
    sort, so no task ever holds them all.
    """
    text = label_text(F.col(quoted(column)), df.schema[column].dataType.simpleString())
    values = df.groupBy(text.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    head = values.limit(MAX_CATEGORIES + 1).collect()
    if len(head) > MAX_CATEGORIES:
        ranked = global_rank(values, [F.col("value")], "code")
        return ranked.withColumn("code", F.col("code") - 1), False
    rows = [(v, n, code) for code, (v, n) in enumerate(sorted((r["value"], r["n"]) for r in head))]
    return df.sparkSession.createDataFrame(rows, "value string, n long, code long"), True


def label_encode(
    df: DataFrame,
    column: str,
    output: str,
    codes: DataFrame | None = None,
    handle_invalid: str = "error",
) -> DataFrame:
    """Add ``output`` with the code of each label.

    Values outside the codes raise (``error``) or get the next free code (``keep``).
    """
    if handle_invalid not in ("error", "keep"):
        raise ValueError(f"handle_invalid must be 'error' or 'keep', not {handle_invalid!r}")
    text = label_text(F.col(quoted(column)), df.schema[column].dataType.simpleString())
    if codes is None:
        codes, few = label_codes(df, column)
        keyed = codes.withColumnRenamed("value", LABEL_TEXT).withColumnRenamed("code", output)
        tagged = df.withColumn(LABEL_TEXT, text)
        if few:
            return tagged.join(F.broadcast(keyed.drop("n")), LABEL_TEXT).drop(LABEL_TEXT)
        return hot_key_join(tagged, keyed, LABEL_TEXT, "n").drop(LABEL_TEXT)
    known = codes.count()
    keyed = codes.select(F.col("value").alias(LABEL_TEXT), F.col("code").alias(output))
    tagged = df.withColumn(LABEL_TEXT, text)
    if known <= MAX_CATEGORIES:
        joined = tagged.join(F.broadcast(keyed), LABEL_TEXT, "left")
    else:
        # the rows at hand tell which labels are hot, ``nan`` often; unseen ones have no code
        sizes = tagged.groupBy(LABEL_TEXT).agg(F.count(F.lit(1)).alias(LABEL_ROWS))
        joined = hot_key_join(tagged, sizes.join(keyed, LABEL_TEXT, "left"), LABEL_TEXT, LABEL_ROWS)
    if handle_invalid == "keep":
        free = F.lit(known).cast("long")
        return joined.withColumn(output, F.coalesce(F.col(output), free)).drop(LABEL_TEXT)
    unseen = F.raise_error(F.concat(F.lit(f"{column}: label not seen in fit: "), F.col(LABEL_TEXT)))
    return joined.withColumn(output, F.coalesce(F.col(output), unseen.cast("long"))).drop(LABEL_TEXT)


# ---- fitted statistics -----------------------------------------------------------------------


def numeric_value(df: DataFrame, name: str) -> Column:
    """Double form of a feature: numeric texts parsed, times as epoch seconds, NaN as null."""
    c, data_type = F.col(quoted(name)), df.schema[name].dataType
    if type_class(data_type) == TEXT:
        return number_from_text(c)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("timestamp").cast("double")
    c = c.cast("double") if not isinstance(data_type, T.BooleanType) else c.cast("int").cast("double")
    return nan_to_null(c)


def _most_frequent(df: DataFrame, name: str) -> float | None:
    """Most frequent number, ties to the smallest; counts are spread by value."""
    counts = (
        df.select(numeric_value(df, name).alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy("v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return counts.agg(F.max_by("v", F.struct(F.col("n"), -F.col("v")))).first()[0]


def impute_values(
    df: DataFrame, columns: Sequence[str], strategy: str = "median", fill_value: float = 0.0
) -> dict[str, float]:
    """Fill value per numeric column."""
    view = df.select(*[numeric_value(df, c).alias(c) for c in columns])
    if strategy == "median":
        found, _ = exact_quantiles(view, columns, [0.5])
        fills = {c: found[(c, 0.5)] for c in columns}
    elif strategy == "mean":
        row = view.agg(*[F.avg(F.col(quoted(c))).alias(c) for c in columns]).first()
        fills = {c: row[c] for c in columns}
    elif strategy == "most_frequent":
        fills = {c: _most_frequent(view, c) for c in columns}
    elif strategy == "constant":
        fills = {c: fill_value for c in columns}
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    return {c: 0.0 if v is None else v for c, v in fills.items()}


def _numeric_stats(df: DataFrame, columns: Sequence[str], fills: dict[str, float]) -> list[tuple]:
    """Mean and population deviation of the filled columns, from one aggregate."""
    moments = []
    for i, c in enumerate(columns):
        filled = F.coalesce(numeric_value(df, c), F.lit(float(fills[c])))
        moments.append(F.struct(F.avg(filled), F.stddev_pop(filled)).alias(f"m{i}"))
    row = df.agg(*moments).first()
    rows = []
    for i, c in enumerate(columns):
        mean, sd = row[f"m{i}"]
        rows.append((c, i, "numeric", "fill", float(fills[c]), None))
        rows.append((c, i, "numeric", "mean", mean, None))
        rows.append((c, i, "numeric", "scale", sd if sd else 1.0, None))
    return rows


def _category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(i, num, txt, n) for the distinct values of each categorical column."""
    parts = []
    for i, name in enumerate(columns):
        c, is_text = F.col(quoted(name)), type_class(df.schema[name].dataType) == TEXT
        num = F.lit(None).cast("double") if is_text else numeric_value(df, name)
        txt = c.cast("string") if is_text else F.lit(None).cast("string")
        parts.append(
            df.select(num.alias("num"), txt.alias("txt"))
            .filter(F.coalesce(F.col("num").cast("string"), F.col("txt")).isNotNull())
            .groupBy("num", "txt")
            .agg(F.count(F.lit(1)).alias("n"))
            .limit(MAX_CATEGORIES + 1)
            .select(F.lit(i).alias("i"), "num", "txt", "n")
        )
    return reduce(DataFrame.unionByName, parts)


def _category_stats(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """Sorted categories and the mode (ties to the smallest) of each column.

    A categorical column has few values by its kind; one with over 1000 is refused.
    """
    found: dict[int, list] = {}
    for r in _category_counts(df, columns).collect():
        found.setdefault(r["i"], []).append((r["num"], r["txt"], r["n"]))
    rows = []
    for i, c in enumerate(columns):
        values = sorted(found.get(i, []), key=lambda v: (v[0] if v[0] is not None else 0.0, v[1] or ""))
        if len(values) > MAX_CATEGORIES:
            raise ValueError(f"{c}: too many categories for one-hot columns")
        if values:
            top = max(v[2] for v in values)
            mode = next(v for v in values if v[2] == top)
            rows.append((c, i, "onehot", "mode", mode[0], mode[1]))
        rows += [(c, i, "onehot", f"category_{k}", v[0], v[1]) for k, v in enumerate(values)]
    return rows


@dataclass
class FittedStats:
    """Fitted statistics; a few rows per column, saved as a table."""

    rows: list[tuple]
    types: dict[str, str] = field(default_factory=dict)

    def table(self, spark: SparkSession) -> DataFrame:
        kinds = [(c, -1, "type", t, None, None) for c, t in self.types.items()]
        return spark.createDataFrame(self.rows + kinds, STATS_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.table(spark).coalesce(1).write.mode("errorifexists").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FittedStats:
        rows = [tuple(r) for r in spark.read.parquet(path).collect()]
        return cls(
            sorted(r for r in rows if r[2] != "type"),
            {r[0]: r[3] for r in rows if r[2] == "type"},
        )

    def _stat(self, role: str) -> dict[str, dict[str, tuple]]:
        out: dict[str, dict[str, tuple]] = {}
        for c, _, r, stat, num, txt in sorted(
            (x for x in self.rows if x[2] == role), key=lambda x: (x[1], x[0])
        ):
            out.setdefault(c, {})[stat] = (num, txt)
        return out

    @property
    def numeric(self) -> dict[str, dict[str, tuple]]:
        return self._stat("numeric")

    @property
    def onehot(self) -> dict[str, dict[str, tuple]]:
        return self._stat("onehot")

    @property
    def coded(self) -> dict[str, dict[str, tuple]]:
        return self._stat("coded")

    def categories(self, column: str) -> list[tuple]:
        stats = self.onehot[column]
        return [stats[f"category_{k}"] for k in range(sum(s.startswith("category_") for s in stats))]


def fit_stats(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    strategy: str = "median",
    coded: Sequence[str] = (),
) -> FittedStats:
    """Fit label codes, imputation, scaling and one-hot categories on ``df``.

    ``coded`` names text columns that become ``<name>_encoded`` numbers.
    """
    types = {c: df.schema[c].dataType.simpleString() for c in [*numeric, *categorical, *coded]}
    rows: list[tuple] = []
    for i, c in enumerate(coded):
        codes, few = label_codes(df, c)
        if not few:
            raise ValueError(f"{c}: only columns with fewer than {ENCODE_MAX} values are coded")
        rows += [(c, i, "coded", r["value"], float(r["code"]), None) for r in codes.collect()]
    coded_stats = FittedStats(rows, types)
    df = _apply_codes(df, coded_stats)
    numeric = [*numeric, *[f"{c}_encoded" for c in coded]]
    if numeric:
        rows = rows + _numeric_stats(df, numeric, impute_values(df, numeric, strategy))
    if categorical:
        rows = rows + _category_stats(df, categorical)
    return FittedStats(rows, types)


def _apply_codes(df: DataFrame, stats: FittedStats) -> DataFrame:
    """Add ``<name>_encoded``; values not seen in the fit get the next free code."""
    for c, codes in stats.coded.items():
        known = df.sparkSession.createDataFrame(
            [(value, num) for value, (num, _) in codes.items()], f"{LABEL_TEXT} string, `{c}_encoded` double"
        )
        text = label_text(F.col(quoted(c)), df.schema[c].dataType.simpleString())
        out = f"{c}_encoded"
        df = (
            df.withColumn(LABEL_TEXT, text)
            .join(F.broadcast(known), LABEL_TEXT, "left")  # fewer than 1000 rows
            .withColumn(out, F.coalesce(F.col(quoted(out)), F.lit(float(len(codes)))))
            .drop(LABEL_TEXT)
        )
    return df


def _category_name(column: str, value: tuple, type_name: str) -> str:
    num, txt = value
    if txt is not None:
        return f"{column}_{txt}"
    whole = type_name not in ("float", "double") and not type_name.startswith("decimal")
    return f"{column}_{int(num)}" if whole else f"{column}_{num!r}"


def feature_names(stats: FittedStats) -> list[str]:
    """Numeric names, then one name per category but the first."""
    names = list(stats.numeric)
    for c in stats.onehot:
        names += [_category_name(c, v, stats.types[c]) for v in stats.categories(c)[1:]]
    return names


def apply_stats(
    df: DataFrame,
    stats: FittedStats,
    keep: Sequence[str] = (),
    scale: bool = True,
    vector: str | None = None,
) -> DataFrame:
    """Project ``df`` to ``keep`` plus the feature columns, optionally assembled as a vector."""
    df = _apply_codes(df, stats)
    out = [F.col(quoted(k)) for k in keep]
    for c, s in stats.numeric.items():
        filled = F.coalesce(numeric_value(df, c), F.lit(s["fill"][0]))
        scaled = (filled - F.lit(s["mean"][0])) / F.lit(s["scale"][0]) if scale else filled
        out.append(scaled.alias(c))
    for c, s in stats.onehot.items():
        is_text = type_class(df.schema[c].dataType) == TEXT
        current = F.col(quoted(c)) if is_text else numeric_value(df, c)
        if "mode" in s:
            current = F.coalesce(current, F.lit(s["mode"][1] if is_text else s["mode"][0]))
        for v in stats.categories(c)[1:]:
            hit = current == F.lit(v[1] if is_text else v[0])
            out.append(F.coalesce(hit.cast("double"), F.lit(0.0)).alias(_category_name(c, v, stats.types[c])))
    result = df.select(*out)
    if vector:
        names = feature_names(stats)
        plain = result.toDF(*[*keep, *[f"_f{i}" for i in range(len(names))]])
        packed = VectorAssembler(inputCols=[f"_f{i}" for i in range(len(names))], outputCol=vector)
        result = packed.transform(plain).toDF(*[*keep, *names, vector])
    return result
