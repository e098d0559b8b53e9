"""Feature rules, encoders, preprocessing, selection and split queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import query, table
from suite.views import LINEITEM_NULLS_SQL, PASSENGERS_SQL, lineitem_nulls, passengers
from tabwright.operators import encode as E
from tabwright.operators import select as S
from tabwright.operators.features import extract_features
from tabwright.operators.information import neighbour_information
from tabwright.operators.split import hash_split

TEXT_FEATURES_SQL = f"""(SELECT c_custkey, "SibSp", "Parch", "Fare", survived,
    coalesce(CASE nullif(regexp_extract("Name", ' ([A-Za-z]+)\\.', 1), '')
        WHEN 'Mr' THEN 'Mr' WHEN 'Miss' THEN 'Miss' WHEN 'Dr' THEN 'Professional'
        WHEN 'Sir' THEN 'Nobility' END, 'Other') AS "Name_Title",
    coalesce(substr("Cabin", 1, 1), 'Unknown') AS "Cabin_Deck",
    trim(coalesce(nullif(regexp_extract("Ticket", '^([A-Za-z0-9\\s]+)?\\s*\\d*$', 1), ''), 'None')) AS "Ticket_Prefix",
    coalesce(TRY_CAST(nullif(regexp_extract("Ticket", '(\\d+)$', 1), '') AS DOUBLE), 0.0) AS "Ticket_Number",
    "SibSp" + "Parch" + 1 AS "Family_Size",
    CASE WHEN "SibSp" + "Parch" + 1 = 1 THEN 1 ELSE 0 END AS "Is_Alone"
    FROM {PASSENGERS_SQL})"""


@query("text_features", f"SELECT * FROM {TEXT_FEATURES_SQL}")
def text_features(spark, sf_dir):
    return extract_features(passengers(spark, sf_dir))[0]


@query(
    "label_encode",
    """SELECT p_partkey, n.code AS p_name_encoded, b.code AS p_brand_encoded FROM part
    JOIN (SELECT p_name, row_number() OVER (ORDER BY p_name) - 1 AS code FROM (SELECT DISTINCT p_name FROM part)) n USING (p_name)
    JOIN (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part)) b USING (p_brand)""",
)
def label_encode(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    coded = E.label_encode(part, "p_name", "p_name_encoded")
    return E.label_encode(coded, "p_brand", "p_brand_encoded").select(
        "p_partkey", "p_name_encoded", "p_brand_encoded"
    )


@query(
    "label_encode_many",
    """SELECT l_orderkey, l_partkey, l_extendedprice, code AS code FROM lineitem
    JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
          FROM (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS v FROM lineitem)) ON v = CAST(l_orderkey AS VARCHAR)""",
)
def label_encode_many(spark, sf_dir):
    """A label with far over 1000 values: codes come from a distributed sort."""
    coded = E.label_encode(table(spark, sf_dir, "lineitem"), "l_orderkey", "code")
    return coded.select("l_orderkey", "l_partkey", "l_extendedprice", "code")


@query(
    "label_encode_unseen",
    """WITH codes AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
        FROM (SELECT DISTINCT n_name AS v FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 5000))
    SELECT c_custkey, n_name, coalesce(code, (SELECT count(*) FROM codes)) AS code
    FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN codes ON v = n_name""",
)
def label_encode_unseen(spark, sf_dir):
    """Codes of the nations of rich suppliers, applied to the nations of all customers."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))  # a fixed 25-row table
    rich = table(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    fitted, _ = E.label_codes(rich.join(nation, F.col("s_nationkey") == F.col("n_nationkey")), "n_name")
    customers = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    coded = E.label_encode(customers, "n_name", "code", fitted, handle_invalid="keep")
    return coded.select("c_custkey", "n_name", "code")


@query(
    "encode_target",
    """WITH t AS (SELECT l_orderkey, l_discount,
        CASE WHEN l_discount = floor(l_discount) THEN CAST(CAST(l_discount AS BIGINT) AS VARCHAR) || '.0'
             ELSE CAST(l_discount AS VARCHAR) END AS v FROM lineitem)
    SELECT l_orderkey, l_discount, code FROM t
    JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT v FROM t)) USING (v)""",
)
def encode_target(spark, sf_dir):
    coded = E.label_encode(table(spark, sf_dir, "lineitem"), "l_discount", "code")
    return coded.select("l_orderkey", "l_discount", "code")


@query(
    "encode_target_text_order",
    """WITH t AS (SELECT o_orderkey, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders)
    SELECT o_orderkey, month, code FROM t
    JOIN (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code
          FROM (SELECT DISTINCT CAST(month AS VARCHAR) AS v FROM t)) ON v = CAST(month AS VARCHAR)""",
)
def encode_target_text_order(spark, sf_dir):
    """Twelve months: as texts '10' sorts before '2'."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.month("o_orderdate").alias("month"))
    return E.label_encode(orders, "month", "code").select("o_orderkey", "month", "code")


IMPUTED = ["l_quantity", "l_linenumber", "l_extendedprice"]


def fill_sql(aggregate):
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS \"column\", round(CAST({aggregate}({c}) AS DOUBLE), 6) AS fill FROM {LINEITEM_NULLS_SQL}"
        for c in IMPUTED
    )


MODE_SQL = "\nUNION ALL\n".join(
    f"(SELECT '{c}' AS \"column\", round(CAST({c} AS DOUBLE), 6) AS fill FROM {LINEITEM_NULLS_SQL} "
    f"WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in IMPUTED
)


def fills(spark, sf_dir, strategy):
    found = E.impute_values(lineitem_nulls(spark, sf_dir), IMPUTED, strategy)
    rows = spark.createDataFrame(list(found.items()), "column string, fill double")
    return rows.withColumn("fill", F.round("fill", 6))


@query("impute_median", fill_sql("median"))
def impute_median(spark, sf_dir):
    return fills(spark, sf_dir, "median")


@query("impute_mean", fill_sql("avg"))
def impute_mean(spark, sf_dir):
    return fills(spark, sf_dir, "mean")


@query("impute_mode", MODE_SQL)
def impute_mode(spark, sf_dir):
    return fills(spark, sf_dir, "most_frequent")


@query(
    "standard_scale",
    f"""WITH t AS (SELECT * FROM {LINEITEM_NULLS_SQL}),
    f AS (SELECT median(l_quantity) AS fq FROM t),
    m AS (SELECT avg(coalesce(l_quantity, fq)) AS mq, stddev_pop(coalesce(l_quantity, fq)) AS sq,
        avg(l_extendedprice) AS mp, stddev_pop(l_extendedprice) AS sp FROM t, f)
    SELECT l_orderkey, round((coalesce(l_quantity, fq) - mq) / sq, 6) AS l_quantity,
        round((l_extendedprice - mp) / sp, 6) AS l_extendedprice FROM t, f, m""",
)
def standard_scale(spark, sf_dir):
    df = lineitem_nulls(spark, sf_dir)
    stats = E.fit_stats(df, ["l_quantity", "l_extendedprice"], [])
    scaled = E.apply_stats(df, stats, keep=["l_orderkey"])
    return scaled.select(
        "l_orderkey", F.round("l_quantity", 6).alias("l_quantity"), F.round("l_extendedprice", 6).alias("l_extendedprice")
    )


LINE_MODE = f"(SELECT l_linenumber FROM {LINEITEM_NULLS_SQL} WHERE l_linenumber IS NOT NULL GROUP BY l_linenumber ORDER BY count(*) DESC, l_linenumber LIMIT 1)"


@query(
    "one_hot",
    f"""WITH t AS (SELECT l_orderkey, coalesce(l_linenumber, {LINE_MODE}) AS n, l_returnflag FROM {LINEITEM_NULLS_SQL})
    SELECT l_orderkey, {', '.join(f'CAST(n = {k} AS DOUBLE) AS l_linenumber_{k}' for k in range(2, 8))},
        CAST(l_returnflag = 'N' AS DOUBLE) AS "l_returnflag_N", CAST(l_returnflag = 'R' AS DOUBLE) AS "l_returnflag_R" FROM t""",
)
def one_hot(spark, sf_dir):
    df = lineitem_nulls(spark, sf_dir)
    stats = E.fit_stats(df, [], ["l_linenumber", "l_returnflag"])
    return E.apply_stats(df, stats, keep=["l_orderkey"])


@query(
    "one_hot_text",
    """SELECT o_orderkey, CAST(o_orderpriority = '2-HIGH' AS DOUBLE) AS "o_orderpriority_2-HIGH",
        CAST(o_orderpriority = '3-MEDIUM' AS DOUBLE) AS "o_orderpriority_3-MEDIUM",
        CAST(o_orderpriority = '4-NOT SPECIFIED' AS DOUBLE) AS "o_orderpriority_4-NOT SPECIFIED",
        CAST(o_orderpriority = '5-LOW' AS DOUBLE) AS "o_orderpriority_5-LOW" FROM orders""",
)
def one_hot_text(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return E.apply_stats(df, E.fit_stats(df, [], ["o_orderpriority"]), keep=["o_orderkey"])


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def anova_sql(features, label, source):
    parts = [
        f"""SELECT '{f}' AS feature, {i} AS pos, (
            SELECT (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*)))
            FROM (SELECT count(*) AS n, avg({f}) AS m, var_pop({f}) AS v,
                  (SELECT avg({f}) FROM {source}) AS g FROM {source} GROUP BY {label})) AS f_score"""
        for i, f in enumerate(features)
    ]
    return " UNION ALL ".join(parts)


ANOVA_SQL = anova_sql(FEATURES, "l_returnflag", "lineitem")


@query("anova_f", f"SELECT feature, pos, round(f_score, 6) AS f_score FROM ({ANOVA_SQL})")
def anova_f(spark, sf_dir):
    scores = S.anova_f(table(spark, sf_dir, "lineitem"), FEATURES, "l_returnflag")
    return scores.withColumn("f_score", F.round("f_score", 6))


@query(
    "select_k_best",
    f"SELECT feature, pos, round(f_score, 6) AS score FROM ({ANOVA_SQL}) ORDER BY f_score DESC, pos DESC LIMIT 3",
)
def select_k_best(spark, sf_dir):
    best = S.select_k_best(table(spark, sf_dir, "lineitem"), FEATURES, "l_returnflag", k=3)
    return best.withColumn("score", F.round("score", 6))


@query(
    "f_regression",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {i} AS pos, round(pow(corr({f}, l_extendedprice), 2) / (1 - pow(corr({f}, l_extendedprice), 2)) * (count(*) - 2), 4) AS f_score FROM lineitem"
        for i, f in enumerate(["l_quantity", "l_discount", "l_tax", "l_linenumber"])
    ),
)
def f_regression(spark, sf_dir):
    scores = S.f_regression(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "l_extendedprice"
    )
    return scores.withColumn("f_score", F.round("f_score", 4))


def mutual_sql(features, label, source, bins=10):
    parts = []
    for i, f in enumerate(features):
        cuts = " + ".join(
            f"CAST({f} > (SELECT v FROM o WHERE r = greatest(CAST(ceil(c * {k / bins}) AS BIGINT), 1)) AS INTEGER)"
            for k in range(1, bins)
        )
        # equal edges count once
        parts.append(
            f"""SELECT '{f}' AS feature, {i} AS pos, (
            WITH o AS (SELECT {f} AS v, row_number() OVER (ORDER BY {f}) AS r, count(*) OVER () AS c FROM {source}),
            edges AS (SELECT DISTINCT v AS e FROM o WHERE r IN ({', '.join(f'(SELECT greatest(CAST(ceil(max(c) * {k / bins}) AS BIGINT), 1) FROM o)' for k in range(1, bins))})),
            b AS (SELECT (SELECT count(*) FROM edges WHERE e < {f}) AS bin, {label} AS y FROM {source}),
            j AS (SELECT bin, y, count(*) AS n FROM b GROUP BY bin, y),
            x AS (SELECT n, sum(n) OVER (PARTITION BY bin) AS nb, sum(n) OVER (PARTITION BY y) AS ny, sum(n) OVER () AS nn FROM j)
            SELECT sum(CAST(n AS DOUBLE) / nn * ln(CAST(n AS DOUBLE) * nn / (CAST(nb AS DOUBLE) * ny))) FROM x) AS mi"""
        )
    return " UNION ALL ".join(parts)


@query(
    "mutual_info_binned",
    f"SELECT feature, pos, round(mi, 8) AS mi FROM ({mutual_sql(FEATURES, 'l_returnflag', 'lineitem')})",
)
def mutual_info_binned(spark, sf_dir):
    scores = S.mutual_information(table(spark, sf_dir, "lineitem"), FEATURES, "l_returnflag")
    return scores.withColumn("mi", F.round("mi", 8))


PRICE_RANKS = " OR ".join(f"r = greatest(CAST(ceil(c * {k / 10}) AS BIGINT), 1)" for k in range(1, 10))
PRICE_BINS = f"""(WITH o AS (SELECT l_extendedprice AS v, row_number() OVER (ORDER BY l_extendedprice) AS r, count(*) OVER () AS c FROM lineitem),
    edges AS (SELECT DISTINCT v AS e FROM o WHERE {PRICE_RANKS})
    SELECT l.*, (SELECT count(*) FROM edges WHERE e < l.l_extendedprice) AS y FROM lineitem l)"""


@query(
    "mutual_info_regression",
    f"SELECT feature, pos, round(mi, 8) AS mi FROM ({mutual_sql(['l_quantity', 'l_discount'], 'y', PRICE_BINS)})",
)
def mutual_info_regression(spark, sf_dir):
    """A numeric label is binned like the features."""
    scores = S.mutual_information(
        table(spark, sf_dir, "lineitem"), ["l_quantity", "l_discount"], "l_extendedprice", label_bins=S.LABEL_BINS
    )
    return scores.withColumn("mi", F.round("mi", 8))


NEAREST = 3
# psi(n) is the harmonic number of n - 1 but for a constant that cancels
NEIGHBOUR_SQL = f"""WITH s AS (SELECT l_extendedprice, l_quantity, l_tax, CAST(floor(l_quantity / 10) AS INT) AS c FROM lineitem),
    long AS (SELECT 0 AS pos, l_extendedprice AS v, c FROM s UNION ALL SELECT 1, l_quantity, c FROM s UNION ALL SELECT 2, l_tax, c FROM s),
    p AS (SELECT pos, c, CAST(v AS DOUBLE) AS v, count(*) AS n FROM long WHERE v IS NOT NULL AND c IS NOT NULL GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY pos, c ORDER BY v) AS rn, sum(n) OVER (PARTITION BY pos, c) AS nc FROM p QUALIFY nc > 1),
    near AS (SELECT a.*, b.v AS bv, abs(b.v - a.v) AS d, b.n - CAST(b.v = a.v AS BIGINT) AS bn
        FROM (SELECT r.*, rn + o AS at FROM r, (SELECT unnest(generate_series(-{NEAREST}, {NEAREST})) AS o)) a
        JOIN r b ON b.pos = a.pos AND b.c = a.c AND b.rn = a.at),
    cum AS (SELECT *, sum(bn) OVER (PARTITION BY pos, c, v ORDER BY d) AS held FROM near),
    far AS (SELECT *, min(CASE WHEN held >= least({NEAREST}, nc - 1) THEN d END) OVER (PARTITION BY pos, c, v) AS radius FROM cum),
    reach AS (SELECT pos, c, v, n, nc, sum(bn) AS k, least(v - min(radius), min(bv)) AS low, greatest(v + min(radius), max(bv)) AS high
        FROM far WHERE d <= radius GROUP BY pos, c, v, n, nc),
    t AS (SELECT pos, v, sum(sum(n)) OVER (PARTITION BY pos ORDER BY v) AS run FROM r GROUP BY pos, v),
    m AS (SELECT x.*, h.run - coalesce(l.run, 0) - 1 AS m FROM reach x
        ASOF JOIN t h ON h.pos = x.pos AND x.high >= h.v
        ASOF LEFT JOIN t l ON l.pos = x.pos AND x.low > l.v),
    psi AS (SELECT i AS x, sum(1.0 / i) OVER (ORDER BY i) - 1.0 / i AS y FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM lineitem))) AS i)),
    scored AS (SELECT pos, sum(n) AS total, sum(n * (k.y - c.y - a.y)) / sum(n) AS part FROM m
        JOIN psi k ON k.x = m.k JOIN psi c ON c.x = m.nc JOIN psi a ON a.x = m.m GROUP BY pos)
    SELECT CASE pos WHEN 0 THEN 'l_extendedprice' WHEN 1 THEN 'l_quantity' ELSE 'l_tax' END AS feature, pos,
        round(greatest(part + y, 0), 8) AS mi FROM scored JOIN psi ON x = total"""


@query("mutual_info_neighbours", NEIGHBOUR_SQL)
def mutual_info_neighbours(spark, sf_dir):
    """Bands of the quantity against a continuous feature, one of few values and an unrelated one."""
    lines = table(spark, sf_dir, "lineitem").withColumn("band", F.floor(F.col("l_quantity") / 10).cast("int"))
    scores = neighbour_information(lines, ["l_extendedprice", "l_quantity", "l_tax"], "band", NEAREST)
    return scores.withColumn("mi", F.round("mi", 8))


DIGEST = "substr(md5(concat_ws('|', {keys}, '42')), 1, 13)"
LIMIT = format(round(0.2 * 16**13), "013x")


@query(
    "hash_split",
    "SELECT l_orderkey, l_linenumber, l_extendedprice, "
    + DIGEST.format(keys="CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)")
    + f" < '{LIMIT}' AS is_test FROM lineitem",
)
def split_by_hash(spark, sf_dir):
    marked = hash_split(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return marked.select("l_orderkey", "l_linenumber", "l_extendedprice", "is_test")


@query(
    "exact_split",
    f"""SELECT o_orderkey, row_number() OVER (ORDER BY {DIGEST.format(keys='CAST(o_orderkey AS VARCHAR)')}, o_orderkey)
        <= ceil(count(*) OVER () * 0.2) AS is_test FROM orders""",
)
def split_exactly(spark, sf_dir):
    marked = hash_split(table(spark, sf_dir, "orders"), ["o_orderkey"], exact=True)
    return marked.select("o_orderkey", "is_test")
