"""Trial, run, model-version and registry queries over histories derived from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite import query, table
from suite.profiling import union_all
from suite.views import columns_of, profile_sql
from tabwright.operators import registry as G
from tabwright.operators import runs as R
from tabwright.operators import trials as TR
from tabwright.operators.profile import profile
from tabwright.session import fresh_path
from tabwright.sources.catalog import catalog, folder_catalog, saved_profile, upload
from tabwright.sources.csv import load_csv
from tabwright.streaming.registry_log import watch, write_log

# ---- trials: one per order -----------------------------------------------------------------------

TRIALS_SQL = """(SELECT o_orderkey AS trial_no, o_orderpriority AS model_name,
    CASE WHEN o_orderstatus = 'P' THEN 'failed' ELSE 'completed' END AS status,
    CASE WHEN o_custkey % 10 <> 0 THEN round(o_totalprice / 600000, 2) END AS accuracy,
    CASE WHEN o_custkey % 10 = 0 THEN round(o_totalprice / 600000, 2) END AS mae FROM orders)"""


def trials(spark, sf_dir):
    score = F.round(F.col("o_totalprice") / 600000, 2)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("trial_no"),
        F.col("o_orderpriority").alias("model_name"),
        F.when(F.col("o_orderstatus") == "P", "failed").otherwise("completed").alias("status"),
        F.when(F.col("o_custkey") % 10 != 0, F.create_map(F.lit("accuracy"), score))
        .otherwise(F.create_map(F.lit("mae"), score))
        .alias("metrics"),
    )


def rank_sql(metric, order):
    return f"""SELECT '{metric}' AS metric, row_number() OVER (ORDER BY {metric} {order}, trial_no) AS rank, trial_no, model_name,
        {metric} AS value FROM {TRIALS_SQL} WHERE status = 'completed' AND {metric} IS NOT NULL"""


@query("rank_trials", f"{rank_sql('accuracy', 'DESC')} UNION ALL {rank_sql('mae', 'ASC')}")
def rank_trials(spark, sf_dir):
    """All trials by a gain and by an error metric; ranks come from a distributed sort."""
    df = trials(spark, sf_dir)
    return union_all(
        TR.rank(df, m).select(
            F.lit(m).alias("metric"), "rank", "trial_no", "model_name", F.col("metrics")[m].alias("value")
        )
        for m in ("accuracy", "mae")
    )


@query(
    "leaderboard_top10",
    f"""SELECT CAST(row_number() OVER (ORDER BY accuracy DESC, trial_no) AS INTEGER) AS rank, trial_no, model_name,
    accuracy, 0.0::DOUBLE AS precision, 0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1
    FROM {TRIALS_SQL} WHERE status = 'completed' AND accuracy IS NOT NULL ORDER BY accuracy DESC, trial_no LIMIT 10""",
)
def leaderboard_top10(spark, sf_dir):
    return TR.leaderboard(trials(spark, sf_dir))


@query(
    "trial_summary",
    f"SELECT count(*) AS total_trials, count(*) FILTER (WHERE status = 'completed') AS successful FROM {TRIALS_SQL}",
)
def trial_summary(spark, sf_dir):
    return TR.trial_summary(trials(spark, sf_dir))


# A search space read off the parts: a family per type, its brands and sizes as values.
GRID_SQL = r"""(SELECT b.p_type AS model_type, b.v AS brand, s.v AS size,
    row_number() OVER (PARTITION BY b.p_type ORDER BY CAST(regexp_extract(b.v, '\d+') AS INTEGER), CAST(s.v AS BIGINT)) - 1 AS combo_pos,
    dense_rank() OVER (ORDER BY b.p_type) - 1 AS family_pos
    FROM (SELECT DISTINCT p_type, p_brand AS v FROM part) b
    JOIN (SELECT DISTINCT p_type, CAST(p_size AS VARCHAR) AS v FROM part) s ON b.p_type = s.p_type)"""


def part_grid(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    types = [r[0] for r in part.select("p_type").distinct().orderBy("p_type").collect()]
    family = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("p_type")).cast("int") - 1
    brands = part.select("p_type", F.col("p_brand").alias("value")).distinct()
    sizes = part.select("p_type", F.col("p_size").alias("n")).distinct()
    columns = [family.alias("family_pos"), F.col("p_type").alias("model_name"), F.col("p_type").alias("model_type")]
    brand_rows = brands.select(*columns, F.lit(0).alias("param_pos"), F.lit("brand").alias("param"), F.regexp_extract("value", r"\d+", 0).cast("int").alias("n"), "value")
    size_rows = sizes.select(*columns, F.lit(1).alias("param_pos"), F.lit("size").alias("param"), "n", F.col("n").cast("string").alias("value"))
    return brand_rows.unionByName(size_rows).withColumnRenamed("n", "value_pos")


@query(
    "param_grid",
    f"SELECT model_type, combo_pos, brand, size FROM {GRID_SQL}",
)
def param_grid(spark, sf_dir):
    combos = TR.param_grid(part_grid(spark, sf_dir))
    return combos.select("model_type", "combo_pos", F.col("params")["brand"].alias("brand"), F.col("params")["size"].alias("size"))


@query(
    "trial_plan",
    f"""SELECT row_number() OVER (ORDER BY family_pos, combo_pos) AS trial_no, model_type, brand, size
    FROM {GRID_SQL} WHERE combo_pos < 3 ORDER BY family_pos, combo_pos LIMIT 10""",
)
def trial_plan(spark, sf_dir):
    plan = TR.trial_plan(TR.param_grid(part_grid(spark, sf_dir)))
    return plan.select("trial_no", "model_type", F.col("params")["brand"].alias("brand"), F.col("params")["size"].alias("size"))


# ---- runs: one per order -------------------------------------------------------------------------

RUNS_SQL = """(SELECT 'run-' || o_orderkey AS run_id, o_orderpriority AS experiment,
    CASE WHEN o_orderstatus = 'P' THEN 'RUNNING' ELSE 'FINISHED' END AS status, o_orderdate AS start_time,
    CASE WHEN o_custkey % 50 = 0 THEN 'nan'::DOUBLE WHEN o_custkey % 10 <> 0 THEN round(o_totalprice / 600000, 2) END AS accuracy,
    round(o_totalprice / 1000, 1) AS loss, CAST(o_custkey AS VARCHAR) AS customer FROM orders)"""


def runs(spark, sf_dir):
    accuracy = F.when(F.col("o_custkey") % 50 == 0, float("nan")).otherwise(F.round(F.col("o_totalprice") / 600000, 2))
    loss = F.round(F.col("o_totalprice") / 1000, 1)
    with_both = F.create_map(F.lit("accuracy"), accuracy, F.lit("loss"), loss)
    has_accuracy = (F.col("o_custkey") % 10 != 0) | (F.col("o_custkey") % 50 == 0)
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        F.col("o_orderpriority").alias("experiment"),
        F.when(F.col("o_orderstatus") == "P", "RUNNING").otherwise("FINISHED").alias("status"),
        F.col("o_orderdate").alias("start_time"),
        F.lit(None).cast("timestamp").alias("end_time"),
        F.when(has_accuracy, with_both).otherwise(F.create_map(F.lit("loss"), loss)).alias("metrics"),
        F.create_map(F.lit("customer"), F.col("o_custkey").cast("string")).alias("params"),
    )


@query(
    "search_runs",
    f"""SELECT run_id, status, loss FROM {RUNS_SQL} WHERE experiment = '2-HIGH' AND loss > 300 AND status = 'FINISHED'
    ORDER BY start_time DESC, run_id LIMIT 100""",
)
def search_runs(spark, sf_dir):
    found = R.search_runs(runs(spark, sf_dir), "2-HIGH", "metrics['loss'] > 300 AND status = 'FINISHED'")
    return found.select("run_id", "status", F.col("metrics")["loss"].alias("loss"))


@query(
    "experiment_metrics",
    f"""SELECT run_id, status, CASE WHEN isnan(accuracy) THEN NULL ELSE accuracy END AS accuracy, loss, customer
    FROM {RUNS_SQL} WHERE experiment = '5-LOW'""",
)
def experiment_metrics(spark, sf_dir):
    found = R.experiment_metrics(runs(spark, sf_dir), "5-LOW", max_results=None)
    accuracy = F.element_at("metrics", "accuracy")
    return found.select(
        "run_id",
        "status",
        F.when(~F.isnan(accuracy), accuracy).alias("accuracy"),
        F.element_at("metrics", "loss").alias("loss"),
        F.element_at("params", "customer").alias("customer"),
    )


def best_sql(metric, order):
    return f"""SELECT run_id, experiment, {metric} AS value FROM {RUNS_SQL} WHERE experiment = '1-URGENT' AND {metric} IS NOT NULL
        AND NOT isnan({metric}) ORDER BY {metric} {order}, start_time DESC, run_id LIMIT 1"""


@query("best_run_max", best_sql("accuracy", "DESC"))
def best_run_max(spark, sf_dir):
    best = R.best_run(runs(spark, sf_dir), "1-URGENT")
    return best.select("run_id", "experiment", F.col("metrics")["accuracy"].alias("value"))


@query("best_run_min", best_sql("loss", "ASC"))
def best_run_min(spark, sf_dir):
    best = R.best_run(runs(spark, sf_dir), "1-URGENT", "loss", "min")
    return best.select("run_id", "experiment", F.col("metrics")["loss"].alias("value"))


@query(
    "best_run_per_experiment",
    f"""SELECT experiment, run_id, accuracy AS value FROM {RUNS_SQL} WHERE accuracy IS NOT NULL AND NOT isnan(accuracy)
    QUALIFY row_number() OVER (PARTITION BY experiment ORDER BY accuracy DESC, start_time DESC, run_id) = 1""",
)
def best_run_per_experiment(spark, sf_dir):
    return R.best_runs(runs(spark, sf_dir))


@query(
    "metric_history_latest",
    """SELECT l_orderkey AS run_id, l_returnflag AS key, arg_max(l_extendedprice, (l_linenumber, l_extendedprice)) AS value,
    max(l_linenumber) AS step FROM lineitem GROUP BY 1, 2""",
)
def metric_history_latest(spark, sf_dir):
    history = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("run_id"),
        F.col("l_returnflag").alias("key"),
        F.col("l_extendedprice").alias("value"),
        F.col("l_linenumber").alias("step"),
        F.col("l_extendedprice").alias("seq"),
    )
    return R.metric_history_latest(history)


@query(
    "tracking_upsert",
    """SELECT md5('exp-' || p_partkey) AS experiment_id, 'exp-' || p_partkey AS name FROM part
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)""",
)
def tracking_upsert(spark, sf_dir):
    """Experiments named for parts; those of bulk orders exist already."""
    known = table(spark, sf_dir, "lineitem").filter("l_quantity > 45").select(F.concat(F.lit("exp-"), "l_partkey").alias("name"))
    wanted = table(spark, sf_dir, "part").select(F.concat(F.lit("exp-"), "p_partkey").alias("name"))
    return R.tracking_upsert(known.distinct(), wanted)


@query(
    "register_model",
    """SELECT p_type AS name, 'run-' || p_partkey AS run_id, 'models/run-' || p_partkey AS source,
    coalesce((SELECT max(p_size) FROM part b WHERE b.p_type = a.p_type AND b.p_brand = 'Brand#1'), 0)
        + row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS version FROM part a""",
)
def register_model(spark, sf_dir):
    """Every part registers a version of its type; some types have versions already."""
    part = table(spark, sf_dir, "part")
    known = part.filter("p_brand = 'Brand#1'").select(F.col("p_type").alias("name"), F.col("p_size").cast("long").alias("version"))
    run = F.concat(F.lit("run-"), "p_partkey")
    new = part.select(
        F.col("p_type").alias("name"),
        run.alias("run_id"),
        F.concat(F.lit("models/"), run).alias("source"),
        F.col("p_partkey").alias("created_at"),
    )
    return R.register_models(known, new).select("name", "run_id", "source", "version")


# ---- registry: an experiment per user of the event stream -----------------------------------------

STATUS_OF = {"signup": "pending", "view": "running", "click": "stopped", "purchase": "completed", "error": "failed"}
REGISTRY_SQL = """(SELECT 'exp-' || user_id AS id, event_id AS seq, ts AS moment, event_type = 'signup' AS created,
    CASE event_type WHEN 'signup' THEN 'pending' WHEN 'view' THEN 'running' WHEN 'click' THEN 'stopped'
        WHEN 'purchase' THEN 'completed' ELSE 'failed' END AS status,
    CASE WHEN event_type = 'purchase' THEN value END AS amount, CASE WHEN event_type = 'error' THEN props END AS error FROM events)"""
TIME_SQL = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"
LATEST_SQL = f"""(SELECT id, id AS name, arg_max(status, seq) AS status, arg_max(amount, seq) FILTER (WHERE amount IS NOT NULL) AS amount,
    arg_max(error, seq) FILTER (WHERE error IS NOT NULL) AS error, {TIME_SQL.format("min(moment) FILTER (WHERE created)")} AS created_at,
    {TIME_SQL.format("max(moment)")} AS updated_at FROM {REGISTRY_SQL} GROUP BY id HAVING bool_or(created))"""


def null(kind):
    return F.lit(None).cast(kind)


def registry_events(spark, sf_dir):
    kind = F.col("event_type")
    status = F.element_at(F.create_map(*[F.lit(x) for p in STATUS_OF.items() for x in p]), kind)
    experiment = F.concat(F.lit("exp-"), F.col("user_id"))
    return table(spark, sf_dir, "events").select(
        experiment.alias("id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("at"),
        (kind == "signup").alias("created"),
        F.lit(False).alias("deleted"),
        F.when(kind == "signup", experiment).alias("name"),
        status.alias("status"),
        null("string").alias("model_type"),
        F.when(kind == "purchase", F.create_map(F.lit("amount"), F.col("value"))).alias("metrics"),
        F.when(kind == "signup", F.create_map(F.lit("props"), F.col("props"))).alias("parameters"),
        *[null("string").alias(c) for c in ("artifacts_path", "run_id", "container_id", "deployed_endpoint")],
        F.when(kind == "error", F.col("props")).alias("error"),
    )


def stamp(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


@query("registry_transitions", f"SELECT id, status, amount, error, created_at, updated_at FROM {LATEST_SQL}")
def registry_transitions(spark, sf_dir):
    current = G.latest(registry_events(spark, sf_dir))
    return current.select("id", "status", F.col("metrics")["amount"].alias("amount"), "error", stamp("created_at"), stamp("updated_at"))


@query("registry_list", f"SELECT id, name, status, substr(created_at, 1, 10) AS created FROM {LATEST_SQL} WHERE status = 'completed'")
def registry_list(spark, sf_dir):
    found = G.by_status(G.latest(registry_events(spark, sf_dir)), "completed")
    return found.select("id", "name", "status", F.date_format("created_at", "yyyy-MM-dd").alias("created"))


@query("registry_get", f"""SELECT id, status FROM (SELECT id, status, bool_or(id = 'exp-1') OVER () AS hit FROM {LATEST_SQL}
    WHERE starts_with(id, 'exp-1')) WHERE NOT hit OR id = 'exp-1' ORDER BY id LIMIT 2""")
def registry_get(spark, sf_dir):
    return G.by_id(G.latest(registry_events(spark, sf_dir)), "exp-1").select("id", "status")


@query("registry_get_by_name", f"SELECT id, name, status FROM {LATEST_SQL} WHERE name = 'exp-7'")
def registry_get_by_name(spark, sf_dir):
    return G.by_name(G.latest(registry_events(spark, sf_dir)), "exp-7").select("id", "name", "status")


@query(
    "registry_create",
    f"""SELECT md5('exp-' || c_custkey) AS id, 'exp-' || c_custkey AS name, 'pending' AS status, c_mktsegment AS model_type
    FROM customer WHERE 'exp-' || c_custkey NOT IN (SELECT name FROM {LATEST_SQL})""",
)
def registry_create(spark, sf_dir):
    """An experiment asked for per customer; names in use are refused."""
    name = F.concat(F.lit("exp-"), "c_custkey")
    requests = table(spark, sf_dir, "customer").select(
        name.alias("name"), F.md5(name).alias("id"), F.col("c_custkey").alias("seq"), F.col("c_mktsegment").alias("model_type")
    )
    made = G.create_events(G.latest(registry_events(spark, sf_dir)), requests)
    return made.select("id", "name", "status", "model_type")


@query(
    "registry_update",
    f"""SELECT l.id, l.status, c.c_mktsegment AS model_type FROM {LATEST_SQL} l
    LEFT JOIN customer c ON l.id = 'exp-' || c.c_custkey""",
)
def registry_update(spark, sf_dir):
    """A model type set per customer; ids that were never created stay out."""
    updates = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("exp-"), "c_custkey").alias("id"),
        (F.lit(10**12) + F.col("c_custkey")).alias("seq"),
        F.col("c_mktsegment").alias("model_type"),
    )
    events = registry_events(spark, sf_dir).unionByName(updates, allowMissingColumns=True)
    return G.latest(events).select("id", "status", "model_type")


@query(
    "registry_delete",
    f"""SELECT id, status FROM {LATEST_SQL} WHERE id NOT IN (SELECT 'exp-' || user_id FROM events WHERE event_type = 'error' AND value > 120)""",
)
def registry_delete(spark, sf_dir):
    """Users with a large error are deleted; later events do not bring them back."""
    gone = table(spark, sf_dir, "events").filter("event_type = 'error' AND value > 120").select(
        F.concat(F.lit("exp-"), "user_id").alias("id"), F.col("event_id").alias("seq"), F.lit(True).alias("deleted")
    )
    events = registry_events(spark, sf_dir).unionByName(gone, allowMissingColumns=True)
    return G.latest(events).select("id", "status")


@query("registry_metrics", f"SELECT id, 'amount' AS metric, amount AS value FROM {LATEST_SQL} WHERE amount IS NOT NULL")
def registry_metrics(spark, sf_dir):
    return G.metrics_of(G.latest(registry_events(spark, sf_dir)))


@query("registry_json", f"SELECT id, name, status, amount FROM {LATEST_SQL}")
def registry_json(spark, sf_dir):
    documents = G.to_json(G.latest(registry_events(spark, sf_dir))).select("document")
    return G.from_json(documents).select("id", "name", "status", F.col("metrics")["amount"].alias("amount"))


@query(
    "registry_stream",
    f"SELECT id, seq, status, error, status IN ('completed', 'failed', 'stopped') AS ended FROM {REGISTRY_SQL}",
)
def registry_stream(spark, sf_dir):
    """The event folder read as a stream; the log it wrote is the result."""
    base = fresh_path(spark, "registry-stream")
    registry_events(spark, sf_dir).write.parquet(f"{base}/events")
    log = watch(spark, f"{base}/events")
    write_log(log, f"{base}/log", f"{base}/state").awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{base}/log").select("id", "seq", "status", "error", "ended")


# ---- sources -------------------------------------------------------------------------------------


@query("csv_roundtrip", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "csv")
    table(spark, sf_dir, "customer").write.csv(path, header=True)
    return load_csv(spark, path)


@query("csv_roundtrip_texts", "SELECT doc_id, CASE WHEN text NOT IN ('', 'NA') THEN text END AS text, lang, source, n_chars FROM documents")
def csv_roundtrip_texts(spark, sf_dir):
    """Texts with quotes, separators and line breaks inside."""
    path = fresh_path(spark, "csv")
    table(spark, sf_dir, "documents").write.csv(path, header=True, escape='"', quoteAll=True)
    return load_csv(spark, path)


CATALOG = ("customer", "orders", "part", "supplier")


def catalog_sql(name):
    return f"""SELECT '{name}' AS dataset, max(n_rows) AS n_rows, count(*) AS n_columns,
        count(*) FILTER (WHERE kind IN ('numerical', 'binary')) AS n_numerical, count(*) FILTER (WHERE kind = 'categorical') AS n_categorical
        FROM ({profile_sql(name, columns_of(name))})"""


TYPED_CATALOG_SQL = " UNION ALL ".join(
    f"SELECT '{t}', count(*), {len(columns_of(t))}, {sum(k == 'n' for _, k in columns_of(t))}, {sum(k == 't' for _, k in columns_of(t))} FROM {t}"
    for t in ("lineitem", "events")
)


@query("dataset_catalog", " UNION ALL ".join(catalog_sql(t) for t in CATALOG) + " UNION ALL " + TYPED_CATALOG_SQL)
def dataset_catalog(spark, sf_dir):
    """Four datasets with a profile, two counted by type."""
    tables = {t: table(spark, sf_dir, t) for t in (*CATALOG, "lineitem", "events")}
    return catalog(tables, {t: profile(tables[t], distinct="adaptive") for t in CATALOG})


@query("dataset_upload", f"SELECT \"column\", pos, n_rows, n_missing, kind, \"column\" = 'l_linestatus' AS is_target FROM ({profile_sql('lineitem', columns_of('lineitem'))})")
def dataset_upload(spark, sf_dir):
    folder = fresh_path(spark, "datasets")
    upload(table(spark, sf_dir, "lineitem"), folder, "lineitem")
    return saved_profile(spark, folder, "lineitem").select("column", "pos", "n_rows", "n_missing", "kind", "is_target")


# Columns, number columns and text columns of the given tables.
SHAPES = {
    "region": (2, 1, 1),
    "nation": (3, 2, 1),
    "customer": (5, 3, 2),
    "supplier": (4, 3, 1),
    "part": (6, 3, 3),
    "orders": (6, 3, 2),
    "lineitem": (11, 8, 2),
    "events": (6, 3, 2),
    "documents": (5, 2, 3),
    "embeddings": (3, 2, 0),
    "pages": (3, 1, 2),
    "benchmark": (2, 1, 1),
    "labels": (3, 3, 0),
    "conversations": (4, 2, 2),
}


@query(
    "folder_catalog",
    " UNION ALL ".join(
        f"SELECT '{t}' AS dataset, count(*) AS n_rows, CAST({n} AS BIGINT) AS n_columns, "
        f"CAST({numbers} AS BIGINT) AS n_numerical, CAST({texts} AS BIGINT) AS n_categorical FROM {t}"
        for t, (n, numbers, texts) in SHAPES.items()
    ),
)
def whole_folder_catalog(spark, sf_dir):
    """All tables of the folder; none has a saved profile, so columns are counted by type."""
    return folder_catalog(spark, sf_dir)


@query(
    "runs_ended",
    """SELECT o_orderkey AS run_id, CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'P' THEN 'FAILED' ELSE 'RUNNING' END AS status,
    o_custkey AS experiment, CASE WHEN o_orderstatus IN ('F', 'P') THEN o_orderkey * 2 END AS end_time FROM orders""",
)
def runs_ended(spark, sf_dir):
    """A run per order: open orders still run, filled ones have ended, partly filled ones have failed."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    starts = orders.select(
        key.alias("run_id"), F.lit(1).cast("long").alias("seq"), F.col("o_custkey").alias("experiment"), F.lit("RUNNING").alias("status"),
        F.lit(None).cast("long").alias("end_time"),
    )
    closing = orders.select(key.alias("run_id"), F.lit(2).cast("long").alias("seq"), (key * 2).alias("at"), "o_orderstatus")
    ends = R.end_run_events(closing.filter("o_orderstatus = 'F'")).unionByName(
        R.end_run_events(closing.filter("o_orderstatus = 'P'"), "FAILED")
    )
    return R.runs_latest(starts.unionByName(ends, allowMissingColumns=True))
