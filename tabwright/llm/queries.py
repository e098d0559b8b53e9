"""Registered queries of the operators, over whole tables, with the SQL that states their results where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import bpe, conversation_repair, embed_forest, exact_dedup, lang_id, lexical_search, ngram_join, packing, ppm, repetition, secrets, substring, token_store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_store")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    store = token_store.write_store(docs, tokenizer_path("byte_bpe_50k.json"))
    return token_store.read_digests(store, docs.select("doc_id"))


@query("op7_language_id")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    models = lang_id.learn(docs, learned=~lang_id.held_out())
    return lang_id.identify(docs, models, ["doc_id"]).select(
        "doc_id",
        lang_id.held_out().alias("held_out"),
        F.col("_llm_lang").alias("lang_pred"),
        F.col("_llm_score").alias("score"),
        F.col("_llm_rejected").alias("rejected"),
    )


@query(
    "op9_exact_dedup",
    """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.text) AS text_sha256
    FROM t JOIN g ON t.text = g.text
    """,
)
def op9(spark, sf_dir):
    return exact_dedup.duplicates(table(spark, sf_dir, "documents"))


@query("op10_retrieval_packing")
def op10(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op2_secrets")
def op2(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    models = secrets.train(secrets.labelled_samples(docs))
    found = secrets.find(docs, models, ["doc_id"])
    # a second argument of the function of `filter` would be the place in the array, so kinds are counted by their numbers
    kinds = F.transform("_llm_base", lambda s: s["kind"])
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{name}")
        for k, name in enumerate(secrets.KINDS[:3])
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(secrets.spelled(F.col("_llm_base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("_llm_spans")).alias("spans"),
    )


@query("op4_ngram_join")
def op4(spark, sf_dir):
    return ngram_join.join(table(spark, sf_dir, "documents"))


@query("op3_forced_boundary_bpe")
def op3(spark, sf_dir):
    path = tokenizer_path("word_bpe_49k.json")
    both = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return both.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op6_ppm_score")
def op6(spark, sf_dir):
    return ppm.score(table(spark, sf_dir, "documents"), ppm.held_out())


@query("op8_substring_dedup")
def op8(spark, sf_dir):
    return substring.digests(table(spark, sf_dir, "documents"))


@query("op5_embedding_forest")
def op5(spark, sf_dir):
    return embed_forest.near_duplicates(table(spark, sf_dir, "embeddings"))


#: Words in windows of k words that the text holds twice or more are those that repeats of k words or more cover.
REPETITION_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g8 AS (SELECT r, unnest(list_transform(range(1, len(w) - 6), lambda i: {'i': i, 'h': md5(array_to_string(w[i:i+7], ' '))})) AS g FROM w),
h8 AS (SELECT r, g.i AS i, count(*) OVER (PARTITION BY r, g.h) AS n FROM g8),
c AS (SELECT DISTINCT r, unnest(range(i, i + 8)) AS j FROM h8 WHERE n > 1),
s AS (SELECT r, count(*) AS words, sum(length(w[j])) AS chars FROM c JOIN w USING (r) GROUP BY r),
g51 AS (SELECT r, unnest(list_transform(range(1, len(w) - 49), lambda i: md5(array_to_string(w[i:i+50], ' ')))) AS h FROM w),
l AS (SELECT DISTINCT r FROM (SELECT r FROM g51 GROUP BY r, h HAVING count(*) > 1)),
f AS (SELECT r, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(words, 0) AS n_repeat_words, coalesce(chars, 0) AS chars, l.r IS NOT NULL AS long_repeat
    FROM w LEFT JOIN s USING (r) LEFT JOIN l USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
    CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
    CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
    NOT base_failed AND 100 * chars <= 30 * word_chars AND NOT long_repeat AS kept FROM b
"""


@query("op13_suffix_repetition", REPETITION_SQL)
def op13(spark, sf_dir):
    return repetition.judge(table(spark, sf_dir, "documents")).drop("covered_chars", "longest_repeat")


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS terms FROM benchmark),
n AS (SELECT r, doc_id, len(terms) AS n FROM d WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
a AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS adds
    FROM tf JOIN n USING (r) JOIN w USING (term), total),
s AS (SELECT q, item_id, r, doc_id, CAST(sum(adds) AS BIGINT) AS score
    FROM (SELECT q, item_id, unnest(terms) AS term FROM q) JOIN a USING (term) GROUP BY q, item_id, r, doc_id),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS FIRST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 50
"""


@query("op11_ball_tree_search", SEARCH_SQL)
def op11(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Layer by layer, the least (cost, edits, lines) of every state; at most two inserts in a row can help.
REPAIR_SQL = r"""
WITH RECURSIVE x AS (SELECT dense_rank() OVER (ORDER BY conv_id) AS c, conv_id, turn, coalesce(role, ' ') AS role,
    coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
y AS (SELECT *, xor(4294967295, list_reduce(list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT)),
    lambda a, b: list_reduce(range(0, 8), lambda v, j: xor(v >> 1, (v & 1) * 3988292384), xor(a, b)), 4294967295)) % 20 AS n FROM x),
z AS (SELECT c, turn, CASE n WHEN 4 THEN 'user' ELSE role END AS role, CASE n WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g')
    ELSE text END AS text, unnest(range(CASE n WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM y WHERE n <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i FROM z),
f AS (SELECT *, left(role, 1) AS h, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
    row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS again,
    NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut,
    lag(left(role, 1)) OVER (PARTITION BY c ORDER BY i) || left(role, 1) AS pair FROM o),
g AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT blank AND NOT again) AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY c),
s(st, nxt, word) AS (VALUES (0, 2, 'user'), (1, 2, 'user'), (2, 3, 'assistant'), (3, 2, 'user')),
ins(st, t, p, e, l) AS (SELECT st, st, 0, '', '' FROM s UNION ALL SELECT st, nxt, 5, 'I', chr(10) || word || ':' FROM s
    UNION ALL SELECT st, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:' FROM s WHERE st < 2),
moves AS (SELECT c, i, st, st AS t, 2 AS p, 'D' AS e, '' AS l FROM f, s
    UNION ALL SELECT c, i, st, nxt, 1 + CASE WHEN cut THEN 5 ELSE 0 END, 'R', chr(10) || word || ':' || text FROM f, s WHERE NOT blank AND NOT again
    UNION ALL SELECT c, i, st, CASE h WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE WHEN cut THEN 5 ELSE 0 END, 'K', chr(10) || role || ':' || text
    FROM f, s WHERE NOT blank AND NOT again AND (h = 's' AND st = 0 OR h = left(word, 1))),
way AS (SELECT c, CAST(0 AS BIGINT) AS i, t AS st, {'p': CAST(p AS BIGINT), 'e': e, 'l': l} AS w FROM g, ins WHERE ins.st = 0
    UNION ALL SELECT c, i, st, min(w) FROM (SELECT m.c, m.i, ins.t AS st, {'p': w.p + m.p + ins.p, 'e': w.e || m.e || ins.e, 'l': w.l || m.l || ins.l} AS w
    FROM way JOIN moves m ON m.c = way.c AND m.i = way.i + 1 AND m.st = way.st JOIN ins ON ins.st = m.t) GROUP BY c, i, st),
r AS (SELECT c, min(w) AS w FROM way JOIN g USING (c) WHERE way.i = g.n AND st IN (0, 3) GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(w.p, 0) AS cost, coalesce(w.e, '') AS audit, sha256(substr(coalesce(w.l, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM x) LEFT JOIN g USING (c) LEFT JOIN r USING (c)
"""


@query("op12_conversation_repair", REPAIR_SQL)
def op12(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))
