"""Language models, secrets and the pipeline."""

import math
import re
import zlib
from collections import Counter

import numpy as np

import corpus_pipeline
from pyspark.sql import functions as F
from tabwright.llm import lang_id, ppm, secrets
from tabwright.llm import queries as llm_queries

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    found = [("assign", m) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    rank = {k: i for i, k in enumerate(secrets.KINDS)}
    return [f"{k}:{m.start()}:{m.end()}" for k, m in sorted(found, key=lambda x: (x[1].start(), rank[x[0]]))]


def test_base_spans_equal_python(spark, odd_docs):
    texts = [r.text or "" for r in odd_docs.collect()]
    texts += [
        "token: token: abcdefgh", "TOKEN='abc' secret = x token=token=abcdefg", "é😀 api-key apiKey:\"a/b+c=d\"", "AKIA" + "A" * 15,
        "AKIAxAKIA" + "B" * 16, "f" * 23 + " " + "0" * 24, "passwordpassword=abcdef", "secret" + " " * 50 + "=" + " " * 50 + "abcdef",
        "tokentoken:=abcdef", "token=" * 300 + "abcdef", " ".join(["0" * 24] * 200),
    ]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    models = secrets.MarkovModels([0.0] * secrets.CODES**2, 1.0)
    got = secrets.find(docs, models, ["doc_id"]).select("doc_id", secrets.spelled(F.col("_llm_spans")).alias("s")).collect()
    assert {r.doc_id: r.s for r in got} == {i: ",".join(base_spans(t)) for i, t in enumerate(texts)}


def test_random_strings_are_told_from_identifiers(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = secrets.train(secrets.labelled_samples(docs))
    random = ["q7Xz0PvK3mW9LrT2bYs8HdGf", "Zk3+vQ9/pL2xR8sT1wN5bM7c", "A7K2M9X4Q1Z8W3R6T5Y0PLKJ"]
    plain = ["thereonthattionthereonwhat", "andthereisthewordthatentering", "heretionsthat.andthereisthen"]
    rows = [(i, f"é a {s} b") for i, s in enumerate(random + plain)]
    table = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("int"))
    found = secrets.find(table, models, ["doc_id"]).select("doc_id", secrets.spelled(F.col("_llm_spans")).alias("s")).collect()
    spans = {r.doc_id: r.s for r in found}
    for i, s in enumerate(random):
        assert spans[i] == f"random:4:{4 + len(s)}"
    assert all(spans[len(random) + i] == "" for i in range(len(plain)))
    red = {r.doc_id: r for r in secrets.redact(table, models).collect()}
    assert red[0].text == f"é a {secrets.REDACTED} b" and red[0].n_chars == len(red[0].text)
    assert red[3].text == rows[3][1]
    assert secrets.redact(table, models).schema == table.schema


def test_unlabelled_secrets_in_the_samples_stay_found(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = np.random.default_rng(11)
    letters = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    tokens = ["ghp_" + "".join(rng.choice(letters, 36)) for _ in range(max(4, docs.count() // 50))]
    planted = spark.createDataFrame([(10**9 + i, f"so {t} then") for i, t in enumerate(tokens)], "doc_id long, text string")
    models = secrets.train(secrets.labelled_samples(docs.select("doc_id", "text").unionByName(planted)))
    probes = tokens + ["".join(rng.choice(list("0123456789ABCDEF"), 32)) for _ in range(300)]
    table = spark.createDataFrame([(i, f"a {s} b") for i, s in enumerate(probes)], "doc_id long, text string")
    found = {r.doc_id for r in secrets.find(table, models, ["doc_id"]).filter(F.size("_llm_spans") > 0).select("doc_id").collect()}
    assert sum(i in found for i in range(len(tokens))) >= 0.95 * len(tokens)
    assert sum(i in found for i in range(len(tokens), len(probes))) >= 0.85 * 300  # 200 documents only: capital hexadecimal is in no random sample


def test_secrets_query_counts_every_kind_by_its_name(spark, folder):
    hexes = "0123456789abcdef" * 2
    texts = [f"{hexes} {hexes} AKIA{'Z' * 16}", "secret=abcdef token=abcdef api_key: abcdefg", hexes, None]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    rows = llm_queries.QUERIES["op2_secrets"](spark, folder).collect()
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex) for r in rows}
    assert got == {0: (0, 1, 2), 1: (3, 0, 0), 2: (0, 0, 1), 3: (0, 0, 0)}


def test_secrets_without_rows(no_docs, odd_docs):
    models = secrets.train(secrets.labelled_samples(no_docs))
    assert secrets.find(no_docs, models, ["doc_id"]).collect() == []
    out = secrets.redact(odd_docs, secrets.train(secrets.labelled_samples(odd_docs)))
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    assert sum(r.text is None for r in out.collect()) == 2
    assert not any("hunter22xx" in (r.text or "") for r in out.collect())


def plain_ppm(texts, order, nodes):
    """Counts by context, and a function that gives the probability of a byte after a context the plain way."""
    counts = {}
    for t in texts:
        data = bytes([ppm.START]) * order + t + bytes([ppm.END])
        for i in range(order, len(data)):
            for k in range(order + 1):
                counts.setdefault(data[i - k : i], Counter())[data[i]] += 1

    def probability(before, symbol):
        p, excluded, total_p = 1.0, set(), None
        k = order
        while k > 0 and before[order - k :] not in nodes[k]:
            k -= 1
        while k >= 0:
            own = {s: n for s, n in counts.get(before[order - k :], {}).items() if s not in excluded}
            if own:
                total = sum(own.values()) + len(own)
                if symbol in own:
                    return p * own[symbol] / total
                p *= len(own) / total
                excluded |= set(own)
            k -= 1
        return p / (256 - len(excluded)) if len(excluded) < 256 else total_p

    return probability


def test_ppm_equals_the_plain_way(spark):
    texts = ["the cat sat", "the dog sat", "a cat", "", "ééé the"]
    table = spark.createDataFrame([(t,) for t in texts], "_text string")
    trie = ppm.learn(table)
    assert np.allclose((10.0 ** trie.table.astype(float)).sum(axis=1), 1, atol=1e-4)
    nodes = [
        {int(c).to_bytes(k, "big") if k else b"" for c in own} for k, own in enumerate(trie.nodes)
    ]
    probability = plain_ppm([t.encode().lower() for t in texts], ppm.ORDER, nodes)
    for text in (b"the cat", b"zebra", b"", "é".encode()):
        data = bytes([ppm.START]) * ppm.ORDER + text + bytes([ppm.END])
        want = sum(math.log10(probability(data[i - ppm.ORDER : i], data[i])) for i in range(ppm.ORDER, len(data)))
        assert abs(trie.scores([text])[0] - want) < 1e-4 * (1 + abs(want))


def test_contexts_seen_once_are_used_in_a_large_corpus(spark):
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 5)) for _ in range(300)]
    rows = [(1, " ".join(rng.choice(words, 25_000))), (2, "zymurgy quixotic jazz"), (3, "ééé Über")]
    rows += [(10, "zymurgy quixotic jazz"), (11, "a zymurgist"), (12, ""), (13, "é日"), (14, words[0] + " " + words[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = [t.encode().lower() for k, t in rows if k < 10]
    marked = [bytes([ppm.START]) * ppm.ORDER + t + bytes([ppm.END]) for t in train]
    nodes = [{d[i - k : i] for d in marked for i in range(ppm.ORDER, len(d))} for k in range(ppm.ORDER + 1)]
    probability = plain_ppm(train, ppm.ORDER, nodes)
    got = {r.doc_id: r.score for r in ppm.score(docs, F.col("doc_id") >= 10, block_bytes=20_000).collect()}
    for k, t in rows:
        data = bytes([ppm.START]) * ppm.ORDER + t.encode().lower() + bytes([ppm.END])
        want = sum(math.log10(probability(data[i - ppm.ORDER : i], data[i])) for i in range(ppm.ORDER, len(data)))
        assert abs(got[k] - want) < 1e-4 * (1 + abs(want)), k


def check_scores(docs, rows):
    held = {k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    tokens = [(k, [*(t or "").encode().lower().split(), None]) for k, t in rows]
    counts = Counter(w for k, ws in tokens if not held[k] for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (k or -1, held[k], len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for k, ws in tokens
    )
    got = ppm.score(docs, ppm.held_out(), block_bytes=10_000).collect()
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    return got


def test_word_scores_equal_plain_counts(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    check_scores(docs, [(r.doc_id, r.text) for r in docs.collect()])
    check_scores(odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])
    assert ppm.score(no_docs, ppm.held_out()).collect() == []


def test_languages_of_held_out_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").filter("text rlike '[a-z]{3}'")
    models = lang_id.learn(docs, learned=~lang_id.held_out())
    rows = lang_id.identify(docs, models, docs.columns).filter(lang_id.held_out()).collect()
    assert sum(r._llm_lang == r.lang for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r._llm_score <= 1 for r in rows)
    assert sum(r._llm_rejected for r in rows) <= 0.05 * len(rows)


def test_language_of_odd_texts(spark, sf_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    models = lang_id.learn(docs)
    rows = lang_id.identify(odd_docs.withColumn("lang", F.lit(None).cast("string")), models, ["doc_id", "text"]).collect()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r._llm_lang == "und") == (not letters)
        assert r._llm_rejected or letters
    strange = spark.createDataFrame([(1, "日本語テキスト漢字仮名交じり文" * 20), (2, "1234 5678")], "doc_id long, text string")
    assert [r._llm_rejected for r in lang_id.identify(strange, models, ["doc_id", "text"]).collect()] == [True, True]
    assert lang_id.learn(no_docs) is None
    assert lang_id.identify(odd_docs, None, ["doc_id"]).filter("_llm_lang <> 'und'").count() == 0
    assert lang_id.accepted(docs.limit(50)).columns == docs.columns


def test_kneser_ney_sums_to_one():
    models = lang_id.fit_models({"a": ["the cat sat on the mat"], "b": ["der hund und die katze"]})
    codes, starts = lang_id.coded(["the cat sat on the mat"])
    seen = lang_id.coded(["the cat sat on the mat der hund und die katze"])[0]
    alphabet = np.unique(seen)
    for end in (3, 9):
        total = np.zeros(2)
        for c in alphabet:
            probe = np.r_[codes[:end], c].astype(codes.dtype)
            total += np.exp(models.log_probs(probe, np.zeros(1, np.int64))[-1])
        assert np.all(total <= 1.0001) and np.all(total > 0.9)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    current, counts = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, current, sf_dir)
        assert out.columns == docs.columns
        rows = out.collect()
        counts.append((name, len(rows)))
        current = spark.createDataFrame(rows, docs.schema)
        if name == "exact_dedup":
            assert len({r.text for r in rows}) == len(rows)
        if name == "secrets":
            assert not any(base_spans(r.text or "") for r in rows)
    assert counts[0][1] >= 0.97 * docs.count()
    assert counts[1][1] > counts[2][1] == counts[3][1]
    pieces = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in current.collect()}



def test_stages_of_unlabelled_and_repeated_rows(spark, odd_docs, no_docs):
    """Rows without any language label pass, empty tables stay empty, repeated keys keep one row of each text."""
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    docs = spark.createDataFrame([(k, t, None, "s", len(t or "")) for k, t in rows], no_docs.schema)
    for table, empty in ((docs, False), (no_docs, True)):
        current = table
        for name, stage in corpus_pipeline.STAGES:
            current = stage(spark, current, "")
            if name == "language_id":
                assert current.count() == table.count()
            if name != "packing":
                assert current.columns == table.columns
        assert current.isEmpty() == empty
