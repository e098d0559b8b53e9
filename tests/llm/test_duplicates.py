"""Exact, shingle, vector and passage duplicates against brute force."""

import hashlib
import itertools

import numpy as np

from tabwright.llm import embed_forest, exact_dedup, ngram_join, substring
from tabwright.llm.components import components


def rows_of(docs):
    return [(r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect()]


def low(k):
    return -1 if k is None else k


def test_exact_groups_with_colliding_hashes(odd_docs):
    rows = rows_of(odd_docs)
    want = []
    for k, t in rows:
        same = [a for a, b in rows if b == t]
        keep = max((a for a in same if a is not None), default=None)
        want.append((low(k), low(keep), len(same), k == keep, hashlib.sha256(t.encode()).hexdigest()))
    for bits, capacity in ((64, 50_000), (2, 1), (1, 1)):  # few bits: every bucket is a chain
        got = exact_dedup.duplicates(odd_docs, bits=bits, capacity=capacity).collect()
        assert sorted((low(r[0]), low(r[1]), r[2], r[3], r[4]) for r in got) == sorted(want)


def test_exact_empty_and_distinct_rows(odd_docs, no_docs):
    assert exact_dedup.duplicates(no_docs).collect() == []
    assert exact_dedup.distinct_rows(no_docs).collect() == []
    left = exact_dedup.distinct_rows(odd_docs)
    assert left.columns == odd_docs.columns
    texts = [t for _, t in rows_of(left)]
    assert sorted(texts) == sorted({t for _, t in rows_of(odd_docs)})


def test_directory_splits_overfull_buckets(spark):
    entries = spark.range(4000).selectExpr("xxhash64(id) AS h")
    buckets = exact_dedup.directory(entries, 64, 100)
    assert sum(n for _, _, n in buckets) == 4000
    assert all(n <= 100 for _, _, n in buckets)
    assert sum(2.0**-d for _, d, _ in buckets) <= 1


def shingles(text):
    words = text.encode().split()
    n = min(5, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else None


def roots(n, links):
    root = list(range(n))
    for _ in range(n):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    return root


def brute_join(rows, threshold=0.8):
    sets = [shingles(t) for _, t in rows]
    links = [
        (a, b)
        for a, b in itertools.combinations(range(len(rows)), 2)
        if sets[a] and sets[b] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    ]
    root = roots(len(rows), links)
    out = []
    for i, (k, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root[j] == root[i]]
        out.append((low(k), sum(i in p for p in links), low(min((g for g in group if g is not None), default=None))))
    return sorted(out)


def near_texts(n, seed=3):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        if i % 4 and out:
            words = out[-1][1].split()
            words[int(rng.integers(len(words)))] = f"new{i}"
        else:
            words = [f"w{x}" for x in rng.integers(0, 3000, 90)]
        out.append((i, " ".join(words)))
    return out


def test_join_on_odd_rows(odd_docs, no_docs):
    got = ngram_join.join(odd_docs).collect()
    assert sorted((low(r.doc_id), r.n_links, low(r.component_id)) for r in got) == brute_join(rows_of(odd_docs))
    assert ngram_join.join(no_docs).collect() == []
    left = ngram_join.representatives(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() < odd_docs.count()
    assert ngram_join.representatives(no_docs).collect() == []


def test_join_equals_brute_force(spark):
    rows = near_texts(160)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for bucket in (2048, 2):  # two: every bucket splits down to the last level
        got = ngram_join.join(docs, bucket=bucket).collect()
        assert sorted((r.doc_id, r.n_links, r.component_id) for r in got) == brute_join(rows)


def test_tiles_count_each_pair_once(spark, monkeypatch):
    rows = near_texts(120, 5)
    docs = spark.createDataFrame(rows + [(1000 + i, t) for i, t in rows[:20]], "doc_id long, text string")
    whole = ngram_join.tiled
    monkeypatch.setattr(ngram_join, "tiled", lambda members: whole(members, 2))
    got = ngram_join.join(docs).collect()
    assert sorted((r.doc_id, r.n_links, r.component_id) for r in got) == brute_join(rows_of(docs))


def test_components_of_a_long_chain(spark):
    links = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    got = components(links)
    assert {r.root for r in got.collect()} == {0}
    assert got.count() == 301


def brute_vectors(rows, threshold=0.9):
    def usable(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)

    good = [i for i, (_, v) in enumerate(rows) if usable(v)]
    links = []
    for a, b in itertools.combinations(good, 2):
        x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
        if len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= threshold:
            links.append((a, b))
    root = roots(len(rows), links)
    return sorted(
        (low(k), sum(i in p for p in links), low(min((rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None), default=None)))
        for i, (k, _) in enumerate(rows)
    )


def test_vectors_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    base = rng.standard_normal((60, 16))
    rows = [(i, [float(x) for x in base[i % 60] + rng.standard_normal(16) * 0.12]) for i in range(240)]
    rows += [(240, rows[0][1]), (241, [2 * x for x in rows[0][1]]), (242, [0.0] * 16), (243, None), (244, [])]
    rows += [(245, [float("nan")] * 16), (246, [None] + [1.0] * 15), (None, rows[1][1]), (3, rows[3][1]), (247, [1.0, 2.0])]
    table = spark.createDataFrame(
        [(k, v, "x") for k, v in rows], "vec_id long, embedding array<double>, node string"
    )
    want = brute_vectors(rows)
    for leaf, node, sample in ((256, 20_000, 50_000), (20, 20_000, 50_000), (20, 50, 10)):
        monkeypatch.setattr(embed_forest.leaves, "__defaults__", (embed_forest.TREES, leaf, sample, node))
        found = embed_forest.near_duplicates(table, leaf=leaf, node=node)
        got = sorted((low(r.vec_id), r.n_links, low(r.component_id)) for r in found.collect())
        found, all_links = sum(g[1] for g in got), sum(w[1] for w in want)
        assert all(g[1] <= w[1] for g, w in zip(got, want))
        assert found >= 0.97 * all_links
    assert embed_forest.near_duplicates(table.limit(0)).collect() == []


def brute_passages(rows, window):
    owner = {}
    split = [(k, t.encode().split()) for k, t in rows]
    for k, w in split:
        for i in range(len(w) - window + 1 if k is not None else 0):
            run = tuple(w[i : i + window])
            owner[run] = min(owner.get(run, k), k)
    out = []
    for k, w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1 if k is not None else 0):
            if owner[tuple(w[i : i + window])] < k:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((low(k), len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def check_passages(docs, window):
    got = substring.digests(docs, window=window).collect()
    assert sorted((low(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_passages(rows_of(docs), window)


def test_passages_on_odd_rows(odd_docs, no_docs):
    check_passages(odd_docs, 13)
    check_passages(odd_docs, 6)
    assert substring.digests(no_docs).collect() == []


def test_passages_equal_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(11)
    shared = [" ".join(f"p{x}" for x in rng.integers(0, 40, n)) for n in (13, 20, 60)]
    rows = []
    for i in range(90):
        own = [f"w{x}" for x in rng.integers(0, 6, int(rng.integers(5, 60)))]
        at = int(rng.integers(len(own)))
        rows.append((i, " ".join([*own[:at], shared[i % 3], *own[at:]])))
    docs = spark.createDataFrame(rows + [(200, rows[4][1]), (5, "other " + rows[7][1])], "doc_id long, text string")
    check_passages(docs, 13)
    whole = substring.removed_ranges
    monkeypatch.setattr(substring, "DRAWN", 1)
    monkeypatch.setattr(substring, "removed_ranges", lambda t, w, g, hot: whole(t, w, g, 3))  # most anchors are hot
    check_passages(docs, 13)
    monkeypatch.setattr(substring, "KNOWN", 0)  # and too many to tell the tasks
    check_passages(docs, 13)


def test_equal_hot_segments_are_looked_into_once(spark, monkeypatch):
    passage = " ".join(f"p{x}" for x in range(60))
    rows = [(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole, sizes, store = substring.removed_ranges, {}, substring.written

    def noted(df, label):
        out = store(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(substring, "written", noted)
    monkeypatch.setattr(substring, "DRAWN", 1)
    monkeypatch.setattr(substring, "removed_ranges", lambda t, w, g, hot: whole(t, w, g, 3))
    check_passages(docs, 13)
    inner = sizes["passage-dense"] / 40  # segments of a document
    assert sizes["passage-different"] <= inner + 2 * 40  # those at its ends differ


def test_equal_segments_of_a_text_are_one_row(spark, monkeypatch):
    rows = [(i, f"a{i} b{i} " + "to be " * 60 + f"c{i} " + "to be " * i) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_passages(docs, 13)
    whole, sizes, store = substring.removed_ranges, {}, substring.written

    def noted(df, label):
        out = store(df, label)
        sizes[label] = out.count()
        return out

    monkeypatch.setattr(substring, "written", noted)
    monkeypatch.setattr(substring, "DRAWN", 1)
    monkeypatch.setattr(substring, "removed_ranges", lambda t, w, g, hot: whole(t, w, g, 3))
    check_passages(docs, 13)
    assert sizes["passage-dense"] <= 10 * 30  # a text has over 50 segments, most of them equal


def test_automaton_matches_equal_search():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 3, 30).tolist() for _ in range(12)]
    automaton = substring.Automaton()
    for t in texts[:6]:
        automaton.add(t)
    grams = {tuple(t[i : i + 5]) for t in texts[:6] for i in range(26)}
    for t in texts:
        covered = set()
        for i in range(26):
            if tuple(t[i : i + 5]) in grams:
                covered.update(range(i, i + 5))
        assert {i for a, b in automaton.matches(t, 5) for i in range(a, b)} == covered


def test_representatives_with_repeated_keys(spark):
    a = "one two three four five six seven eight nine ten eleven twelve"
    b = "red green blue white black pink brown grey gold silver olive teal"
    rows = [(1, a), (2, a), (2, b), (3, b), (4, a + " thirteen"), (5, None), (5, None), (6, b), (6, b), (None, "z " + b)]
    docs = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(rows)], "doc_id long, text string, root int")
    left = ngram_join.representatives(docs)
    assert left.columns == docs.columns
    near = {r.doc_id for r in left.collect() if r.text and r.text.startswith("one")}
    assert near == {1}
    assert sorted((r.doc_id, r.text) for r in left.collect() if r.text and "red" in r.text and r.doc_id is not None) in ([], [(2, b)])
    assert sum(bool(r.text) and "red" in r.text for r in left.collect()) == 1
    assert sum(r.text is None for r in left.collect()) == 2
    twice = spark.createDataFrame([(7, a), (7, a), (7, b), (7, "p " + b)], "doc_id long, text string")
    texts = sorted(r.text for r in ngram_join.representatives(twice).collect())
    assert len(texts) == 2 and texts[0] == a
