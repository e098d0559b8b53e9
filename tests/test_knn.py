"""Nearest neighbours against brute force, with copies, ties and a hot cell."""

import numpy as np
import pytest

from tabwright.operators import knn as K
from tabwright.operators import knn_hashed as H
from tabwright.session import written


def brute(q, t, tid, k, metric):
    out = []
    for x in q:
        d = np.abs(t - x).sum(1) if metric == "manhattan" else np.sqrt(((t - x) ** 2).sum(1))
        best = np.lexsort((tid, d))[:k]
        out.append([(int(tid[i]), round(float(d[i]), 9)) for i in best])
    return out


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    train = rng.normal(0, 1, (1500, 3))
    train[:500] = train[0]  # a third of the rows are copies
    train[500:900] *= 8
    queries = np.vstack([rng.normal(0, 2, (60, 3)), train[:1], train[700:705]])
    return queries, train


def frame(spark, rows, labels=None):
    data = [(i, r.tolist(), None if labels is None else labels[i]) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "id long, features array<double>, label int")


@pytest.mark.parametrize("metric", ["euclidean", "manhattan"])
@pytest.mark.parametrize("blocks", [(8192, 4096), (50, 7)])
def test_exact(spark, data, metric, blocks, monkeypatch):
    monkeypatch.setattr(K, "TRAIN_BLOCK", blocks[0])
    monkeypatch.setattr(K, "QUERY_BLOCK", blocks[1])
    queries, train = data
    got = K.nearest_neighbors(frame(spark, queries), frame(spark, train), 7, metric=metric).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r["qid"], r["rank"])):
        by.setdefault(r["qid"], []).append((r["tid"], round(r["distance"], 9)))
    want = brute(queries, train, np.arange(len(train)), 7, metric)
    assert [by[i] for i in range(len(queries))] == want


def test_more_neighbours_than_rows(spark):
    t = np.arange(6.0).reshape(3, 2)
    got = K.nearest_neighbors(frame(spark, t), frame(spark, t), 10).collect()
    assert len(got) == 9 and min(r["distance"] for r in got) == 0.0


def test_no_training_rows(spark):
    t = frame(spark, np.zeros((2, 2)))
    assert K.nearest_neighbors(t, t.limit(0), 3).count() == 0


def test_votes(spark):
    train = frame(spark, np.array([[0.0], [1.0], [2.0], [10.0]]), [1, 0, 0, 1])
    query = frame(spark, np.array([[0.0], [9.0]]))
    uniform = {r["id"]: r["prediction"] for r in K.knn_predict(query, train, "label", 3).collect()}
    assert uniform == {0: 0, 1: 0}
    weighted = {r["id"]: r["prediction"] for r in K.knn_predict(query, train, "label", 3, weights="distance").collect()}
    assert weighted == {0: 1, 1: 1}
    tied = K.knn_predict(query, train, "label", 4).filter("id = 0").first()["prediction"]
    assert tied == 0
    mean = K.knn_predict(query, train, "label", 4, task="regression").filter("id = 0").first()["prediction"]
    assert mean == 0.5


@pytest.mark.parametrize("block", [60, 8192])
def test_hash_tables_meet_their_recall(spark, monkeypatch, block):
    """Clusters, a third of the rows one vector, unsound rows; buckets cut into blocks of 60 rows too."""
    monkeypatch.setattr(H, "TRAIN_BLOCK", block)
    monkeypatch.setattr(H, "QUERY_BLOCK", block)
    rng = np.random.default_rng(11)
    x = rng.normal(size=(40, 12))[rng.integers(40, size=1600)] * 3 + rng.normal(size=(1600, 12))
    x = np.r_[x, np.repeat(x[:1], 800, axis=0)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(9001, None), (9002, [float("nan")] * 12), (9003, [None] + [0.0] * 11), (9004, [float("inf")] * 12)]
    train = spark.createDataFrame(rows + odd, "id long, x array<double>")
    queries = train.filter("id % 8 = 0 OR id > 9000")
    found = H.hashed_neighbors(queries, train, 5, "x", "id", bucket_rows=100).collect()
    exact = {}
    for i in range(0, len(x), 8):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        exact[i] = np.lexsort((np.arange(len(x)), d))[:5].tolist()
    assert len(found) == 5 * len(exact) == len({(r.qid, r.tid) for r in found})
    assert sum(r.tid in exact[r.qid] for r in found) >= 0.9 * len(found)
    for r in found:
        assert r.distance == pytest.approx(float(np.linalg.norm(x[r.qid] - x[r.tid])), abs=1e-9)
    empty = train.limit(0)
    assert H.hashed_neighbors(empty, train, 5, "x", "id").collect() == []
    assert H.hashed_neighbors(queries, empty, 5, "x", "id").collect() == []


@pytest.mark.parametrize("size, held", [(8 * 12 * 300, 50_000), (1 << 25, 7)])
def test_queries_travel_to_groups_and_meet_all_rows_of_their_buckets(spark, monkeypatch, size, held):
    """A copy of the vector for every bucket visited filled the disk."""
    kept, tables, fit = {}, [], H.fit_tables

    def keep(df, label):
        kept[label] = written(df, label)
        return kept[label]

    def fitting(*args):
        tables.append(fit(*args))
        return tables[-1]

    monkeypatch.setattr(H, "written", keep)
    monkeypatch.setattr(H, "fit_tables", fitting)
    monkeypatch.setattr(H, "TRAIN_BLOCK", 60)
    monkeypatch.setattr(H, "QUERY_BLOCK", 40)
    monkeypatch.setattr(H, "GROUP_BYTES", size, raising=False)
    monkeypatch.setattr(H, "ANSWERS", held, raising=False)
    x = np.random.default_rng(4).normal(size=(1200, 12))
    x[700:1000] = x[0]  # a bucket above the size of a block
    train = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    queries = train.filter("id % 4 = 0")
    found = H.hashed_neighbors(queries, train, 5, "x", "id", bucket_rows=40).collect()
    fitted = tables[0]
    visits = fitted.visits(fitted.sides(x[::4]), fitted.probes)
    assert fitted.probes > 1
    assert not any("qx" in df.columns for label, df in kept.items())
    own = fitted.buckets(fitted.sides(x))
    expected = []
    for at, i in enumerate(range(0, len(x), 4)):
        near = np.flatnonzero((own[:, :, None] == visits[at][None]).any(axis=(1, 2)))
        d = np.sqrt(((x[near] - x[i]) ** 2).sum(axis=1))
        expected += [(i, int(near[j]), rank) for rank, j in enumerate(np.lexsort((near, d))[:5], 1)]
    assert sorted((r.qid, r.tid, r["rank"]) for r in found) == sorted(expected)


def test_probes_come_in_the_order_of_the_cuts_crossed():
    rng = np.random.default_rng(2)
    sample = rng.normal(size=(500, 6))
    fitted = H.fit_tables(sample, 500, 3, 2, 0.9, 1, bucket_rows=30)
    sides = fitted.sides(sample[:20])
    visits = fitted.visits(sides, len(fitted.crossings))
    assert (visits[:, :, 0] == fitted.buckets(sides)).all()
    assert all(len(set(v)) == len(v) for row in visits for v in row.tolist())
    bits = sides.shape[2]
    for row, cuts in zip(visits, sides):
        for order, cut in zip(row, cuts):
            cost = [sum(cut[b] ** 2 for b in range(bits) if (code ^ order[0]) >> b & 1) for code in order.tolist()]
            assert cost == sorted(cost)


def test_manhattan_passes_over_most_rows_and_stays_exact():
    """Candidates hold every nearest row, ties, near ties, huge and missing numbers included, and seldom any other."""
    rng = np.random.default_rng(9)
    train = rng.normal(0, 1, (3000, 16))
    train[:40] = train[40:80]
    queries = np.r_[train[:5], rng.normal(0, 1, (20, 16))]
    sizes = [len(c) for c in K._manhattan_candidates(queries, train, 4)]
    assert max(sizes) <= 20
    shifted = train + 1e7  # single precision tells few of these apart
    tiny = train * 1e-40
    odd = np.where(rng.random((3000, 16)) < 1e-4, 1e300, train)
    for t, q in ((train, queries), (shifted, queries + 1e7), (tiny, queries * 1e-40), (odd, queries)):
        ids = rng.permutation(len(t))
        for i, rows, d in K._block_neighbours(q, t, ids, 4, "manhattan"):
            exact = np.abs(t - q[i]).sum(axis=1)
            best = np.lexsort((ids, exact))[:4]
            assert rows.tolist() == best.tolist() and d.tolist() == exact[best].tolist()
