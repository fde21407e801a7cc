"""Nearest neighbours (R3): the tile join against brute force, the index by recall."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from partqc.operators import neighbours as nn
from partqc.operators.smote import Smote
from partqc.sources.tables import EV_FEATURES, events_view

from conftest import SF01


def brute(keys, X, k):
    out = {}
    for i in range(len(X)):
        acc = np.zeros(len(X))
        for j in range(X.shape[1]):
            d = X[:, j] - X[i, j]
            acc += d * d
        d = np.sqrt(acc)
        d[i] = np.inf
        out[int(keys[i])] = [(int(keys[a]), float(d[a])) for a in np.lexsort((keys, d))[:k]]
    return out


def frame(spark, keys, X):
    return spark.createDataFrame([(int(a), list(map(float, x))) for a, x in zip(keys, X)], "key long, x array<double>")


def found(df, key="key"):
    got = {}
    for r in df.orderBy(key, "rank").collect():
        assert r["rank"] == len(got.setdefault(r[key], [])) + 1
        got[r[key]].append((r["neighbour"], r["distance"]))
    return got


@pytest.mark.parametrize("n,dims,copies,block", [(400, 2, 0, 60), (500, 5, 200, 64), (150, 72, 40, 50), (90, 3, 0, 4096)])
def test_tile_join_is_exact(spark, n, dims, copies, block):
    rng = np.random.default_rng(n)
    X = np.round(rng.normal(size=(n, dims)), 1 if dims < 5 else 6)
    X[50:50 + copies] = X[3]  # one group of copies of up to 40 per cent
    keys = rng.permutation(3 * n)[:n]
    assert found(nn.neighbours(frame(spark, keys, X), "key", 5, n, block=block)) == brute(keys, X, 5)


def test_index_recall_and_true_distances(spark):
    rng = np.random.default_rng(8)
    X = rng.normal(size=(40, 16))[rng.integers(40, size=900)] + 0.2 * rng.normal(size=(900, 16))
    X[100:300] = X[0]
    keys = np.arange(900)
    df = frame(spark, keys, X)
    got = nn.neighbours(df, "key", 5, 900, method="lsh", block=128)
    exact = nn.neighbours(df, "key", 5, 900, block=128)
    assert nn.recall(got, exact, "key") >= 0.9
    assert nn.recall(exact, exact, "key") == 1.0
    for key, pairs in found(got).items():
        assert len(pairs) == 5  # vectors that find too few are searched exactly
        for other, d in pairs:
            assert other != key and d == pytest.approx(np.linalg.norm(X[key] - X[other]), abs=1e-9)


def test_index_recall_on_events(spark):
    ev = events_view(spark, SF01)
    results = {m: Smote(method=m).prepare(ev, "y", "event_id", EV_FEATURES).neighbours for m in ("exact", "lsh")}
    assert nn.recall(results["lsh"], results["exact"], "event_id") >= 0.9


def test_small_and_equal(spark):
    two = found(nn.neighbours(frame(spark, [4, 9], [[0.0], [3.0]]), "key", 5, 2))
    assert two == {4: [(9, 3.0)], 9: [(4, 3.0)]}
    for method in ("exact", "lsh"):
        same = found(nn.neighbours(frame(spark, range(30), [[1.0, 2.0]] * 30), "key", 3, 30, method=method, block=8))
        assert same == {i: [(j, 0.0) for j in range(5) if j != i][:3] for i in range(30)}
    with pytest.raises(ValueError):
        nn.neighbours(frame(spark, [1, 2], [[0.0], [1.0]]), "key", 1, 2, method="guess")


def test_smote_by_index_draws_every_row(spark):
    ev = events_view(spark, SF01)
    res = Smote(k=5, seed=2, method="lsh").prepare(ev, "y", "event_id", EV_FEATURES)
    assert res.synthetic().count() == res.n_new
    assert res.resampled().groupBy("y").count().select(F.countDistinct("count")).first()[0] == 1


def test_a_bundle_of_buckets_is_its_buckets_one_by_one(monkeypatch):
    import pyarrow as pa
    rng = np.random.default_rng(4)
    n, k = 600, 4
    X = rng.integers(0, 6, (n, 3)).astype(float)  # ties
    t, h = rng.integers(0, 2, n).astype(np.int32), rng.choice([5, 9, 9, 9, 2 ** 40, -7, *range(100, 140)], n)
    table = pa.table({"t": t, "h": h, "vid": np.arange(n), "x": pa.array(list(X)), "keys": pa.array([[i, i + n] for i in range(n)])})
    rows = lambda x: sorted(zip(*(x.column(c).to_pylist() for c in ("vid", "neighbour", "distance"))))
    want = []
    for a, b in {(a, b) for a, b in zip(t.tolist(), h.tolist())}:
        part = table.filter(pa.array((t == a) & (h == b)))
        want += rows(nn._tile(k)(part.append_column("bound", pa.array([np.inf] * len(part))), part))
    for small in (0, 10, 1000):
        monkeypatch.setattr(nn, "_PAIRWISE", small or 1)
        assert rows(nn._bundle(k)(table)) == sorted(want)
