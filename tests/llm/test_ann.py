"""Nearest neighbours against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from partqc.llm import ann


def brute(rows, k):
    out = []
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    for i, q in ok:
        if i % 20 == 0:
            best = sorted(((-float(ann.dot(q[None], c[None])[0]), j) for j, c in ok if j != i and len(c) == len(q)))[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(best)]
    return sorted(out)


def result(spark, rows, k=20, **more):
    df = spark.createDataFrame([(i, v, 3, "x") for i, v in rows], "vec_id long, embedding array<float>, size int, query string")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0, k=k, **more).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


def close(a, b):
    assert [x[:3] for x in a] == [x[:3] for x in b]
    assert np.allclose([x[3] for x in a], [x[3] for x in b], rtol=1e-12, atol=1e-12)


@pytest.mark.parametrize("block_bytes", [1 << 22, 4096, 200])
def test_equal_to_all_products(spark, block_bytes):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(230, 16)).astype(np.float32)
    x[40:90] = x[40]  # one common vector
    x[100:120] *= 1000
    close(result(spark, list(enumerate(x.tolist())), block_bytes=block_bytes), brute(list(enumerate(x.astype(float).tolist())), 20))


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [0.0, 0.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [-1.0, 0.5]),
            (None, [9.0, 9.0]), (20, [1.0]), (8, [2.0, 2.0]), (9, [2.0, 2.0]), (40, [1.0, 1.0, 1.0])]
    close(result(spark, rows), brute(rows, 20))
    assert result(spark, []) == []


def test_tile_bounds_hold_and_heaps_merge(monkeypatch):
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    monkeypatch.setattr(ann, "CANDIDATE_ROWS", 11)
    rng = np.random.default_rng(1)
    q, c = rng.normal(size=(20, 30)), rng.normal(size=(60, 30)) * rng.lognormal(size=(60, 1))
    heaps = ann.tile(np.arange(100, 120), q, np.arange(60), c, 5)
    for i, h in enumerate(heaps):
        want = sorted(((float(ann.dot(q[i:i + 1], c[j:j + 1])[0]), -j) for j in range(60)), reverse=True)[:5]
        assert sorted(h, reverse=True) == want
    s, a, n, r, m = ann.quantise(c)
    s2, a2, n2, r2, m2 = ann.quantise(q)
    bound = n2[:, None] * r + r2[:, None] * m
    assert (np.abs(q @ c.T - (a2.astype(float) @ a.T.astype(float)) * s2[:, None] * s) <= bound + 1e-9).all()
