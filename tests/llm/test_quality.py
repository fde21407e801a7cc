"""Risk, prior and held-out quality of the classifier."""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from partqc.llm import quality


def test_statistics_of_odd_texts():
    x = quality.statistics(pa.array(["", None, "a", "A a A a", "é😀|\n", "word " * 3000], pa.string()))
    assert x.shape == (6, quality.N_STATS) and np.isfinite(x).all()
    assert (x[0] == 0).all() and (x[1] == 0).all()
    k = len(quality.CLASSES)
    assert x[5, k + 5] == 1.0 and abs(x[5, k + 6] - 1 / 3000) < 1e-12 and x[5, k + 7] == 1.0
    whole = quality.statistics(pa.array(["x", "A a A a"]))
    assert np.allclose(whole[1], x[3])


def test_positive_unlabelled_risk_finds_prior_and_negatives():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (6000, 3)), rng.normal(3, 1, (6000, 3))
    unlabelled = np.concatenate((good[:2800], bad[:1200]))
    m = quality.fit(good[3000:], unlabelled)
    assert 0.6 < m.prior < 0.8
    assert (m.score(good[2800:3000]) >= 0.3).mean() > 0.97 and (m.score(bad[2000:]) >= 0.3).mean() < 0.1


def test_fit_without_one_part():
    x = np.random.default_rng(0).normal(size=(20, 3))
    for p, u in ((x, x[:0]), (x[:0], x)):
        assert (quality.fit(p, u).score(x) == 0.5).all()


def test_held_out(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = quality.score_quality(docs.select("doc_id", "text"), labels).collect()
    mark = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(rows) == docs.count() and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in mark]
    good = [r["predicted"] for r in held if mark[r["doc_id"]] == 1]
    bad = [r["predicted"] for r in held if mark[r["doc_id"]] == 0]
    assert np.mean(good) > 0.98 and np.mean(bad) < 0.25


def test_nulls_clashes_and_empty_tables(spark):
    docs = "doc_id long, text string, score string, row int"
    labels = "doc_id long, quality int, toxic int"
    rows = [(i, f"some words here {i}" if i % 3 else "!!! !!! !!!", "s", 1) for i in range(60)]
    rows += [(None, None, None, None), (61, "", "s", 1), (61, "again", "s", 1)]
    marks = [(i, int(i % 3 > 0), 0) for i in range(0, 60, 2)] + [(None, 1, 1), (3, None, 0), (5, 0, 0), (5, 1, 0)]
    df, lab = spark.createDataFrame(rows, docs), spark.createDataFrame(marks, labels)
    got = quality.score_quality(df, lab)
    assert got.columns == ["doc_id", "text", "row", "held_out", "score", "predicted"]
    got = got.collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    again = quality.score_quality(df.repartition(7), lab.repartition(3)).collect()
    assert sorted((r["doc_id"] or -1, r["score"]) for r in got) == sorted((r["doc_id"] or -1, r["score"]) for r in again)
    assert quality.score_quality(spark.createDataFrame([], docs), lab).count() == 0
    assert {r["score"] for r in quality.score_quality(df, spark.createDataFrame([], labels)).collect()} == {0.5}


def test_descent_equals_a_plain_loop():
    """Adam on the non-negative risk, one row and one weight at a time."""
    rng = np.random.default_rng(3)
    bp, bu = rng.integers(0, 4, (30, 2)) + [0, 4], rng.integers(0, 4, (40, 2)) + [0, 4]
    bp[:, 0] = bp[:, 0] // 2
    prior, steps, rate, l2 = 0.6, 60, 0.3, 1e-3
    w, m, v = [0.0] * 9, [0.0] * 9, [0.0] * 9
    turned = 0
    for t in range(1, steps + 1):
        g_p, g_n, g_u = [0.0] * 9, [0.0] * 9, [0.0] * 9
        risk_n = risk_u = 0.0
        for rows, up, parts in ((bp, prior, ((g_p, -1), (g_n, 0))), (bu, 1.0, ((g_u, 0),))):
            for row in rows.tolist():
                z = sum(w[b] for b in row) + w[8]
                s = 1 / (1 + math.exp(-z))
                if rows is bp:
                    risk_n += math.log(1 + math.exp(z)) / len(bp)
                else:
                    risk_u += math.log(1 + math.exp(z)) / len(bu)
                for g, off in parts:
                    for b in [*row, 8]:
                        g[b] += up * (s + off) / len(rows)
        back = risk_u - prior * risk_n < 0
        turned += back
        for b in range(9):
            g = g_n[b] - g_u[b] if back else g_p[b] + g_u[b] - g_n[b]
            g += l2 * w[b] if b < 8 else 0
            m[b], v[b] = 0.9 * m[b] + 0.1 * g, 0.999 * v[b] + 0.001 * g * g
            w[b] -= rate * (m[b] / (1 - 0.9 ** t)) / (math.sqrt(v[b] / (1 - 0.999 ** t)) + 1e-8)
    got, bias = quality._descend(bp, bu, 8, prior, steps, rate, l2, True)
    assert turned > 0 and np.allclose([*got, bias], w, atol=1e-9)


def test_many_rows_of_one_id_stay_within_the_bound(spark, monkeypatch):
    i = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5)
    rows = spark.range(100_000).select(F.lit(i).cast("long").alias("doc_id"), F.concat_ws(
        " ", F.lit("of one id"), F.col("id") % 50_000).alias("text"))
    marks = spark.createDataFrame([(i, 1)], "doc_id long, quality int")
    got, before = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: got.append(before(self)) or got[-1])
    quality.learn(rows, marks, "doc_id", "text", "quality", 5, 0, 500)
    assert [len(x) for x in got] == [500, 500]
