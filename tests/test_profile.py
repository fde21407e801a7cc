"""Column profiles (A4) and correlation (A5) against numpy."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from partqc.operators import profile, quantiles


def odd_frame(n=6000):
    rng = np.random.default_rng(4)
    heavy = np.where(rng.random(n) < 0.4, 7.0, rng.normal(size=n))  # one value holds much of the rows
    tail = rng.pareto(0.5, n)
    tail[:5] = -1e300
    return pd.DataFrame({"heavy": heavy, "tail": tail, "few": rng.integers(0, 3, n).astype(float), "same": np.ones(n),
                         "gaps": np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n)), "sorted": np.arange(n) * 1.0})


@pytest.mark.parametrize("size,most,parts", [(2048, 65_536, 3), (32, 40, 9), (8, 10, 1), (16, 20, 80)])
def test_quantiles_are_exact_in_any_number_of_passes(spark, size, most, parts):
    pdf = odd_frame()
    df = spark.createDataFrame(pdf).repartition(parts)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {(r["column"], r["prob"]): r["quantile"] for r in
           quantiles.exact_quantiles(df, list(pdf), probs, size, most).collect()}
    for c in pdf:
        x = pdf[c].dropna().to_numpy()
        for p in probs:
            assert got[c, p] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-12), (c, p)


def test_sketch_bounds_hold():
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=5000), np.zeros(3000), rng.exponential(size=2000)])
    rng.shuffle(x)
    total = quantiles._Sketch()
    for part in np.array_split(x, 13):
        one = quantiles._Sketch()
        for batch in np.array_split(part, 5):
            one.add(batch, 16)
        total.merge(quantiles._of(one.row(0, 0)))
        total.compress(16)
    s = np.sort(x)
    assert total.n == len(x) and total.mean == pytest.approx(x.mean()) and total.m2 == pytest.approx(x.var() * len(x))
    assert sum(map(len, (v for parts in total.levels.values() for v in parts))) < 600
    for k in [0, 1, 17, 4999, 5000, 7000, 9998, 9999]:
        a, b, most = total.bracket(k)
        assert a <= s[k] <= b and int(((s > a) & (s < b)).sum()) <= most
        assert most < 0.5 * len(x)


def test_describe_edges(spark):
    df = spark.createDataFrame([(1.0, None, 3), (float("nan"), None, 5)], "a double, b double, c int")
    got = {r["column"]: r for r in profile.describe_columns(df, ["a", "b", "c"]).collect()}
    assert (got["a"]["count"], got["a"]["std"], got["a"]["q50"]) == (1, None, 1.0)
    assert got["b"]["count"] == 0 and got["b"]["q25"] is None and got["b"]["min"] is None
    assert (got["c"]["mean"], got["c"]["q25"], got["c"]["std"]) == (4.0, 3.5, pytest.approx(math.sqrt(2)))
    assert profile.describe_columns(df.limit(0), ["a"]).first()["count"] == 0


def test_describe_does_not_explode_rows(spark):
    df = spark.createDataFrame(odd_frame(500))
    plan = profile.describe_columns(df, list(df.columns))._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan


def test_correlation_is_one_scan_and_keeps_large_means(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 6))
    x[:, 1] += x[:, 0]
    x[:, 2] = 1e9 + x[:, 0]  # sums of squares would cancel
    x[:, 5] = 3.0
    pdf = pd.DataFrame(x, columns=list("abcdef"))
    df = spark.createDataFrame(pdf).repartition(7)
    out = profile.correlation_matrix(df, list("abcdef"))
    got = {(r["col_a"], r["col_b"]): r["r"] for r in out.collect()}
    want = np.corrcoef(x[:, :5].T)
    for i, a in enumerate("abcde"):
        for j, b in enumerate("abcde"):
            assert got[a, b] == pytest.approx(want[i, j], abs=1e-7)
        assert got[a, "f"] is None
    many = profile.correlation_matrix(df.repartition(200), list("abc"))  # two merge steps
    assert {(r["col_a"], r["col_b"]): r["r"] for r in many.collect()}["a", "c"] == pytest.approx(got["a", "c"], abs=1e-9)
    assert profile.correlation_matrix(df.where(F.lit(False)), ["a", "b"]).where("r is not null").isEmpty()
