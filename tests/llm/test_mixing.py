"""Mixing against plain Python."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from partqc.llm import mixing


def md5(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


def weights(tokens, goal, most, budget):
    t = sorted(tokens)
    p = [x / sum(t) for x in t]
    z = lambda m: sum(x ** m for x in p)

    def bisect(above):
        lo, hi = 0.0, 1.0
        for _ in range(50):
            m = (lo + hi) / 2
            lo, hi = (m, hi) if above(m) else (lo, m)
        return lo, hi

    entropy = lambda m: -sum(x ** m / z(m) * math.log(x ** m / z(m)) for x in p)
    e = bisect(lambda m: entropy(m) >= goal * math.log(len(p)))[0]
    if budget / len(p) / p[0] > most:
        e = max(e, bisect(lambda m: budget * p[0] ** m / z(m) / p[0] > most)[1])
    return e, z(e), sum(t)


def brute(rows, goal=0.95, most=4.0, budget=1.0, block=4096, seed=5):
    by = defaultdict(list)
    for i, s, t in rows:
        n = len((t or "").split())
        if n:
            by[s].append((i, n, int(hashlib.md5(t.encode()).hexdigest()[:15], 16)))
    total = {s: sum(x[1] for x in d) for s, d in by.items()}
    e, z, all_ = weights(total.values(), goal, most, budget)
    out = []
    for s, d in by.items():
        quota = math.floor(round((total[s] / all_) ** e / z * budget * all_, 3))
        whole, rest = divmod(quota, total[s])
        blocks = defaultdict(list)
        for i, n, tie in d:
            blocks[int(md5(seed, i, tie)[:8], 16) % math.ceil(len(d) / block)].append((i, n, tie))
        for epoch in range(whole + 1):
            left = rest if epoch == whole else total[s]
            for rank, b in enumerate(sorted(blocks, key=lambda b: (md5(seed, epoch, "block", b), b)), 1):
                if left <= 0:
                    break
                size = sum(x[1] for x in blocks[b])
                take = sorted(blocks[b], key=lambda x: (md5(seed, epoch, "row", x[0]), *x[1:]))
                if size > left:
                    kept, used = [], 0
                    for x in take:
                        used += x[1]
                        if used > left:
                            break
                        kept.append(x)
                    take = kept
                out += [(i, s, n, epoch, rank) for i, n, _ in take]
                left -= size
    return sorted(out, key=repr)


def corpus():
    rows = []
    for s, n in (("hot", 120), ("mid", 40), ("small", 9), (None, 5)):
        for j in range(n):
            rows.append((len(rows), s, " ".join(["w"] * (1 + (j * 7) % 23))))
    return rows + [(900, "hot", ""), (901, "empty", None), (902, "empty", "  ")]


@pytest.mark.parametrize("more", [{}, {"max_repeats": 1.5}, {"target_entropy": 0.999, "max_repeats": 50.0}, {"budget": 3.7},
                                  {"block_rows": 8}, {"block_rows": 1, "budget": 0.3}, {"target_entropy": 0.0}])
def test_draws_equal_plain_python(spark, more):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, source string, text string, blocks int, key string")
    got = mixing.mix_sources(df, **more)
    assert got.columns == ["doc_id", "source", "text", "blocks", "key", "n_tokens", "epoch", "block_rank"]
    names = {"target_entropy": "goal", "max_repeats": "most", "block_rows": "block"}
    want = brute(rows, **{names.get(k, k): v for k, v in more.items()})
    assert sorted(((r["doc_id"], r["source"], r["n_tokens"], r["epoch"], r["block_rank"]) for r in got.collect()), key=repr) == want
    budget = more.get("budget", 1.0) * sum(len((t or "").split()) for _, _, t in rows)
    assert budget - 4 * 23 - 4 <= sum(r[2] for r in want) <= budget
    if not more:
        assert max(Counter(r[0] for r in want).values()) <= 5


def test_repeated_ids_null_ids_one_source_and_empty_table(spark):
    schema = "doc_id long, source string, text string"
    rows = [(1, "a", "x y"), (1, "a", "x y"), (None, "a", "x"), (2, "a", "x y z")]
    got = mixing.mix_sources(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in got if r["doc_id"]) == [(1, 2), (1, 2), (2, 3)] and len(got) == 4
    half = mixing.mix_sources(spark.createDataFrame(rows, schema), budget=0.5).collect()
    assert 0 < sum(r["n_tokens"] for r in half) <= 4
    assert mixing.mix_sources(spark.createDataFrame([], schema)).count() == 0
    assert mixing.mix_sources(spark.createDataFrame([(1, "a", "")], schema)).count() == 0


def test_many_rows_of_one_id_are_dealt_over_blocks(spark):
    """100,000 rows of one id, 20,000 null ids, 3,000 rows alike."""
    one = spark.range(100_000).selectExpr("7L AS doc_id", "'hot' AS source", "concat('w ', id) AS text")
    none = spark.range(20_000).selectExpr("CAST(NULL AS LONG)", "'hot'", "concat('v v ', id)")
    alike = spark.range(3000).selectExpr("8L", "'cold'", "'same words here'")
    got = mixing.mix_sources(one.union(none).union(alike), budget=0.7)
    by = got.groupBy("source", "epoch", "block_rank").count().collect()
    assert max(r["count"] for r in by if r["source"] == "hot") < 4096 * 1.2
    tokens = 100_000 * 2 + 20_000 * 3 + 3000 * 3
    drawn = got.agg({"n_tokens": "sum"}).first()[0]
    assert 0.7 * tokens - 2 * 3 - 2 <= drawn <= 0.7 * tokens
    rows = got.filter("doc_id = 7 AND epoch = 0")
    assert rows.count() == rows.distinct().count()


def test_many_sources_stay_off_the_driver(spark, monkeypatch):
    docs = spark.range(100_000).selectExpr(
        "id AS doc_id", "concat('s', id) AS source", "array_join(array_repeat('w', int(1 + id % 50)), ' ') AS text")
    got, before = [], DataFrame.collect
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "collect", lambda self: got.append(before(self)) or got[-1])
        mixed = mixing.mix_sources(docs, target_entropy=1.0, max_repeats=3.0)
    assert max(map(len, got)) <= 2 * mixing.POINTS
    by = {r["n"]: r for r in mixed.groupBy("source").agg(F.sum("n_tokens").alias("s"), F.max("n_tokens").alias("n"))
          .groupBy("n").agg(F.max("s").alias("s"), F.count("*").alias("sources")).collect()}
    n = np.arange(1, 51)  # 2,000 sources of each size
    p, k = n / (2000 * n.sum()), 2000
    lo, hi = 0.0, 1.0
    for _ in range(50):
        m = (lo + hi) / 2
        lo, hi = (m, hi) if p[0] ** m / (k * (p ** m).sum()) / p[0] > 3 else (lo, m)
    quota = np.floor(np.round(p ** hi / (k * (p ** hi).sum()) * k * n.sum(), 3)).astype(int)
    assert 0 < hi < 1
    for x, q in zip(n.tolist(), quota.tolist()):
        assert (by[x]["s"] if x in by else 0) == q // x * x and (x not in by or by[x]["sources"] == 2000)


def test_a_tiny_source_keeps_its_quota(spark):
    """Weights below 5e-10 are not rounded away."""
    sizes = spark.createDataFrame([("all", 10 ** 14), ("few", 3000)], "source string, tokens long")
    got = {r["source"]: r for r in mixing.source_weights(sizes, 0.0, 4.0, 1.0).collect()}
    assert got["few"]["quota"] == 3000 and got["few"]["exponent"] > 1 - 1e-9
