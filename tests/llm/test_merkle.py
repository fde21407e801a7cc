"""Merkle manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from partqc.llm import merkle
from partqc.llm.common import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, grp string, idx long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(d, more=0):
    doc_id, text, lang, source, n = d
    n = None if n is None else n + more
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n, text)])


def tree(level):
    levels = [level]
    while len(levels[-1]) > 1:
        c = levels[-1]
        levels.append([h(*c[i:i + 2]) for i in range(0, len(c), 2)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((level[j], j > i) if j < len(level) else None)
        i //= 2
    return out


def tampered(d):
    return d[0] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0


def brute(docs):
    """Sorted result rows (as tuples) of the plain computation."""
    groups = {}
    for d in docs:
        groups.setdefault(d[2], []).append(d)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees, rows = {}, {}
    for g in names:
        rows[g] = sorted(groups[g], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        trees[g] = tree([leaf(d) for d in rows[g]])
    top = tree([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, d in enumerate(rows[g]):
            path = proof(trees[g], i) + proof(top, k)
            now = leaf(d, tampered(d))
            for x in path:
                now = h(now) if x is None else h(now, x[0]) if x[1] else h(x[0], now)
            out.append((d[0], leaf(d), trees[g][-1][0], top[-1][0], h(*[x[0] for x in path if x]), now, now == top[-1][0]))
    return sorted(out, key=repr)


def run(spark, docs, builder):
    df = spark.createDataFrame([(*d, "x", 7) for d in docs], SCHEMA)  # columns that clash with inner names
    got = merkle.prove(df, altered={"n_chars": F.col("n_chars") + 1},
                       is_altered=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, builder=builder)
    return sorted((tuple(r) for r in got.collect()), key=repr)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 31, 64, 67])
def test_positions_are_the_order_of_completion(n):
    leaves = [h(str(i)) for i in range(n)]
    levels = tree(leaves)
    log = merkle.append_log(leaves, len(levels) - 1)
    assert len(log) == sum(map(len, levels))
    for level, nodes in enumerate(levels):
        for i, d in enumerate(nodes):
            assert log[merkle.position(level, i, n)] == d
    for i in range(n):
        path = merkle.siblings("".join(log), i, n, len(levels) - 1)
        assert merkle.fold(leaves[i], path) == levels[-1][0]
        assert merkle.unpack(merkle.pack(path)) == path


@pytest.mark.parametrize("builder", [4, 1024])
def test_against_plain_trees(spark, builder):
    rng = random.Random(3)
    docs = [(i, "é" * rng.randint(0, 5), rng.choice(["en", "en", "en", "de", None, "日本"]), "s", i) for i in range(150)]
    docs += [(i, None, "", None, None) for i in (7, 14, 0)]  # nulls, an empty group name, repeated ids
    docs += [(None, "no id", "en", "s", 5), (None, "no id", "en", "s", 5), (3, "x" * 200_000, "fr", "s", 200_000)]
    docs += [docs[0]] * 40  # equal rows over several builders
    assert run(spark, docs, builder) == brute(docs)


def test_many_groups(spark):
    docs = [(i, "t", f"g{i % 37}", "s", 1) for i in range(120)]
    assert run(spark, docs, 4) == brute(docs)


def test_single_leaf_and_empty_table(spark):
    assert run(spark, [(1, "a", "en", "s", 1)], 4) == brute([(1, "a", "en", "s", 1)])
    empty = spark.createDataFrame([], SCHEMA)
    assert merkle.prove(empty).collect() == []


def test_log_holds_every_node(spark):
    with scratch(spark) as tmp:
        nodes = spark.range(11).select(F.lit("g").alias("grp"), F.col("id").alias("idx"), F.lit(11).cast("long").alias("total"),
                                       F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
        made = merkle.build(nodes, tmp, 4)
        rows = made.log().orderBy("tier", "b", "pos").collect()
        root = made.roots.first()["root"].hex()
    levels = tree([h(str(i)) for i in range(11)])
    assert root == levels[-1][0]
    assert {r["digest"] for r in rows} >= {d for level in levels for d in level}
    first = [r["digest"] for r in rows if r["tier"] == 0 and r["b"] == 0]
    assert first == [levels[0][0], levels[0][1], levels[1][0], levels[0][2], levels[0][3], levels[1][1], levels[2][0]]


def test_builder_is_a_power_of_two(spark):
    with pytest.raises(ValueError):
        merkle.prove(spark.createDataFrame([], SCHEMA), builder=6)
