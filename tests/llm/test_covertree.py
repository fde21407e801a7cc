"""Cover-tree codes against plain Lloyd rounds."""

import hashlib
import math

import numpy as np
import pytest

from partqc.llm import covertree

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vec int"


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(256 * float(np.float32(y))) for y in r[1]] for r in kept], dtype=object)
    w = x.shape[1] // parts
    cut = [[tuple(v[p * w:(p + 1) * w]) for v in x] for p in range(parts)]
    books = [c[:entries] for c in cut]

    def nearest(p, v):
        return min(range(len(books[p])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(v, books[p][e])), e))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            own = [nearest(p, v) for v in cut[p]]
            for e in set(own):
                mine = [v for v, o in zip(cut[p], own) if o == e]
                new[p][e] = tuple(sum(c) // len(mine) for c in zip(*mine))
        books = new
    out, by = [], {}
    for i, r in enumerate(kept):
        own = [nearest(p, cut[p][i]) for p in range(parts)]
        err = sum(sum((a - b) ** 2 for a, b in zip(cut[p][i], books[p][e])) for p, e in enumerate(own))
        out.append([r[0], "".join(f"{e:02x}" for e in own), err, r[2]])
        by[r[2]] = by.get(r[2], 0) + err
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((i, code, err, by[label], sha) for i, code, err, label in out), key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in covertree.encode(df, **more).collect()), key=repr)


def cloud(n, dims, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (6, dims))
    return [[float(np.float32(y)) for y in centres[rng.integers(6)] + rng.normal(0, 0.05, dims)] for _ in range(n)]


def test_tree_invariants_and_assignment():
    rng = np.random.default_rng(1)
    points = rng.integers(-60, 60, (4 * 700, 3))
    points[100:400] = points[5]  # one part position's hot point
    order, nodes = covertree.grow(points, 4)
    assert sorted(order.tolist()) == list(range(len(points)))
    x = points[order]
    for lo, hi, r2, first, kids in nodes:
        assert ((x[lo:hi] - x[lo]) ** 2).sum(1).max() == r2
        if kids:
            below = nodes[first:first + kids]
            assert below[0, 0] == lo and below[-1, 1] == hi and (below[1:, 0] == below[:-1, 1]).all()
            assert (4 * below[:, 2] <= r2).all()  # at most half the radius
            c = x[below[:, 0]]
            far = ((c[:, None] - c[None]) ** 2).sum(2)
            assert (4 * far[~np.eye(len(c), dtype=bool)] > r2).all()  # more than half apart
    books = rng.integers(-60, 60, (4, 20, 3))
    books[:, 7] = books[:, 3]  # a tie between entries
    runs, places, own = covertree.assign(x, nodes, 4, books)
    entry = np.full(len(x), -1)
    entry[places] = own
    for lo, hi, e in runs:
        assert (entry[lo:hi] == -1).all()
        entry[lo:hi] = e
    part = np.arange(len(x)) // 700
    exact = ((x[:, None] - books[part]) ** 2).sum(2).argmin(1)
    assert (entry == exact).all()
    assert len(places) < len(x)  # whole subtrees were assigned


def test_against_plain_rounds(spark):
    rows = [(i, v, i % 3 if i % 5 else None) for i, v in enumerate(cloud(260, 32, 2))]
    rows += [(500 + i, rows[9][1], 1) for i in range(90)]  # copies
    rows += [(3, rows[4][1], 0), (3, rows[6][1], None), (None, rows[8][1], 2)]  # repeated and null ids
    bad = [(900, None, 1), (901, [float("nan")] * 32, 1), (902, [None] + [0.0] * 31, 1), (903, [float("inf")] * 32, 1)]
    assert run(spark, rows + bad, block=64) == plain(rows)


def test_fewer_rows_than_entries(spark):
    rows = [(i, v, 1) for i, v in enumerate(cloud(5, 16, 4))]
    assert run(spark, rows) == plain(rows)


def test_all_rows_equal(spark):
    rows = [(i, [0.25] * 16, None) for i in range(150)]
    assert run(spark, rows) == plain(rows)


def test_zeros_and_negative_floors(spark):
    rows = [(i, [(-1) ** i * i / 1000.0] * 16, 0) for i in range(80)]
    assert run(spark, rows, entries=4) == plain(rows, entries=4)


def test_empty_table_and_other_lengths(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None, 1)]) == []
    rows = [(i, v, 1) for i, v in enumerate(cloud(9, 16, 5))]
    got = run(spark, rows + [(99, [1.0], 8)])
    assert [r for r in got if r[0] != 99] == plain(rows)
    assert [r[:4] for r in got if r[0] == 99] == [(99, None, None, None)]
    with pytest.raises(ValueError):
        run(spark, [(1, [1.0] * 17, 1)])


def test_components_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="component"):
        run(spark, [(1, [1e9] * 16, 1)])
