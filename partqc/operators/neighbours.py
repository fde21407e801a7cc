"""k nearest neighbours of every row among all rows (euclidean, ties by key,
the row itself excluded): an exact tile join and a random-projection index.

Copies first: rows of equal vectors become one vector with its ``k + 1``
smallest keys (no other key of the group can be among anyone's k nearest), so a
group of copies of any size costs one row in the search. Every vector looks for
its ``k + 1`` nearest keys, its own included; a row's list is its vector's
without the row itself.

*Exact.* Vectors are range-partitioned by their distance to the mean; a
partition of about ``block`` vectors is a block, with its range of norms. A
block is first joined with itself, which gives every vector a bound ``d`` (its
(k+1)-th distance so far). A vector of norm ``r`` then visits the blocks whose
norm range meets ``[r - d, r + d]``; since blocks follow the norm, that is an
interval. Tiles (block of queries, block of candidates) are one matrix product
each: ``|q|^2 + |c|^2 - 2 q.c`` with a rounding bound selects the pairs that may
be among the best, and only these are computed coordinate by coordinate. At
worst (norms that tell nothing apart) every row is copied once per block, and
the work is quadratic over the block size; memory per task is one tile.

*Index.* ``tables`` hash tables, each of ``projections`` random directions cut
into steps of ``width`` times the median (k+1)-th distance, which is measured
exactly on ``calibration`` vectors. Vectors that share a bucket are compared: many
small buckets in one group of about ``block`` rows, a large bucket block by block
(no cap on a bucket or a candidate list). Vectors
that find fewer than ``k + 1`` keys are searched exactly. The result is
approximate: distances are true, some nearer rows may be missing;
:func:`recall` measures it. The caller chooses it; no size switches to it.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import seeded_hash
from ..session import materialize

# Task functions travel by value: workers need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4096
_STRIP = 256
#: Buckets up to this many rows are compared pair by pair; pairs at once.
_PAIRWISE, _PAIRS = 128, 1 << 20
_FOUND = "vid long, neighbour long, distance double"


def _distances(Q: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Row-wise euclidean distances, added coordinate by coordinate in order."""
    acc = np.zeros(len(Q))
    for j in range(Q.shape[1]):
        diff = Q[:, j] - C[:, j]
        acc += diff * diff
    return np.sqrt(acc)


def best_of_tile(Q: np.ndarray, bound: np.ndarray, C: np.ndarray, first: np.ndarray, n: int):
    """(query, candidate, distance) of the ``n`` best candidates of every query,
    by (distance, ``first``), none beyond the query's bound."""
    out = []
    if not len(Q) or not len(C):
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    centre = C.mean(0)
    Cc = C - centre
    c2 = (Cc * Cc).sum(1)
    for s in range(0, len(Q), _STRIP):
        q = Q[s:s + _STRIP]
        Qc = q - centre
        q2 = (Qc * Qc).sum(1)
        d2 = q2[:, None] + c2[None, :] - 2 * (Qc @ Cc.T)
        error = 1e-12 * (q2[:, None] + c2[None, :])
        border = bound[s:s + _STRIP] ** 2 * (1 + 1e-12)
        if len(C) > n:
            border = np.minimum(border, np.partition(d2 + error, n - 1, axis=1)[:, n - 1])
        qi, ci = np.nonzero(d2 - error <= border[:, None])
        d = _distances(q[qi], C[ci])
        order = np.lexsort((first[ci], d, qi))
        qi, ci, d = qi[order], ci[order], d[order]
        rank = np.arange(len(qi)) - np.searchsorted(qi, qi)
        ok = rank < n
        out.append((qi[ok] + s, ci[ok], d[ok]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _matrix(table: pa.Table, name: str = "x") -> np.ndarray:
    flat = table.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(table), -1)


def _found(vid: np.ndarray, qi: np.ndarray, ci: np.ndarray, d: np.ndarray, keys: pa.Array, n: int) -> pa.Table:
    """The ``n`` nearest keys of every query, from its best candidates and all their kept keys."""
    off, flat = keys.offsets.to_numpy(), keys.values.to_numpy(zero_copy_only=False)
    size = np.diff(off)[ci]
    at = np.repeat(off[:-1][ci] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    qi, key, d = np.repeat(qi, size), flat[at], np.repeat(d, size)
    order = np.lexsort((key, d, qi))
    qi, key, d = qi[order], key[order], d[order]
    ok = np.arange(len(qi)) - np.searchsorted(qi, qi) < n
    return pa.table({"vid": pa.array(vid[qi[ok]], pa.int64()), "neighbour": pa.array(key[ok], pa.int64()),
                     "distance": pa.array(d[ok], pa.float64())})


def _first(keys: pa.Array) -> np.ndarray:
    return keys.values.to_numpy(zero_copy_only=False)[keys.offsets.to_numpy()[:-1]]


def _tile(n: int):
    """Cogroup body: queries (vid, x, bound) against candidates (x, keys)."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            none = np.zeros(0, int)
            return _found(none, none, none, np.zeros(0), pa.array([], pa.list_(pa.int64())), n)
        keys = right.column("keys").combine_chunks()
        qi, ci, d = best_of_tile(_matrix(left), left.column("bound").to_numpy(), _matrix(right), _first(keys), n)
        return _found(left.column("vid").to_numpy(), qi, ci, d, keys, n)
    return run


def _bundle(n: int):
    """Group body: many buckets (t, h) of at most a block each; every vector against all of its
    bucket. Small buckets are compared pair by pair together, the others one by one."""
    def run(table: pa.Table) -> pa.Table:
        t, h = table.column("t").to_numpy(), table.column("h").to_numpy()
        order = np.lexsort((h, t))
        table, t, h = table.take(pa.array(order)), t[order], h[order]
        X, keys = _matrix(table), table.column("keys").combine_chunks()
        first = _first(keys)
        start = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (h[1:] != h[:-1])])
        size = np.diff(np.r_[start, len(t)])
        out = []
        small = size <= _PAIRWISE
        row = np.flatnonzero(np.repeat(small, size))
        begin, many = np.repeat(start, size)[row], np.repeat(size, size)[row]
        step = max(1, _PAIRS // _PAIRWISE)
        for i in range(0, len(row), step):
            r, b, m = row[i:i + step], begin[i:i + step], many[i:i + step]
            qi = np.repeat(r, m)
            ci = np.repeat(b - (np.cumsum(m) - m), m) + np.arange(m.sum())
            d = _distances(X[qi], X[ci])
            o = np.lexsort((first[ci], d, qi))
            qi, ci, d = qi[o], ci[o], d[o]
            ok = np.arange(len(qi)) - np.searchsorted(qi, qi) < n
            out.append((qi[ok], ci[ok], d[ok]))
        for a, m in zip(start[~small], size[~small]):
            qi, ci, d = best_of_tile(X[a:a + m], np.full(m, np.inf), X[a:a + m], first[a:a + m], n)
            out.append((qi + a, ci + a, d))
        qi, ci, d = (np.concatenate(v) for v in zip(*out))
        # A vector is in the bundle once per table that puts it there: rows, not vectors, are the queries.
        return _found(table.column("vid").to_numpy(), qi, ci, d, keys, n)
    return run


def _join(queries: DataFrame, candidates: DataFrame, by: list[str], n: int) -> DataFrame:
    q, c = [*by, "vid", "x", "bound"], [*by, "x", "keys"]
    # toDF: fresh columns, as both sides may come from one frame
    return (queries.select(q).toDF(*q).groupBy(*by).cogroup(candidates.select(c).toDF(*c).groupBy(*by))
            .applyInArrow(_tile(n), _FOUND))


def _least(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` best per vector: at most ``n`` rows per tile of a vector meet in its window."""
    w = Window.partitionBy("vid").orderBy("distance", "neighbour")
    return found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n).drop("_r")


def distinct_vectors(rows: DataFrame, key: str, k: int, m: int) -> tuple[DataFrame, DataFrame | None]:
    """``vid, x, keys`` per distinct vector (its smallest key, the k + 1 smallest
    keys) and ``key, vid`` of every row (None if no vectors are equal)."""
    groups = materialize(rows.groupBy("x").agg(F.min(key).alias("vid"), F.count(F.lit(1)).alias("n")))
    if groups.count() == m:
        return groups.select("vid", "x", F.array("vid").alias("keys")), None
    tagged = materialize(rows.join(groups, "x").select(F.col(key).alias("key"), "vid", "n"))
    copies = tagged.where("n > 1")
    # Two steps, so that no task sorts the keys of a large group.
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / BLOCK))
    few = (copies.withColumn("_p", part)
           .withColumn("_r", F.row_number().over(Window.partitionBy("vid", "_p").orderBy("key")))
           .where(F.col("_r") <= k + 1)
           .withColumn("_r", F.row_number().over(Window.partitionBy("vid").orderBy("key")))
           .where(F.col("_r") <= k + 1))
    keys = few.groupBy("vid").agg(F.array_sort(F.collect_list("key")).alias("keys"))  # k + 1 keys at most
    vectors = groups.join(keys, "vid", "left").select("vid", "x", F.coalesce("keys", F.array("vid")).alias("keys"))
    return vectors, tagged.select("key", "vid")


def _blocks(vectors: DataFrame, n_vectors: int, block: int) -> tuple[DataFrame, list]:
    """``vectors`` in blocks (``blk``) by their distance to the mean (``r``), and
    (blk, lo, hi) of the blocks, which go to the tasks: vectors / block rows."""
    dims = vectors.select(F.size("x").alias("d")).first()["d"]
    mean = vectors.agg(*[F.avg(F.col("x")[j]).alias(f"m{j}") for j in range(dims)]).first()
    centre = F.array(*[F.lit(float(v)) for v in mean])
    r = F.sqrt(F.aggregate(F.zip_with("x", centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b))
    parts = max(1, math.ceil(n_vectors / block))
    dealt = vectors.withColumn("r", r)
    if parts > 1:
        dealt = dealt.repartitionByRange(parts, "r", "vid")
        dealt = dealt.withColumn("blk", F.spark_partition_id())
    else:
        dealt = dealt.withColumn("blk", F.lit(0))
    dealt = materialize(dealt)
    ranges = dealt.groupBy("blk").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).orderBy("blk").collect()
    return dealt, ranges


def _exact(dealt: DataFrame, ranges: list, n: int, queries: DataFrame | None = None) -> DataFrame:
    """``vid, neighbour, distance``: the ``n`` nearest keys of every vector (or
    of the ``vid`` in ``queries``)."""
    asking = dealt if queries is None else dealt.join(queries.select("vid"), "vid", "left_semi")
    own = materialize(_least(_join(
        asking.withColumn("bound", F.lit(float("inf"))).withColumn("a", F.col("blk")),
        dealt.withColumn("a", F.col("blk")), ["blk", "a"], n), n))
    if len(ranges) <= 1:
        return own
    blocks = np.array([r["blk"] for r in ranges], np.int32)
    lows, highs = np.array([r["lo"] for r in ranges]), np.array([r["hi"] for r in ranges])

    def reach(batches):
        for b in batches:
            r, d = b.column(2).to_numpy(), b.column(3).to_numpy()
            slack = 1e-9 * (1 + r + np.where(np.isfinite(d), d, 0))
            lo = np.searchsorted(highs, r - d - slack)
            hi = np.searchsorted(lows, r + d + slack, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(3), pa.array(blocks[lo]), pa.array(blocks[hi])],
                ["vid", "blk", "bound", "lo", "hi"])

    bound = own.groupBy("vid").agg(F.when(F.count(F.lit(1)) >= n, F.max("distance")).otherwise(float("inf")).alias("bound"))
    visits = materialize(asking.select("vid", "blk", "r").join(bound, "vid").select("vid", "blk", "r", "bound")
                         .mapInArrow(reach, "vid long, blk int, bound double, lo int, hi int"))
    other = F.explode(F.sequence("lo", "hi")).alias("blk")
    pairs = (visits.groupBy(F.col("blk").alias("a")).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
             .select("a", other).where("a <> blk"))
    asked = (dealt.select("vid", "x").join(visits, "vid").select("vid", "x", "bound", F.col("blk").alias("a"), other)
             .where("a <> blk"))
    more = _join(asked, dealt.join(pairs, "blk"), ["blk", "a"], n)
    return _least(own.unionByName(more), n)


def _bucketed(dealt: DataFrame, n: int, step: float, tables: int, projections: int, seed: int, block: int) -> DataFrame:
    dims = dealt.select(F.size("x").alias("d")).first()["d"]
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(dims, tables * projections))
    shift = rng.random(tables * projections)
    mix = rng.integers(1, 2 ** 62, tables * projections) * 2 + 1

    def hashed(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
            cell = np.floor(x @ directions / step + shift).astype(np.int64)
            with np.errstate(over="ignore"):
                h = (cell * mix).reshape(len(b), tables, projections)
                h = (h ^ (h >> 29)).sum(2)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(np.arange(len(b) + 1, dtype=np.int32) * tables, h.ravel())],
                ["vid", "hash"])

    cells = materialize(dealt.select("vid", "x").mapInArrow(hashed, "vid long, hash array<long>")
                        .select("vid", F.posexplode("hash").alias("t", "h")))
    sizes = cells.groupBy("t", "h").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("parts"),
                                        F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = (cells.join(sizes, ["t", "h"]).withColumn("p", F.pmod(F.xxhash64("vid"), "parts").cast("int"))
              .join(dealt.select("vid", "x", "keys"), "vid"))
    # Buckets within a block are dealt out in bundles of about a block: a group costs more than
    # its few rows, and the number of buckets grows with the rows.
    met = sizes.agg(F.sum("n").alias("n"), F.max("parts").alias("parts")).first()
    bundles = max(1, math.ceil((met["n"] or 0) / block))
    tasks = min(bundles, max(4 * dealt.sparkSession.sparkContext.defaultParallelism, math.ceil(bundles / 16)))
    found = (placed.where("parts = 1").select(F.pmod(F.xxhash64("t", "h"), F.lit(bundles)).alias("g"), "t", "h", "vid", "x", "keys")
             .repartition(tasks, "g").groupBy("g").applyInArrow(_bundle(n), _FOUND))
    if (met["parts"] or 0) > 1:
        every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        wide = placed.where("parts > 1")
        queries = wide.withColumn("q", F.col("p")).withColumn("c", every).withColumn("bound", F.lit(float("inf")))
        candidates = wide.withColumn("c", F.col("p")).withColumn("q", every)
        found = found.unionByName(_join(queries, candidates, ["t", "h", "q", "c"], n))
    return found.distinct()  # a neighbour met in several tables


def neighbours(rows: DataFrame, key: str, k: int, m: int, method: str = "exact", block: int = BLOCK, seed: int = 2,
               tables: int = 12, projections: int = 4, width: float = 4.0, calibration: int = 256) -> DataFrame:
    """``key, rank, neighbour, distance`` of every row of ``rows`` (key, x:
    array<double>; m rows). ``method`` is ``"exact"`` or ``"lsh"``."""
    if method not in ("exact", "lsh"):
        raise ValueError("method must be 'exact' or 'lsh'")
    k = min(k, max(0, m - 1))
    n = k + 1
    vectors, members = distinct_vectors(rows.select(key, "x"), key, k, m)
    count = vectors.count()
    dealt, ranges = _blocks(vectors, count, block)
    if method == "exact":
        best = _exact(dealt, ranges, n)
    else:
        sample = materialize(dealt.select("vid").orderBy(seeded_hash(f"{seed}:lsh", "vid"), "vid").limit(calibration))
        kth = _exact(dealt, ranges, n, sample).groupBy("vid").agg(F.max("distance").alias("d"))
        median = kth.agg(F.percentile("d", 0.5)).first()[0]  # of `calibration` rows
        step = width * median if median else 1.0
        found = materialize(_least(_bucketed(dealt, n, step, tables, projections, seed, block), n))
        short = (dealt.select("vid").join(found.groupBy("vid").agg(F.count(F.lit(1)).alias("n")), "vid", "left")
                 .where(F.coalesce("n", F.lit(0)) < n).select("vid"))
        short = materialize(short)
        best = found if short.isEmpty() else found.join(short, "vid", "left_anti").unionByName(
            _exact(dealt, ranges, n, short))
    lists = best.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbour"))).alias("l"))  # n each
    if members is None:
        members = dealt.select(F.col("vid").alias("key"), "vid")
    mine = F.slice(F.filter("l", lambda s: s["neighbour"] != F.col("key")), 1, k) if k else F.slice("l", 1, 0)
    return (members.join(lists, "vid").select("key", F.posexplode(mine).alias("rank", "s"))
            .select(F.col("key").alias(key), (F.col("rank") + 1).alias("rank"), F.col("s.neighbour").alias("neighbour"),
                    F.col("s.distance").alias("distance")))


def recall(approximate: DataFrame, exact: DataFrame, key: str) -> float:
    """Share of the exact neighbours' distances that the approximate lists reach
    (rank by rank, so that ties count as found)."""
    a = approximate.select(key, "rank", F.col("distance").alias("da"))
    both = exact.select(key, "rank", "distance").join(a, [key, "rank"], "left")
    worst = exact.groupBy(key).agg(F.max("distance").alias("far"))
    hit = (F.col("da") <= F.col("far") * (1 + 1e-12)).cast("int")
    return both.join(worst, key).agg(F.avg(F.coalesce(hit, F.lit(0)))).first()[0]
