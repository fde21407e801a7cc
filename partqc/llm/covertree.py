"""Product codes of vectors by Lloyd rounds over cover trees.

Vectors become integers (``floor(256 x)``) and are cut into equal parts; each
part position has a codebook.  A block of rows gets, once, a cover tree per part
position: a node's centre is its first point, its radius the largest distance to
a point below it; points within half the radius stay with the centre, the first
point left is the next child's centre, and so on (children are more than half the
radius apart, and a child's radius is at most half).  The tree orders the points
so that every subtree is a run, whose sum is a difference of cumulative sums.

A round walks down from the roots.  Entries nearest (distance d) and second (D)
to a centre with radius r: if ``d + r < D - r``, the triangle inequality gives
every point below the nearest entry, and count and sum come from the cumulative
sums without touching a point.  Only the other nodes are opened; points of
ambiguous leaves are compared exactly, in integers.

Trees are built where the rows lie (no shuffle), level by level over all part
positions at once, and kept as a table, so later rounds read them.  A round sends
one row per task, part and used entry; what reaches the driver is the codebooks,
parts x entries x part length numbers, whatever the table holds.  Memory per task
is one block of ``BLOCK`` rows.

Nulls and oddities: rows whose vector is null or holds null or non-finite
components go; components of up to 2**18 in size are exact, larger ones are an
error; the vector length is that of the row of the smallest id that is not
empty, and rows of other lengths stay with null code and error; rows with a null id are kept and give no
first entry before others; rows that repeat an id are rows each, ordered by
vector; fewer rows than entries give as many entries as rows; equal rows cost one
node; null labels are one label; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partqc.llm.common import materialize, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 4096
#: Nodes of so many points are not split.
LEAF = 8
#: Largest integer component.
MOST = 1 << 26
_FRONT = 4096


def grow(points: np.ndarray, parts: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """Cover trees of the part positions: ``points`` (parts * n, d), one position
    after the other.  Returns the order of the points and the nodes (lo, hi,
    squared radius, first child, number of children), roots first."""
    total = len(points)
    n = total // parts
    order = np.arange(total)
    nodes, first_id = [], parts
    lo = np.arange(parts) * n
    hi = lo + n
    while len(lo):
        size = hi - lo
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())  # places of the level's points
        own = np.repeat(np.arange(len(lo)), size)
        x = points[order[at]]
        d2 = ((x - x[(np.cumsum(size) - size)[own]]) ** 2).sum(1)
        r2 = np.maximum.reduceat(d2, np.cumsum(size) - size)
        split = (size > leaf) & (r2 > 0)
        child = np.where(4 * d2 <= r2[own], 0, -1)
        left = np.flatnonzero(split[own] & (child < 0))
        k = 0
        while len(left):
            k += 1
            o = own[left]
            new = np.flatnonzero(np.concatenate(([True], o[1:] != o[:-1])))
            centre = np.repeat(left[new], np.diff(np.concatenate((new, [len(left)]))))
            near = 4 * ((x[left] - x[centre]) ** 2).sum(1) <= r2[o]
            child[left[near]] = k
            left = left[~near]
        opened = np.flatnonzero(split[own])
        moved = opened[np.lexsort((child[opened], own[opened]))]  # stable: centres stay first
        order[at[opened]] = order[at[moved]]
        o, c = own[moved], child[moved]
        new = np.flatnonzero(np.concatenate(([True], (o[1:] != o[:-1]) | (c[1:] != c[:-1])))) if len(o) else np.zeros(0, int)
        kids = np.bincount(o[new], minlength=len(lo))
        nodes.append(np.stack((lo, hi, r2, first_id + np.cumsum(kids) - kids, kids), 1))
        first_id += len(new)
        where = at[opened]
        lo = where[new]
        hi = lo + np.diff(np.concatenate((new, [len(where)])))
    return order, np.concatenate(nodes).astype(np.int64)


def nearest(x: np.ndarray, part: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, squared distance, squared distance of the second entry) of every
    point of a part position; ties go to the lower index."""
    entry = np.empty(len(x), np.int64)
    best, second = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    for a in range(0, len(x), _FRONT):
        b = slice(a, a + _FRONT)
        d = np.zeros((len(x[b]), books.shape[1]), np.int64)
        for j in range(x.shape[1]):
            d += (x[b, j, None] - books[part[b], :, j]) ** 2
        rows = np.arange(len(d))
        entry[b] = e = d.argmin(1)
        best[b] = d[rows, e]
        d[rows, e] = np.iinfo(np.int64).max
        second[b] = d.min(1)
    return entry, best, second


def assign(points: np.ndarray, nodes: np.ndarray, parts: int, books: np.ndarray):
    """Runs (lo, hi, entry) of ordered points that share an entry, and places and
    entries of the points compared on their own."""
    n = len(points) // parts
    runs, places, entries = [], [], []
    front = np.arange(parts if n else 0)
    while len(front):
        lo, hi, r2, first, kids = nodes[front].T
        e, best, second = nearest(points[lo], lo // n, books)
        r = np.sqrt(r2.astype(float))
        whole = (np.sqrt(second.astype(float)) - np.sqrt(best.astype(float)) > 2 * r * (1 + 1e-9) + 1e-9) | (r2 == 0)
        runs.append(np.stack((lo[whole], hi[whole], e[whole]), 1))
        leaf = ~whole & (kids == 0)
        size = (hi - lo)[leaf]
        if len(size):
            at = np.repeat(lo[leaf] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            places.append(at)
            entries.append(nearest(points[at], at // n, books)[0])
        more = ~whole & (kids > 0)
        f, k = first[more], kids[more]
        front = np.repeat(f - (np.cumsum(k) - k), k) + np.arange(k.sum())
    empty = np.zeros(0, np.int64)
    return (np.concatenate(runs) if runs else np.zeros((0, 3), np.int64),
            np.concatenate(places) if places else empty, np.concatenate(entries) if entries else empty)


def _tree(row: dict, parts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.frombuffer(row["ordering"], np.int32)
    flat = np.frombuffer(row["vectors"], np.int32).astype(np.int64)
    n = len(order) // parts
    points = np.ascontiguousarray(flat.reshape(n, parts, -1).transpose(1, 0, 2)).reshape(n * parts, -1)
    return points[order], order, np.frombuffer(row["nodes"], np.int64).reshape(-1, 5)


def encode(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
           parts: int = 16, entries: int = 64, rounds: int = 2, block: int = BLOCK) -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256) of every kept row;
    ``error`` sums the squared distances to the entries, ``label_error`` that
    over equal labels."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: entries must be 1 to 256")
    spark = vectors.sparkSession
    kinds = {c: vectors.schema[c].dataType.simpleString() for c in (id_col, label_col)}
    vec = F.col("vec")
    v = (vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                        F.col(vec_col).cast("array<double>").alias("vec"))
         .filter(vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))))
    large = F.exists(vec, lambda x: (F.abs(x) < float("inf")) & (F.abs(x) * 256 >= MOST))
    v = v.withColumn("vec", F.when(~F.coalesce(large, F.lit(False)), vec).otherwise(
        F.raise_error(F.lit(f"a vector component is {MOST >> 8} or larger")).cast("array<double>")))
    least = [F.col("id").asc_nulls_last(), "vec"]
    start = v.filter(F.size("vec") > 0).select("id", "vec").orderBy(*least).limit(entries).collect()
    length = len(start[0]["vec"]) if start else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components have no {parts} equal parts")
    fits = v.filter((F.size("vec") == length) & (F.size("vec") > 0))
    if any(len(r["vec"]) != length for r in start):
        start = fits.select("id", "vec").orderBy(*least).limit(entries).collect()
    width = length // parts
    ints = np.floor(256 * np.array([r["vec"] for r in start], float)).astype(np.int64).reshape(len(start), parts, width)
    books = np.ascontiguousarray(ints.transpose(1, 0, 2))

    def plant(batches):
        for batch in batches:
            for at in range(0, len(batch), block):
                cut = batch.slice(at, block)
                x = cut.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(cut), parts, width)
                x = np.floor(256 * x).astype(np.int64)
                order, nodes = grow(np.ascontiguousarray(x.transpose(1, 0, 2)).reshape(-1, width), parts)
                one = np.array([0, len(cut)], np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(one, cut.column(0)), pa.ListArray.from_arrays(one, cut.column(1)),
                     pa.array([x.astype(np.int32).tobytes()]), pa.array([order.astype(np.int32).tobytes()]),
                     pa.array([nodes.tobytes()])], ["ids", "labels", "vectors", "ordering", "nodes"])

    def sums(batches):
        count = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                points, _, nodes = _tree(row, parts)
                n = len(points) // parts
                runs, places, own = assign(points, nodes, parts, books)
                cum = np.concatenate((np.zeros((1, width), np.int64), np.cumsum(points, 0)))
                at = (runs[:, 0] // n, runs[:, 2])
                np.add.at(count, at, runs[:, 1] - runs[:, 0])
                np.add.at(total, at, cum[runs[:, 1]] - cum[runs[:, 0]])
                np.add.at(count, (places // n, own), 1)
                np.add.at(total, (places // n, own), points[places])
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(e), pa.array(count[p, e]), *[pa.array(total[p, e, j]) for j in range(width)]],
            ["part", "entry", "n", *[f"s{j}" for j in range(width)]])

    def codes(batches):
        for batch in batches:
            for row in batch.to_pylist():
                points, order, nodes = _tree(row, parts)
                n = len(points) // parts
                runs, places, own = assign(points, nodes, parts, books)
                entry = np.empty(len(points), np.int64)
                entry[places] = own
                size = runs[:, 1] - runs[:, 0]
                entry[np.repeat(runs[:, 0] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(runs[:, 2], size)
                part = np.arange(len(points)) // n
                off = np.empty(len(points), np.int64)
                off[order] = ((points - books[part, entry]) ** 2).sum(1)
                code = np.empty(len(points), np.uint8)
                code[order] = entry
                text = np.ascontiguousarray(code.reshape(parts, n).T).tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], batch.schema.field("ids").type.value_type),
                     pa.array(row["labels"], batch.schema.field("labels").type.value_type),
                     pa.array([text[2 * parts * i:2 * parts * (i + 1)] for i in range(n)], pa.string()),
                     pa.array(off.reshape(parts, n).sum(0))], ["id", "label", "code", "error"])

    with scratch(spark) as tmp:
        trees = tmp.keep(fits.select("id", "label", "vec").mapInArrow(
            plant, f"ids array<{kinds[id_col]}>, labels array<{kinds[label_col]}>, vectors binary, ordering binary, "
            "nodes binary"))
        for _ in range(rounds if length else 0):
            got = (trees.select("ids", "labels", "vectors", "ordering", "nodes")
                   .mapInArrow(sums, "part long, entry long, n long" + "".join(f", s{j} long" for j in range(width)))
                   .groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ["n", *[f"s{j}" for j in range(width)]]]))
            books = books.copy()
            for r in got.collect():  # parts * entries rows at most
                books[r["part"], r["entry"]] = [r[f"s{j}"] // r["n"] for j in range(width)]
        rows = trees.mapInArrow(codes, f"id {kinds[id_col]}, label {kinds[label_col]}, code string, error long")
        rows = rows.union(v.filter((F.size("vec") != length) | (F.size("vec") == 0)).select(
            "id", "label", F.lit(None).cast("string"), F.lit(None).cast("long")))
        rows = materialize(rows)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    by = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    return rows.join(by, F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_col), "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
