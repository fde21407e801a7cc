"""Exact nearest neighbours by a block matrix join over int8 tiles.

Vectors are dealt into blocks by a hash of their id; a task multiplies one block
of queries with one block of candidates.  Each vector x is stored as a scale and
int8 codes, x = s a + r with the residual's norm kept, so that of the tile
product

    |q . c - s_q s_c (a_q . a_c)|  <=  |q| |r_c| + |r_q| |s_c a_c|

bounds every entry.  Only pairs whose upper bound reaches the query's k-th best
lower bound are computed again, in double precision on the original vectors, and
merged into the query's heap; nothing else leaves the tile.  The k best of every
tile are then merged per query.

Memory per task is one pair of blocks, whatever the table holds (at a vector
length L, 8 L bytes a row and ``block_bytes`` a block); the work is the
stated one of all queries against all rows.  The integer products are formed by
the float32 matrix product, which is exact below 2**24 (1,040 dimensions at a
time; more are added up in double precision).

Nulls and oddities: vectors that are null, empty, zero or hold null or
non-finite components, and rows with a null id, take no part; vectors are
compared with those of their own length only; rows that share the query's id are
its own and no candidates; rows that repeat an id are candidates each; equal
scores rank by smaller id; other columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 4 << 20
QUERY_ROWS, CANDIDATE_ROWS = 256, 4096
EXACT_DIMS = 1040


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(scale, codes, norm, norm of the residual, norm of the coded vector) of
    every row."""
    scale = np.abs(x).max(1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(x / scale[:, None])
    coded = codes * scale[:, None]
    norm = lambda v: np.sqrt((v * v).sum(1))
    return scale, codes.astype(np.int8), norm(x), norm(x - coded), norm(coded)


def dot(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, added dimension by dimension."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * c[:, j]
    return out


def tile(qid: np.ndarray, q: np.ndarray, cid: np.ndarray, c: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
    """Heaps of the k best (score, -candidate id) of every query within the block."""
    sc, ac, _, rc, mc = quantise(c)
    sq, aq, nq, rq, _ = quantise(q)
    ac, aq = ac.astype(np.float32), aq.astype(np.float32)
    heaps: list[list[tuple[float, int]]] = [[] for _ in q]
    for i0 in range(0, len(q), QUERY_ROWS):
        i1 = min(len(q), i0 + QUERY_ROWS)
        for j0 in range(0, len(c), CANDIDATE_ROWS):
            j1 = min(len(c), j0 + CANDIDATE_ROWS)
            product = np.zeros((i1 - i0, j1 - j0))
            for d in range(0, q.shape[1], EXACT_DIMS):
                product += aq[i0:i1, d:d + EXACT_DIMS] @ ac[j0:j1, d:d + EXACT_DIMS].T
            product *= sq[i0:i1, None] * sc[None, j0:j1]
            error = ((nq[i0:i1, None] * rc[None, j0:j1] + rq[i0:i1, None] * mc[None, j0:j1]) * (1 + 1e-9)
                     + 1e-12 * (1 + np.abs(product)))
            alien = qid[i0:i1, None] != cid[None, j0:j1]
            border = np.array([h[0][0] if len(h) == k else -np.inf for h in heaps[i0:i1]])
            if j1 - j0 > k:
                lower = np.where(alien, product - error, -np.inf)
                border = np.maximum(border, np.partition(lower, j1 - j0 - k, axis=1)[:, j1 - j0 - k])
            qi, ci = np.nonzero(alien & (product + error >= border[:, None]))
            score = dot(q[i0 + qi], c[j0 + ci])
            order = np.lexsort((cid[j0 + ci], -score, qi))
            first = np.searchsorted(qi[order], np.arange(i1 - i0 + 1))
            for i, heap in enumerate(heaps[i0:i1]):
                for j in order[first[i]:first[i + 1]][:k].tolist():
                    pair = (float(score[j]), -int(cid[j0 + ci[j]]))
                    if len(heap) < k:
                        heapq.heappush(heap, pair)
                    elif pair <= heapq.heappushpop(heap, pair):
                        break  # the rest of this block is no better
    return heaps


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    ids = table.column("id").to_numpy()
    flat = table.column("vec").combine_chunks()
    return ids, flat.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(query_id, rank, id_col, score): every query's ``k`` rows of largest inner
    product, in order.  ``is_query`` is a condition on the input's columns."""
    vec = F.col("vec")
    usable = (F.col("id").isNotNull() & vec.isNotNull() & (F.size(vec) > 0)
              & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists(vec, lambda x: x != 0))
    v = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("vec"),
                        F.coalesce(is_query, F.lit(False)).alias("query"))
         .filter(usable).withColumn("size", F.size("vec")))
    # Blocks of about block_bytes, their number from the rows of each vector length.
    rows = F.greatest(F.floor(F.lit(block_bytes) / (F.col("size") * 8)), F.lit(1))
    blocks = v.groupBy("size").agg(F.count("*").alias("n"), F.count_if("query").alias("m")).select(
        "size", F.ceil(F.col("n") / rows).alias("nc"), F.greatest(F.ceil(F.col("m") / rows), F.lit(1)).alias("nq"))
    dealt = v.join(blocks, "size").withColumn("h", F.xxhash64("id"))

    c = (dealt.withColumn("cb", F.pmod("h", "nc"))
         .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nq") - 1))))
    q = (dealt.filter("query").withColumn("qb", F.pmod("h", "nq"))
         .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nc") - 1))))
    key = ["size", "qb", "cb"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        qid, cand, score = [], [], []
        if len(left) and len(right):
            ids, x = _matrix(left)
            for i, heap in zip(ids.tolist(), tile(ids, x, *_matrix(right), k)):
                for s, m in heap:
                    qid.append(i)
                    cand.append(-m)
                    score.append(s)
        return pa.table([pa.array(qid, pa.int64()), pa.array(cand, pa.int64()), pa.array(score, pa.float64())],
                        names=["query_id", "cand", "score"])

    cols = [*key, "id", "vec"]
    found = (q.select(cols).toDF(*cols).groupBy(*key).cogroup(c.select(cols).toDF(*cols).groupBy(*key))
             .applyInArrow(run, "query_id long, cand long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "cand")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("cand").alias(id_col), "score"))
