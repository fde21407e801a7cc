"""Resampling, splitting and set operators.

All random choices come from ``md5(seed:key)`` (see ``functions.hashing``):
the same seed gives the same rows for any partitioning, cluster size or task
retry. ``key`` must identify a row (pass several columns for a compound key).

Exact "first n rows by hash" selections are an order statistic: the n-th
smallest ``(hash, key)`` is found by a radix selection over
narrow passes (hash digits counted, 16^3 groups a pass, until few enough rows
share the prefix to be fetched), and the selection itself is a plain filter
against that one boundary: one wide scan, no join, no wide row shuffled.

Tables without a key can use the place of a row in its file
(:func:`with_row_identity`), which no repartitioning, retry or rerun changes.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import TWO_32, keep_bound, seeded_hash, seeded_u32
from .profile import class_sizes

KeyCols = str | Sequence[str]


def _key_list(key: KeyCols) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


#: Hash digits per counting pass, and rows that are fetched to pick the boundary.
_DIGITS, _FETCH = 3, 16_384


def with_row_identity(df: DataFrame, file_col: str = "_file", row_col: str = "_row") -> DataFrame:
    """Add the file of every row and its place in that file, a key for tables
    that have none. ``df`` must read Parquet files directly (the columns come
    from the scan); the same files give the same identity however they are
    split, repartitioned or read again."""
    return df.select("*", F.col("_metadata.file_path").alias(file_col), F.col("_metadata.row_index").alias(row_col))


def _rank(keys: list[str], seed: int | str) -> Column:
    """What rows are ranked by; the key orders rows whose hashes collide."""
    return F.struct(seeded_hash(seed, keys).alias("h"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)])


class Boundary(NamedTuple):
    """Rows below ``rank`` are in; of the ``there`` rows at it, ``take`` are, by
    ``row_hash`` where only some of them fit."""
    rank: tuple
    row_hash: int | None
    take: int
    there: int


def _step(counts: list, left: int) -> tuple | None:
    """The first of the sorted (value, count) that reaches ``left``, and what is left there."""
    for value, c in counts:
        if left <= c:
            return value, c, left
        left -= c
    return None


def _counts(df: DataFrame, by: Column) -> list:
    return sorted((r["p"], r["n"]) for r in df.groupBy(by.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())


def boundary(df: DataFrame, keys: list[str], seed: int | str, n: int) -> Boundary | None:
    """The n-th row in rank order (None beyond the table). Each pass reads the
    keys only and fetches at most 16^3 counts, the last one ``_FETCH`` rows; the
    other columns are read only of rows that repeat the boundary's key, if not
    all of these fit."""
    ranked = df.select(_rank(keys, seed).alias("k"))
    h = F.col("k.h")
    prefix, there, left = "", None, n
    while there is None or there > _FETCH and len(prefix) < 32:
        here = ranked.where(h.startswith(prefix)) if prefix else ranked
        hit = _step(_counts(here, F.substring(h, len(prefix) + 1, _DIGITS)), left)
        if hit is None:
            return None
        prefix, there, left = prefix + hit[0], hit[1], hit[2]
    rows = ranked.where(h.startswith(prefix)).groupBy("k").agg(F.count(F.lit(1)).alias("n")).collect()
    # Null keys come first, as in Spark's order.
    rows = sorted(((tuple(r["k"]), r["n"]) for r in rows), key=lambda x: [(v is not None, v) for v in x[0]])
    rank, there, left = _step(rows, left)
    if left == there:
        return Boundary(rank, None, left, there)
    # Only some of the rows that repeat this key: go on by a hash of the row.
    same = df.where(_rank(keys, seed) == _literal(df, keys, rank)).select(F.xxhash64(*df.columns).alias("r"))
    lo, hi = -(1 << 63), (1 << 63) - 1
    while lo < hi:
        step = (hi - lo) // 4096 + 1
        cell = F.floor((F.col("r").cast("decimal(20,0)") - F.lit(lo)) / F.lit(step)).cast("long")
        part, there, left = _step(_counts(same.where(F.col("r").between(lo, hi)), cell), left)
        lo, hi = lo + part * step, min(hi, lo + (part + 1) * step - 1)
    return Boundary(rank, lo, left, there)


def _literal(df: DataFrame, keys: list[str], rank: tuple) -> Column:
    return F.struct(F.lit(rank[0]).alias("h"), *[F.lit(v).cast(df.schema[c].dataType).alias(f"k{i}")
                                                for i, (c, v) in enumerate(zip(keys, rank[1:]))])


def _below(df: DataFrame, keys: list[str], seed: int | str, b: Boundary) -> tuple[Column, Column]:
    """(before the boundary, at it) as conditions."""
    mine, lit = _rank(keys, seed), _literal(df, keys, b.rank)
    if b.row_hash is None:
        return mine < lit, mine == lit
    r = F.xxhash64(*df.columns)
    return (mine < lit) | ((mine == lit) & (r < b.row_hash)), (mine == lit) & (r == b.row_hash)


def _number(n: int | DataFrame) -> int:
    return int(n.first()[0] or 0) if isinstance(n, DataFrame) else int(n)


def first_n(df: DataFrame, seed: int | str, key: KeyCols, n: int | DataFrame, among: Column | None = None) -> DataFrame:
    """The ``n`` rows of smallest rank (of those that meet ``among``; the others
    stay as well): a filter. Rows that equal the boundary row in every column
    are interchangeable; if only some of them fit, that many are taken."""
    keys = _key_list(key)
    pool = df if among is None else df.where(among)
    kept = F.lit(False) if among is None else ~F.coalesce(among, F.lit(False))
    n = _number(n)
    if n < 1:
        return df.where(kept)
    found = boundary(pool, keys, seed, n)
    if found is None:
        return df
    before, at = _below(df, keys, seed, found)
    if found.take == found.there:
        return df.where(kept | before | at)
    return df.where(kept | before).unionByName(pool.where(at).limit(found.take))


def flag_first_n(df: DataFrame, seed: int | str, key: KeyCols, n: int | DataFrame, out_col: str = "_first") -> DataFrame:
    """Add boolean ``out_col``: the row is among the ``n`` rows of smallest rank.
    One wide scan, a comparison with one boundary per row."""
    keys = _key_list(key)
    n = _number(n)
    found = boundary(df, keys, seed, n) if n >= 1 else None
    if found is None:
        return df.withColumn(out_col, F.lit(n >= 1))
    before, at = _below(df, keys, seed, found)
    if found.take == found.there:
        return df.withColumn(out_col, before | at)
    # Equal rows of which some are in: as many of each kind as counted.
    same = df.where(at).limit(1)
    split = same.select("*", F.explode(F.concat(F.array_repeat(F.lit(True), found.take),
                                                F.array_repeat(F.lit(False), found.there - found.take))).alias(out_col))
    return df.where(~at).withColumn(out_col, before).unionByName(split)


def duplicate_keys(df: DataFrame, key: KeyCols) -> DataFrame:
    """Keys that occur more than once, with their counts (pre-aggregated per
    key). Hash-keyed sampling treats equal keys as one draw, so keys should
    identify rows."""
    keys = _key_list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def undersample_bernoulli(df: DataFrame, label: str, key: KeyCols, seed: int = 13,
                          majority: int = 0, minority: int = 1) -> DataFrame:
    """Keep every minority row and each majority row with probability
    ``1 / floor(n_major / n_minor)`` (all of them when that ratio is 0, i.e.
    the minority is larger). Fails at run time on an empty minority class.

    One filter over one scan; the hash bound comes from one scalar subquery.
    """
    sizes = class_sizes(df, label, majority, minority)
    ratio = F.floor(F.col("n_major") / F.col("n_minor"))
    bound = sizes.select(
        F.when(F.col("n_minor") == 0, F.raise_error(F.lit("undersample: the minority class is empty")))
        .when(ratio >= 1, keep_bound(F.lit(1.0) / ratio))
        .otherwise(F.lit(TWO_32)).cast("long").alias("bound")).scalar()
    keep = seeded_u32(seed, _key_list(key)) < bound
    return df.where((F.col(label) == minority) | ((F.col(label) == majority) & keep))


def undersample_fraction(df: DataFrame, label: str, fraction: float, seed: int = 13,
                         majority: int = 0, minority: int = 1) -> DataFrame:
    """R1 with Spark's per-row Bernoulli sampler (``sampleBy``), repeatable only
    for the same partitioning. For files without a key,
    :func:`with_row_identity` and :func:`undersample_bernoulli` repeat always."""
    return df.sampleBy(label, {majority: min(1.0, float(fraction)), minority: 1.0}, seed)


def undersample_exact(df: DataFrame, label: str, key: KeyCols, seed: int = 13,
                      majority: int = 0, minority: int = 1) -> DataFrame:
    """R2: as many majority rows as there are minority rows (the ones with the
    smallest ``md5(seed:key)``), plus all minority rows: a filter of one scan."""
    both = df.where(F.col(label).isin(majority, minority))
    n_minor = both.select(F.count_if(F.col(label) == minority))
    return first_n(both, seed, key, n_minor, among=F.col(label) == majority)


def assign_split(df: DataFrame, key: KeyCols, weights: Sequence[float], seed: int = 13,
                 names: Sequence[str] | None = None, out_col: str = "split") -> DataFrame:
    """Label each row with a split drawn with the given (normalised)
    weights from its key hash."""
    total = float(sum(weights))
    if total <= 0 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative with a positive sum")
    names = list(names) if names else [str(i) for i in range(len(weights))]
    u = seeded_u32(seed, _key_list(key))
    acc, expr = 0.0, None
    for i, w in enumerate(weights):
        acc += w / total
        cond = u < (keep_bound(acc) if i < len(weights) - 1 else F.lit(TWO_32))
        expr = F.when(cond, F.lit(names[i])) if expr is None else expr.when(cond, F.lit(names[i]))
    return df.withColumn(out_col, expr)


def split_weighted(df: DataFrame, key: KeyCols, weights: Sequence[float] = (0.8, 0.2),
                   seed: int = 13) -> list[DataFrame]:
    """R4 as a list of frames, like ``randomSplit`` but partition-independent."""
    tagged = assign_split(df, key, weights, seed, out_col="_split")
    return [tagged.where(F.col("_split") == str(i)).drop("_split") for i in range(len(weights))]


def split_random(df: DataFrame, weights: Sequence[float] = (0.8, 0.2), seed: int = 13) -> list[DataFrame]:
    """R4 with Spark's own ``randomSplit`` (rows depend on the partitioning)."""
    return df.randomSplit(list(weights), seed)


def assign_split_exact(df: DataFrame, key: KeyCols, test_size: float = 0.2, seed: int = 42,
                       out_col: str = "split") -> DataFrame:
    """Exact-size split: the ``ceil(test_size * n)`` rows first in the
    hash order are ``test``, the rest ``train``."""
    n_test = df.agg(F.ceil(F.lit(float(test_size)) * F.count(F.lit(1))).cast("long"))
    flagged = flag_first_n(df, seed, key, n_test, "_test")
    return flagged.withColumn(out_col, F.when(F.col("_test"), "test").otherwise("train")).drop("_test")


def split_exact(df: DataFrame, key: KeyCols, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """R5 as ``(train, test)`` frames."""
    tagged = assign_split_exact(df, key, test_size, seed, out_col="_split")
    return (tagged.where(F.col("_split") == "train").drop("_split"),
            tagged.where(F.col("_split") == "test").drop("_split"))


def shuffle_rows(df: DataFrame, key: KeyCols, seed: int = 7, position_col: str = "position",
                 rows_per_block: int = 1_000_000) -> DataFrame:
    """Rows in a repeatable random order with their 1-based position.

    The hash range is cut into equal blocks of about ``rows_per_block`` rows (at
    least one per shuffle partition); block ``i`` is partition ``i``, sorted, so
    partitions follow each other in the order. A narrow pass counts the rows per
    block; a row's position is its place in the block plus the rows of the blocks
    before. The wide rows are shuffled once."""
    keys, spark = _key_list(key), df.sparkSession
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(df.count() / rows_per_block))
    block = F.floor(seeded_u32(seed, keys) * F.lit(float(blocks)) / F.lit(float(TWO_32))).cast("int")
    sizes = dict(df.select(block.alias("b")).groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets = [0, *itertools.accumulate(sizes.get(i, 0) for i in range(blocks))]
    before = spark.createDataFrame([(i, o) for i, o in enumerate(offsets[:-1])], "_b int, _before long")
    order = Window.partitionBy("_b").orderBy("_h", *keys, F.xxhash64(*df.columns))
    return (df.withColumn("_h", seeded_hash(seed, keys)).withColumn("_b", block)
            .join(F.broadcast(before), "_b")  # a row per block: rows / rows_per_block
            .repartitionById(blocks, "_b")
            .withColumn(position_col, F.row_number().over(order) + F.col("_before"))
            .select(*df.columns, position_col))


def union_classes(*frames: DataFrame) -> DataFrame:
    """Union keeping duplicates, matching columns by name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
