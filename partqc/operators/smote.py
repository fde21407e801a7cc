"""SMOTE over-sampling (R3): neighbours from :mod:`.neighbours` (an exact tile
join, or a random-projection index if the caller asks for it).

New rows: for synthetic row ``i`` (0-based), base row = dense index
``u('<seed>:b:i') mod m`` in key order, neighbour rank
``1 + u('<seed>:k:i') mod k``, step ``u('<seed>:u:i') / 2^32``, and
``x_new = x_base + step * (x_neighbour - x_base)`` per coordinate, where
``u`` is the integer of the first 8 hex digits of the md5.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import TWO_32, seeded_hash, seeded_u32
from ..session import materialize
from .neighbours import BLOCK, neighbours
from .scan import positions


@dataclass
class SmoteResult:
    """Minority rows with their neighbours, ready to draw synthetic rows."""
    spark: object
    label: str
    key: str
    minority: DataFrame          # key, x
    majority: DataFrame          # key, x
    neighbours: DataFrame        # key, rank, neighbour, distance
    m: int
    n_new: int
    k: int
    seed: int
    minority_class: int
    majority_class: int

    def synthetic(self) -> DataFrame:
        """``new_id, base, neighbour, step, x`` for every synthetic row."""
        key = self.key
        idx = positions(self.minority, [key], name="idx", start=0)
        # About 2M synthetic rows per task, never fewer tasks than the cluster's parallelism.
        parts = max(self.spark.sparkContext.defaultParallelism, math.ceil(self.n_new / 2_000_000))
        draws = self.spark.range(0, self.n_new, 1, parts).select(
            F.col("id").alias("new_id"),
            # 60 bits of the hash: every base row can be drawn, and evenly, at any size.
            (F.conv(F.substring(seeded_hash(self.seed, [F.lit("b"), F.col("id").cast("string")]), 1, 15), 16, 10)
             .cast("long") % F.lit(self.m)).alias("idx"),
            (F.lit(1) + seeded_u32(self.seed, [F.lit("k"), F.col("id").cast("string")]) % F.lit(self.k)).alias("rank"),
            (seeded_u32(self.seed, [F.lit("u"), F.col("id").cast("string")]) / F.lit(float(TWO_32))).alias("step"))
        based = draws.join(idx.select(F.col(key).alias("base"), "idx", F.col("x").alias("xb")), "idx")
        nb = self.neighbours.select(F.col(key).alias("base"), "rank", "neighbour")
        paired = based.join(nb, ["base", "rank"])
        xn = self.minority.select(F.col(key).alias("neighbour"), F.col("x").alias("xn"))
        full = paired.join(xn, "neighbour")
        return full.select("new_id", "base", "neighbour", "step",
                           F.zip_with("xb", "xn", lambda a, b: a + F.col("step") * (b - a)).alias("x"))

    def resampled(self) -> DataFrame:
        """Original rows plus synthetic minority rows: ``key, y, x`` (key is
        null for synthetic rows)."""
        lab = self.label
        orig = (self.majority.select(self.key, F.lit(self.majority_class).alias(lab), "x")
                .unionByName(self.minority.select(self.key, F.lit(self.minority_class).alias(lab), "x")))
        syn = self.synthetic().select(F.lit(None).cast("long").alias(self.key),
                                      F.lit(self.minority_class).alias(lab), "x")
        return orig.unionByName(syn)


class Smote:
    """SMOTE with ``k`` neighbours and a seed. ``method`` is ``"exact"`` or
    ``"lsh"`` (see :mod:`.neighbours`; ``options`` are its parameters), ``block``
    bounds the rows per side of a tile."""

    def __init__(self, k: int = 5, seed: int = 2, block: int = BLOCK, method: str = "exact", **options):
        self.k, self.seed, self.block = k, seed, block
        self.method, self.options = method, options

    def prepare(self, df: DataFrame, label: str, key: str, feature_cols: Sequence[str] | str,
                minority_class: int = 1, majority_class: int = 0) -> SmoteResult:
        """Neighbours of the minority rows of ``df``; synthetic rows bring the
        minority up to the majority size. ``feature_cols`` lists numeric
        columns or names one array column."""
        if isinstance(feature_cols, str):
            x = F.col(feature_cols).cast("array<double>").alias("x")
        else:
            x = F.array(*[F.col(c).cast("double") for c in feature_cols]).alias("x")
        base = df.select(F.col(key).cast("long").alias(key), F.col(label), x)
        minority = materialize(base.where(F.col(label) == minority_class).select(key, "x"))
        majority = base.where(F.col(label) == majority_class).select(key, "x")
        sizes = base.agg(F.sum(F.when(F.col(label) == minority_class, 1).otherwise(0)).alias("m"),
                         F.sum(F.when(F.col(label) == majority_class, 1).otherwise(0)).alias("M")).first()
        m, big_m = int(sizes["m"] or 0), int(sizes["M"] or 0)
        bad = minority.where(F.col(key).isNull() | F.col("x").isNull()
                             | F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))).count()
        if bad:
            raise ValueError(f"SMOTE: {bad} minority rows have no key or a null, NaN or infinite feature; "
                             "drop or fill them first")
        if m == 0:
            raise ValueError("SMOTE: the minority class is empty")
        k = min(self.k, m - 1)
        if k < 1:
            raise ValueError("SMOTE: the minority class needs at least two rows")
        # Reliable checkpoint: cuts the lineage of the search, survives lost executors.
        nb = materialize(neighbours(minority, key, k, m, self.method, self.block, self.seed, **self.options))
        return SmoteResult(df.sparkSession, label, key, minority, majority, nb, m, max(0, big_m - m), k,
                           self.seed, minority_class, majority_class)

