"""Class and column profiles."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .quantiles import FAN, column_profile

# Task functions travel by value: workers need numpy and pyarrow, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per class, most frequent first (ties by class)."""
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.col(label)))


def class_sizes(df: DataFrame, label: str, majority: int = 0, minority: int = 1) -> DataFrame:
    """One-row frame ``n_major, n_minor`` from a single conditional aggregate
    (one scan instead of two filtered counts)."""
    return df.agg(
        F.sum(F.when(F.col(label) == majority, 1).otherwise(0)).cast("long").alias("n_major"),
        F.sum(F.when(F.col(label) == minority, 1).otherwise(0)).cast("long").alias("n_minor"))


def imbalance_ratio(df: DataFrame, label: str, majority: int = 0, minority: int = 1) -> DataFrame:
    """A2: ``n_major, n_minor, ratio = floor(n_major / n_minor)``; raises when
    the minority class is empty."""
    sizes = class_sizes(df, label, majority, minority)
    ratio = F.when(F.col("n_minor") == 0,
                   F.raise_error(F.lit("imbalance_ratio: the minority class is empty"))
                   ).otherwise(F.floor(F.col("n_major") / F.col("n_minor")))
    return sizes.select("n_major", "n_minor", ratio.cast("int").alias("ratio"))


def class_share(df: DataFrame, label: str) -> DataFrame:
    """A3: the table behind the class bar chart: count and share of all rows.
    The window runs over the per-class counts only (one row per class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return (counts.select(label, "count",
                          (F.col("count") / F.sum("count").over(Window.partitionBy())).alias("share"))
            .orderBy(F.desc("count"), F.col(label)))


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: per column: count, mean, sample std, min, exact interpolated
    quartiles, max (the numbers of a pandas ``describe``; nulls and NaN are
    left out). Returned long, one row per column; see :mod:`.quantiles`."""
    names = F.array(*[F.lit(c) for c in cols])
    at = lambda p: F.max(F.when(F.col("p") == p, F.col("q")))
    wide = (column_profile(df, cols, [0.25, 0.5, 0.75]).groupBy("ci", "n", "mean", "std", "lo", "hi")
            .agg(at(0.25).alias("q25"), at(0.5).alias("q50"), at(0.75).alias("q75")))
    return wide.select(F.element_at(names, F.col("ci") + 1).alias("column"), F.col("n").alias("count"), "mean", "std",
                       F.col("lo").alias("min"), "q25", "q50", "q75", F.col("hi").alias("max"))


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5: Pearson correlation of every pair of columns (label included if
    listed), long as ``col_a, col_b, r``; null where a column is constant.

    Rows with a null or NaN in any listed column are left out, whatever the
    number of columns (the source application drops them before correlating).
    One scan: every task adds its Arrow batches to a count, a mean vector and a
    d x d matrix of co-moments, merged with the shift of the means, so no large
    sums cancel; the tasks' matrices are merged in two steps of at most ``FAN``
    and (tasks / ``FAN``) matrices.
    """
    cols = list(cols)
    d = len(cols)
    whole = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    types = pa.schema([("slot", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())),
                       ("m", pa.list_(pa.float64()))])

    def merged(parts):
        n, mean, m = 0, np.zeros(d), np.zeros((d, d))
        for k, mu, c in parts:
            if k:
                delta = mu - mean
                m += c + np.outer(delta, delta) * (n * k / (n + k))
                mean = mean + delta * (k / (n + k))
                n += k
        return n, mean, m

    def row(slot, part):
        return pa.RecordBatch.from_pylist([{"slot": slot, "n": part[0], "mean": part[1].tolist(),
                                            "m": part[2].ravel().tolist()}], types)

    def scan(batches):
        from pyspark import TaskContext

        def parts():
            for batch in batches:
                x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
                x = x[~np.isnan(x).any(1)]  # nulls come as NaN
                if len(x):
                    mean = x.mean(0)
                    yield len(x), mean, (x - mean).T @ (x - mean)

        yield row(TaskContext.get().partitionId() // FAN, merged(parts()))

    def parts_of(table):
        for i in range(len(table)):
            r = table.slice(i, 1).to_pylist()[0]
            yield r["n"], np.array(r["mean"]), np.array(r["m"]).reshape(d, d)

    def step(table):
        return pa.Table.from_batches([row(0, merged(parts_of(table)))])

    def finish(table):
        n, _, m = merged(parts_of(table))
        scale = np.sqrt(np.diag(m))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = m / np.outer(scale, scale)
        r[scale == 0, :] = r[:, scale == 0] = np.nan
        np.fill_diagonal(r, np.where(scale > 0, 1.0, np.nan))
        i, j = np.divmod(np.arange(d * d), d)
        return pa.table({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)),
                         "r": pa.array([None if np.isnan(v) else float(v) for v in r.ravel()], pa.float64())})

    schema = "slot int, n long, mean array<double>, m array<double>"
    long = (whole.mapInArrow(scan, schema).groupBy("slot").applyInArrow(step, schema)
            .groupBy("slot").applyInArrow(finish, "i int, j int, r double"))
    names = F.array(*[F.lit(c) for c in cols])
    return long.select(F.element_at(names, F.col("i") + 1).alias("col_a"), F.element_at(names, F.col("j") + 1).alias("col_b"), "r")
