"""Shared helpers: table access, lineage cuts, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from partqc.session import checkpoint_root, materialize

__all__ = ["Scratch", "components", "documents", "materialize", "scratch", "table", "tokens_of"]

#: A word, as an expression both Java and RE2 read alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def tokens_of(text: Column) -> Column:
    """Number of whitespace-delimited words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables written under ``spark.checkpoint.dir`` for the length of a step.

    ``keep`` writes a frame as Parquet, with the shuffle files of that write
    cleaned at its end, and reads it again: the lineage is cut, a lost executor
    costs a reread, and disk holds columns instead of serialised rows.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{checkpoint_root(spark)}/partqc-scratch/{uuid.uuid4().hex}"
        self.n = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path, schema = f"{self.root}/{self.n}", df.schema
        before = self.spark.conf.get(_CLEAN, "false")
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.parquet(path)
        finally:
            self.spark.conf.set(_CLEAN, before)
        return self.spark.read.schema(schema).parquet(path)

    def drop(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Scratch]:
    """A Scratch that is deleted on leaving the block; frames that outlive it
    must be materialised inside."""
    s = Scratch(spark)
    try:
        yield s
    finally:
        s.drop()


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                    F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v: long); the component
    is its smallest node.

    Alternating large-star and small-star rounds: every round is two
    aggregations and joins over the edge list, nothing is gathered on the
    driver, and a star of any size is done in one round.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = e
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        j = both.join(least, "u")
        if large:
            new = j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            new = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v")))
        return new.filter("u <> v").distinct()

    e = edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
    with scratch(edges.sparkSession) as tmp:
        e = tmp.keep(e.filter("u <> v").distinct())
        seen = _fingerprint(e)
        while seen[0]:
            e = tmp.keep(star(star(e, True), False))
            now = _fingerprint(e)
            if now == seen:
                break
            seen = now
        e = materialize(e)
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
