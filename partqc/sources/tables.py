"""Loaders for the given parquet tables and the labelled views built on them.

Views (label column ``y``, 1 = the minority / "defect" class):

* EV  ``events``: key ``event_id``; y = ``event_type = 'error'``; features
  ``value``, ``user_id``, ``k`` (from ``props``).
* EM  ``embeddings``: key ``vec_id``; y = ``label = 5``; features e0..e63.
* LI  ``lineitem``: no unique key; y = ``l_returnflag = 'R'``; four numbers.
* LB  ``labels``: key ``doc_id``; y = ``quality = 0``.

Only the needed columns are selected, so the parquet scan reads just those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EV_FEATURES = ["value", "user_id", "k"]
EM_DIM = 64
EM_FEATURES = [f"e{i}" for i in range(EM_DIM)]
LI_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_view(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """EV. With ``dirty`` the table gets the invalid values it lacks: a null
    ``value`` on every tenth key and a NaN ``k`` on keys ending in 5 (all rows
    are kept; only values are blanked)."""
    ev = table(spark, sf_dir, "events")
    value = F.col("value")
    k = F.get_json_object("props", "$.k").cast("double")
    if dirty:
        value = F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("double")).otherwise(value)
        k = F.when(F.col("event_id") % 10 == 5, F.lit(float("nan"))).otherwise(k)
    return ev.select(
        "event_id",
        (F.col("event_type") == "error").cast("int").alias("y"),
        value.alias("value"),
        F.col("user_id").cast("double").alias("user_id"),
        k.alias("k"),
    )


def embeddings_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    em = table(spark, sf_dir, "embeddings")
    return em.select(
        "vec_id",
        (F.col("label") == 5).cast("int").alias("y"),
        *[F.col("embedding").getItem(i).cast("double").alias(f"e{i}") for i in range(EM_DIM)],
    )


def embeddings_array_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EM with the features as one ``x array<double>`` column."""
    em = table(spark, sf_dir, "embeddings")
    return em.select("vec_id", (F.col("label") == 5).cast("int").alias("y"),
                     F.col("embedding").cast("array<double>").alias("x"))


def lineitem_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        *LI_FEATURES,
    )


def labels_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    lb = table(spark, sf_dir, "labels")
    return lb.select("doc_id", (F.col("quality") == 0).cast("int").alias("y"), "quality", "toxic")
