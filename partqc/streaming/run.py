"""Running streams (T2-T7) over a file source shaped like a Kafka topic.

A folder of parquet files with a ``value binary`` column stands in for the
topic (the Kafka connector needs a broker); the same transformation runs on
``sources.kafka.read_kafka`` unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

VALUE_SCHEMA = T.StructType([T.StructField("value", T.BinaryType(), True)])


def read_message_files(spark: SparkSession, path: str, max_files_per_trigger: int | None = 1,
                       schema: T.StructType = VALUE_SCHEMA) -> DataFrame:
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.parquet(path)


def write_stream(df: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet",
                 query_name: str | None = None, trigger: str | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start an append-mode query to a file sink with a checkpoint (T2, T5,
    T6); ``trigger`` is a processing-time interval such as ``"10 seconds"``
    (T3), ``None`` runs micro-batches back to back (T4)."""
    if not checkpoint:
        raise ValueError("a durable sink needs a checkpoint location")
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    if available_now:
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    return w.start(sink)


def run_until_done(query: StreamingQuery, timeout_s: float = 600.0) -> StreamingQuery:
    """Block until an ``availableNow`` query ends (with a timeout)."""
    finished = query.awaitTermination(timeout_s)
    if not finished:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not finish in {timeout_s}s")
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def observed_counts(query: StreamingQuery, name: str) -> dict[str, int]:
    """The counters of ``Dataset.observe(name, ...)`` summed over the batches of
    a query's recent progress (Spark keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates``, 100 by default)."""
    total: dict[str, int] = {}
    for p in query.recentProgress:
        seen = (p.get("observedMetrics") if isinstance(p, dict) else p.observedMetrics) or {}
        row = seen.get(name)
        if row is not None:
            for field, value in (row if isinstance(row, dict) else row.asDict()).items():
                total[field] = total.get(field, 0) + int(value or 0)
    return total


def run_file_stream(spark: SparkSession, source: str, transform: Callable[[DataFrame], DataFrame],
                    sink: str, checkpoint: str, max_files_per_trigger: int = 1,
                    timeout_s: float = 600.0, query_name: str | None = None) -> StreamingQuery:
    """Read message files as a stream, apply ``transform``, append to a
    parquet sink, process everything available and stop."""
    stream = transform(read_message_files(spark, source, max_files_per_trigger))
    q = write_stream(stream, sink, checkpoint, query_name=query_name, available_now=True)
    return run_until_done(q, timeout_s)
