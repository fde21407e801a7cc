"""Kafka source and sink (S3-S5) and the console sink.

The Kafka connector jar is not part of every Spark install; the readers and
writers here only build the Structured Streaming calls. The option maps are
pure functions so they can be checked without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

KAFKA_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]


def kafka_source_options(bootstrap: str, topic: str, starting_offsets: str = "earliest",
                         fail_on_data_loss: bool = True,
                         max_offsets_per_trigger: int | None = None,
                         min_partitions: int | None = None) -> dict[str, str]:
    """Options to subscribe to one topic. ``startingOffsets`` only acts on the
    first start; afterwards the checkpoint decides. Offsets that were aged out
    of the topic stop the query unless ``fail_on_data_loss`` is False, which
    skips them. ``maxOffsetsPerTrigger``
    bounds the size of one micro-batch (back-pressure); ``minPartitions``
    splits large topic partitions over more tasks per micro-batch."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    return opts


def read_kafka(spark: SparkSession, bootstrap: str, topic: str, **kw) -> DataFrame:
    """Streaming frame with Kafka's columns (key, value, topic, partition,
    offset, timestamp, timestampType)."""
    return spark.readStream.format("kafka").options(**kafka_source_options(bootstrap, topic, **kw)).load()


def kafka_sink_options(bootstrap: str, topic: str, checkpoint: str) -> dict[str, str]:
    if not checkpoint:
        raise ValueError("a Kafka sink needs a checkpoint location for restarts")
    return {"kafka.bootstrap.servers": bootstrap, "topic": topic, "checkpointLocation": checkpoint}


def _with_trigger(writer: DataStreamWriter, trigger: str | None, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer  # default: next micro-batch as soon as the previous ends


def kafka_writer(df: DataFrame, bootstrap: str, topic: str, checkpoint: str,
                 query_name: str | None = None, trigger: str | None = None,
                 available_now: bool = False) -> DataStreamWriter:
    """Writer of a ``key, value`` frame to a topic in append mode (at-least-once)."""
    w = (df.writeStream.format("kafka").outputMode("append")
         .options(**kafka_sink_options(bootstrap, topic, checkpoint)))
    if query_name:
        w = w.queryName(query_name)
    return _with_trigger(w, trigger, available_now)


def console_writer(df: DataFrame, trigger: str | None = "10 seconds", available_now: bool = False,
                   query_name: str | None = None, num_rows: int = 20) -> DataStreamWriter:
    """Console sink in append mode, for looking at a stream while developing."""
    w = df.writeStream.format("console").outputMode("append").option("numRows", num_rows)
    if query_name:
        w = w.queryName(query_name)
    return _with_trigger(w, trigger, available_now)


def start(writer: DataStreamWriter, timeout_s: float | None = None) -> StreamingQuery:
    """Start a query; with a timeout, block until it ends or the time is up."""
    q = writer.start()
    if timeout_s is not None:
        q.awaitTermination(timeout_s)
    return q
