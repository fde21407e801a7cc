"""The two jobs of the source application as composable flows.

``train_job``: prepared CSV -> balance -> split -> drop incomplete rows ->
fit assembler + min-max + forest (class thresholds) -> save -> evaluation
frames (RMSE column, report, confusion matrix) as Spark aggregates.

``serve_job``: fitted pipeline + message stream (Kafka, or any frame with a
``value`` column) -> parse -> score -> ``key, value`` alerts -> sink.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import evaluate, prep
from ..schema import CYCLE_TIME, FEATURES, LABEL, PRODUCTION_THRESHOLDS, csv_schema, message_schema
from ..sources import files, kafka, model_store
from ..streaming.messages import alert_frame
from ..streaming.score import score_messages
from . import train


@dataclass
class TrainReport:
    model: PipelineModel
    predictions: DataFrame       # label, prediction, RMSE (constant column)
    report: DataFrame            # per-class precision / recall / f1 / support
    confusion: DataFrame         # actual, predicted, count


def train_job(spark: SparkSession, csv_path: str, model_path: str, key: str | Sequence[str],
              features: Sequence[str] = tuple(FEATURES), label: str = LABEL, exact: bool = False,
              seed: int = 13, thresholds: Sequence[float] = tuple(PRODUCTION_THRESHOLDS),
              infer: bool = False) -> TrainReport:
    """Batch training of the production model. ``exact=False`` balances by the
    Bernoulli ratio rule of the source job; ``exact=True`` takes exactly as
    many majority rows as minority rows. ``key`` identifies rows (the CSV's
    index column, for example) and drives the repeatable sampling. Columns are
    bound by their header names, in any order; ``infer`` takes their types from
    the data instead of the schema."""
    keys = [key] if isinstance(key, str) else list(key)
    schema = None if infer else csv_schema(list(features), label, index_col="_c0" if "_c0" in keys else None)
    df = files.read_csv(spark, csv_path, schema=schema, infer=infer, drop_index=None if "_c0" in keys else "_c0")
    balanced = train.prepare_balanced(df, label, keys, seed, exact=exact)
    res = train.train_and_score(balanced, list(features), label, keys, thresholds=thresholds)
    model_store.save_model(res.model, model_path)
    scored = res.scored.select(label, "prediction")
    with_rmse = prep.attach_metric(scored, "RMSE", evaluate.rmse(scored, label))
    return TrainReport(res.model, with_rmse, evaluate.classification_report(scored, label),
                       evaluate.confusion_matrix(scored, label))


def alerts(messages: DataFrame, model: PipelineModel, fields: Sequence[str] = tuple(FEATURES),
           label: str | None = LABEL, key_col: str = CYCLE_TIME, counters: str | None = None) -> DataFrame:
    """Messages (``value`` binary or text) -> ``key, value`` alert records.
    ``counters``: name of an observation of the messages that give no alert."""
    scored = score_messages(messages, model, message_schema(list(fields), label), label=label,
                            out_cols=(key_col, "prediction"), counters=counters)
    return alert_frame(scored, key_col, "prediction")


def serve_job(spark: SparkSession, model_path: str, bootstrap: str, in_topic: str, out_topic: str,
              checkpoint: str, trigger: str | None = None, console: bool = False,
              max_offsets_per_trigger: int | None = None,
              min_partitions: int | None = None, fail_on_data_loss: bool = False) -> StreamingQuery:
    """Load the model, read the input topic, write alerts to the output topic
    (or to the console), and return the running query. The two Kafka knobs
    bound a micro-batch and spread it over more tasks. As in the source
    application, lost offsets are skipped unless ``fail_on_data_loss``. The
    query's progress tells malformed and incomplete messages per batch
    (observation ``messages``; ``streaming.run.observed_counts`` sums them)."""
    model = model_store.load_model(model_path)
    stream = kafka.read_kafka(spark, bootstrap, in_topic, fail_on_data_loss=fail_on_data_loss,
                              max_offsets_per_trigger=max_offsets_per_trigger,
                              min_partitions=min_partitions)
    out = alerts(stream.select(F.col("value")), model, counters="messages")
    if console:
        return kafka.console_writer(out, trigger=trigger or "10 seconds").start()
    return kafka.kafka_writer(out, bootstrap, out_topic, checkpoint, trigger=trigger).start()
