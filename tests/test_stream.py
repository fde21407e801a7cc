"""Streams: malformed messages, batch = stream, restart adds nothing, sinks."""

import json
import random

import pytest

from partqc.operators import models
from partqc.schema import FEATURES, message_schema
from partqc.session import scratch_path
from partqc.sources import kafka
from partqc.streaming import messages as msg
from partqc.streaming import run as srun
from partqc.streaming.score import score_clean, score_messages


def _messages(n_groups=75, seed=5):
    """Of every 8 messages: 3 good, one with a null, one with "NaN", one with
    a missing field, one with a quoted number, one cut in half; plus junk,
    empty, null, [] and {}."""
    rng = random.Random(seed)
    out = []
    for g in range(n_groups):
        for j in range(8):
            rec = {"reason": float(rng.random() < 0.3)}
            rec.update({f: round(rng.uniform(0, 100), 3) for f in FEATURES})
            f = FEATURES[rng.randrange(len(FEATURES))]
            text = None
            if j == 3:
                rec[f] = None
            elif j == 4:
                rec[f] = "NaN"
            elif j == 5:
                del rec[f]
            elif j == 6:
                rec[f] = str(rec[f])
            text = json.dumps(rec)
            if j == 7:
                text = text[: len(text) // 2]
            out.append(text)
    return out + ["junk", "", None, "[]", "{}"]


@pytest.fixture(scope="module")
def stream_setup(spark):
    texts = _messages()
    df = spark.createDataFrame([(t.encode() if t is not None else None,) for t in texts], "value binary")
    parsed = msg.parse_flatten(df, message_schema())
    good = parsed.na.drop()
    model = models.fit(models.production_pipeline(FEATURES, "reason", seed=3), good)
    src = scratch_path(spark, "test_stream_src")
    df.repartition(6).write.mode("overwrite").parquet(src)
    return df, model, src


def test_malformed_messages_are_dropped(spark, stream_setup):
    df, model, _ = stream_setup
    assert df.count() == 605
    scored = score_messages(df, model, message_schema())
    assert scored.count() == 225


def test_clean_path_equals_plain_transform(spark, stream_setup):
    df, model, _ = stream_setup
    flat = msg.parse_flatten(df, message_schema()).drop("reason")
    a = score_clean(flat, model).select("timCycle", "prediction")
    b = model.transform(flat).select("timCycle", "prediction")
    assert sorted(a.collect()) == sorted(b.collect())


def test_stream_equals_batch_and_restart_adds_nothing(spark, stream_setup):
    df, model, src = stream_setup
    sink, ckpt = scratch_path(spark, "test_stream_out"), scratch_path(spark, "test_stream_ckpt")
    fn = lambda d: score_messages(d, model, message_schema())
    srun.run_file_stream(spark, src, fn, sink, ckpt, max_files_per_trigger=1, timeout_s=300)
    first = spark.read.parquet(sink)
    batch = score_messages(spark.read.parquet(src), model, message_schema())
    assert sorted(first.collect()) == sorted(batch.collect())
    srun.run_file_stream(spark, src, fn, sink, ckpt, max_files_per_trigger=1, timeout_s=300)
    assert spark.read.parquet(sink).count() == 225


def test_alert_frame_on_stream(spark, stream_setup):
    _, model, src = stream_setup
    sink, ckpt = scratch_path(spark, "test_alert_out"), scratch_path(spark, "test_alert_ckpt")
    fn = lambda d: msg.alert_frame(score_messages(d, model, message_schema()))
    srun.run_file_stream(spark, src, fn, sink, ckpt, timeout_s=300)
    out = spark.read.parquet(sink)
    assert out.columns == ["key", "value"] and out.count() == 225
    row = out.first()
    parsed = json.loads(row["value"])
    assert parsed["timCycle"] == row["key"] and parsed["prediction"] in (0.0, 1.0)


def test_lost_messages_are_told(spark, stream_setup):
    df, model, src = stream_setup
    sink, ckpt = scratch_path(spark, "test_lost_out"), scratch_path(spark, "test_lost_ckpt")
    q = srun.run_file_stream(spark, src, lambda d: score_messages(d, model, message_schema(), counters="messages"),
                             sink, ckpt, timeout_s=300)
    seen = srun.observed_counts(q, "messages")
    kept = spark.read.parquet(sink)
    assert seen["messages"] == 605 and seen["malformed"] + seen["incomplete"] == 380 and kept.count() == 225
    assert seen["malformed"] > 0 and seen["incomplete"] > 0
    plain = score_messages(spark.read.parquet(src), model, message_schema())
    assert sorted(kept.collect()) == sorted(plain.collect())  # counting changes no row
    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    counted = score_messages(df, model, message_schema(), counters="messages")
    assert counted._jdf.queryExecution().executedPlan().toString().count("from_json") == 1


def test_kafka_option_maps():
    src = kafka.kafka_source_options("localhost:9092", "injection", max_offsets_per_trigger=1000)
    assert src == {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "injection",
                   "startingOffsets": "earliest", "failOnDataLoss": "true", "maxOffsetsPerTrigger": "1000"}
    assert kafka.kafka_source_options("b", "t", fail_on_data_loss=False)["failOnDataLoss"] == "false"
    sink = kafka.kafka_sink_options("localhost:9092", "injection2", "/chk")
    assert sink["topic"] == "injection2" and sink["checkpointLocation"] == "/chk"
    with pytest.raises(ValueError):
        kafka.kafka_sink_options("b", "t", "")


def test_console_sink_and_triggers(spark, stream_setup):
    _, _, src = stream_setup
    stream = msg.parse_flatten(srun.read_message_files(spark, src), message_schema()).select("timCycle")
    q = kafka.start(kafka.console_writer(stream, available_now=True, query_name="console_probe"), timeout_s=120)
    assert q.name == "console_probe" and not q.isActive
    sink, ckpt = scratch_path(spark, "test_trig_out"), scratch_path(spark, "test_trig_ckpt")
    q2 = srun.write_stream(stream, sink, ckpt, query_name="timed", trigger="1 second", available_now=False)
    try:
        q2.processAllAvailable()
        assert q2.isActive and q2.name == "timed"
    finally:
        q2.stop()
    assert spark.read.parquet(sink).count() == 605  # every message gives a row, invalid ones all-null


def test_kafka_source_needs_connector(spark):
    """The connector jar is not installed here; the reader builds and fails
    only on load, with an analysis error naming the source."""
    with pytest.raises(Exception):
        kafka.read_kafka(spark, "localhost:9092", "injection")


def test_scoring_parses_each_message_once(spark, stream_setup):
    """The plain assembler with 'skip' makes Catalyst parse every message once
    per feature; the clean-vector path keeps a single from_json."""
    df, model, _ = stream_setup
    spark.conf.set("spark.sql.debug.maxToStringFields", "100000")
    spark.conf.set("spark.sql.maxPlanStringLength", "100000000")
    ours = score_messages(df, model, message_schema())
    plan = ours._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1
    flat = msg.parse_flatten(df, message_schema()).drop("reason")
    plain = model.transform(flat).select("timCycle", "prediction")
    assert plain._jdf.queryExecution().executedPlan().toString().count("from_json") > len(FEATURES)


def test_clean_path_respects_keep(spark, stream_setup):
    """An assembler fitted with 'keep' keeps invalid rows; the clean path
    must not drop them."""
    from pyspark.ml import PipelineModel
    df, model, _ = stream_setup
    keep_model = PipelineModel([model.stages[0].copy().setHandleInvalid("keep"), *model.stages[1:]])
    flat = msg.parse_flatten(df, message_schema()).drop("reason")
    assert score_clean(flat, keep_model).count() == model.stages[0].copy().setHandleInvalid("keep").transform(flat).count()
