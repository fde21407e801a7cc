"""The train job (CSV -> balanced fit -> saved model -> report) and the alert
path of the serve job, on a prepared CSV made from the events table."""

import json

from pyspark.sql import functions as F

from partqc.plans import serve
from partqc.schema import FEATURES
from partqc.session import scratch_path
from partqc.sources import files, model_store
from partqc.sources.tables import events_view
from partqc.streaming.messages import to_messages

import pytest

from conftest import SF01


def _prepared(spark):
    ev = events_view(spark, SF01)
    base = [F.col("value"), F.col("user_id"), F.col("k")]
    cols = [(base[i % 3] * (1.0 + i / 10.0)).alias(n) for i, n in enumerate(FEATURES)]
    return ev.select(F.col("event_id").alias("_c0"), F.col("y").alias("reason"), *cols)


def test_csv_inference_and_explicit_schema(spark):
    path = scratch_path(spark, "test_csv")
    files.write_csv(_prepared(spark).limit(50), path)
    inferred = files.read_csv(spark, path, infer=True)
    assert "_c0" not in inferred.columns and dict(inferred.dtypes)["reason"] == "int"
    assert inferred.count() == 50


def test_csv_columns_are_bound_by_name(spark):
    from partqc.schema import csv_schema
    path = scratch_path(spark, "test_csv_names")
    schema = csv_schema(["b", "a"], "reason")
    spark.createDataFrame([(0, 2.5, 1, 7.5)], "_c0 long, b double, reason int, a double").write.mode("overwrite").option(
        "header", True).csv(path)
    got = files.read_csv(spark, path, schema=schema).first()
    assert got.asDict() == {"reason": 1, "b": 2.5, "a": 7.5}
    with pytest.raises(ValueError, match="lacks"):
        files.read_csv(spark, path, schema=csv_schema(["b", "c"], "reason"))
    bad = csv_schema(["b"], "a")  # 7.5 is no integer
    with pytest.raises(Exception):
        files.read_csv(spark, path, schema=bad).collect()


def test_checkpoint_folder_is_required_off_local_masters(spark, monkeypatch):
    from partqc import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())


def test_train_job_and_alerts(spark):
    csv, model_path = scratch_path(spark, "test_job_csv"), scratch_path(spark, "test_job_model")
    prepared = _prepared(spark)
    files.write_csv(prepared, csv)
    rep = serve.train_job(spark, csv, model_path, key="_c0")
    assert rep.confusion.count() == 4
    classes = [r["class"] for r in rep.report.collect()]
    assert classes == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    rmse = rep.predictions.select("RMSE").distinct().collect()
    assert len(rmse) == 1
    model = model_store.load_model(model_path)
    msgs = to_messages(prepared.drop("_c0"), ["reason", *FEATURES])
    out = serve.alerts(msgs, model)
    row = out.first()
    assert json.loads(row["value"])["timCycle"] == row["key"]
    assert out.count() == prepared.count()


def test_analysis_flow(spark):
    """Raw export with reason text and machine-state columns -> analysis ->
    CSV outputs."""
    from partqc.plans import analysis

    em = spark.read.parquet(f"{SF01}/embeddings.parquet")
    feats = [f"e{i}" for i in range(8)]
    raw = em.select(
        F.col("vec_id").alias("Unnamed: 0"),
        F.lit("2024-01-01").alias("date"), F.lit(1).alias("cntCycle"),
        F.when(F.col("label") == 5, F.lit("['short shot']")).otherwise(F.lit("[]")).alias("reason"),
        *[F.col("embedding").getItem(i).cast("double").alias(f) for i, f in enumerate(feats)],
        F.col("vec_id").alias("part_id"))
    prepared = analysis.prepare_raw(raw)
    assert "date" not in prepared.columns and "Unnamed: 0" not in prepared.columns
    res = analysis.analyse(prepared, "part_id", feats)
    counts = {r["reason"]: r["count"] for r in res.class_counts.collect()}
    assert counts == {0: 456, 1: 44}
    assert res.correlation.count() == (len(feats) + 1) ** 2
    assert res.comparison.count() == 6
    assert res.cutoff_confusion.count() == 4
    p1, p2 = scratch_path(spark, "an_prep"), scratch_path(spark, "an_bal")
    analysis.write_outputs(prepared, "part_id", "reason", p1, p2)
    back = files.read_csv(spark, p2, infer=True)
    assert back.count() == 88 and "position" in back.columns


def test_command_line_train(spark):
    from partqc.__main__ import main
    csv, model_path = scratch_path(spark, "cli_csv"), scratch_path(spark, "cli_model")
    files.write_csv(_prepared(spark), csv)
    rep = main(["train", "--csv", csv, "--model", model_path, "--key", "_c0", "--exact"], spark=spark)
    assert rep.confusion.count() == 4
    assert model_store.load_model(model_path) is not None
