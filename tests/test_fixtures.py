"""Hand fixtures with known answers (FIXTURES.md section 3)."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from partqc.functions.columns import binary_ratio_class, label_from_text, ratio_class
from partqc.functions.hashing import seeded_hash, seeded_u32
from partqc.operators import evaluate, features, prep, sampling
from partqc.session import scratch_path
from partqc.sources import model_store
from partqc.sources.tables import events_view
from partqc.streaming.messages import alert_frame, parse_flatten

from conftest import SF01


def _vecs(df, col):
    from pyspark.ml.functions import vector_to_array
    return [list(r[0]) for r in df.select(vector_to_array(col)).collect()]


def test_minmax_fit_and_edge_cases(spark):
    schema = "a double, b double"
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], schema)
    test = spark.createDataFrame([(5.0, 5.0), (2.0, 9.0), (None, 1.0), (float("nan"), 1.0)], schema)
    asm = features.assembler(["a", "b"])
    model = features.minmax_scaler().fit(asm.transform(train))
    out = _vecs(model.transform(asm.transform(test)), "features")
    assert sorted(out) == sorted([[2.0, 0.5], [0.5, 0.5]])


def test_clean_assembly_equals_skip(spark):
    df = spark.createDataFrame([(5.0, 5.0), (2.0, 9.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double")
    skip = features.assembler(["a", "b"], handle_invalid="skip").transform(df)
    clean = features.assemble_features(df, ["a", "b"])
    assert sorted(_vecs(skip, "assembler")) == sorted(_vecs(clean, "assembler"))


def test_standard_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, c double")
    asm = features.assembler(["a", "c"]).transform(df)
    model = features.fit_standard_scaler(asm)
    out = _vecs(model.transform(asm), "features")
    assert sorted(out) == [[-1.0, 0.0], [1.0, 0.0]]
    path = scratch_path(spark, "scaler")
    model_store.save_model(model, path)
    assert sorted(_vecs(model_store.load_model(path).transform(asm), "features")) == sorted(out)


@pytest.mark.parametrize("p1,expected", [(0.8172, 0.0), (0.8269, 1.0)])
def test_class_thresholds(spark, p1, expected):
    df = spark.createDataFrame([(p1,)], "p1 double")
    got = df.select(binary_ratio_class("p1", [0.18, 0.82]).alias("a"),
                    ratio_class(F.array(F.lit(1.0) - F.col("p1"), F.col("p1")), [0.18, 0.82]).alias("b")).first()
    assert got["a"] == expected and got["b"] == expected


def test_rmse_of_classes(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 0.0), (0, 0.0)], "y int, prediction double")
    assert evaluate.rmse(df, "y").first()["rmse"] == pytest.approx(0.5)


def test_null_dropping(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 1.0), (3.0, 4.0)], "a double, b double")
    assert prep.drop_incomplete(df).count() == 2


def test_label_rule(spark):
    df = spark.createDataFrame([("[]",), ("['short shot']",), (None,)], "reason string")
    got = [r[0] for r in df.select(label_from_text("reason")).collect()]
    assert got == [0, 1, 1]


def test_json_parsing_rules(spark):
    schema = T.StructType([T.StructField(n, T.DoubleType()) for n in ["reason", "a", "b"]])
    msgs = ['{"reason":1,"a":1.5,"b":2}', '{"a":"1.5","b":2}', '{"a":"NaN","b":2}', '{"a":NaN,"b":2}',
            '{"a":1}', "junk", '[{"a":1,"b":2}]', "", None]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "i int, value string")
    rows = parse_flatten(df, schema).collect()

    def norm(r):
        return tuple("nan" if isinstance(v, float) and math.isnan(v) else v for v in r)
    got = [norm(r) for r in rows]
    assert got[0] == (1.0, 1.5, 2.0)
    assert got[1] == (None, None, 2.0)
    assert got[2] == (None, "nan", 2.0)
    assert got[3] == (None, "nan", 2.0)
    assert got[4] == (None, 1.0, None)
    for g in got[5:]:
        assert g == (None, None, None)


def test_alert_output(spark):
    df = spark.createDataFrame([(55.25, 1.0), (None, 0.0)], "timCycle double, prediction double")
    rows = alert_frame(df).collect()
    assert (rows[0]["key"], rows[0]["value"]) == ("55.25", '{"timCycle":"55.25","prediction":1.0}')
    assert (rows[1]["key"], rows[1]["value"]) == (None, '{"prediction":0.0}')


def test_hash_recipe(spark):
    r = spark.range(1).select(seeded_hash(13, F.lit("42")).alias("h"), seeded_u32(13, F.lit("42")).alias("u")).first()
    assert r["h"] == "3cfc7f8870cea124cc2d359f5bc08aaa"
    assert r["u"] == 1023180680


def test_bernoulli_keep_fraction(spark):
    from partqc.functions.hashing import bernoulli_keep
    ev = events_view(spark, SF01)
    assert ev.where(bernoulli_keep(13, "event_id", 0.8)).count() == 8044


def test_exact_undersampling_size(spark):
    ev = events_view(spark, SF01)
    out = sampling.undersample_exact(ev, "y", "event_id", 13)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 2014, 1: 2014}


def test_auc_fixture(spark):
    ev = events_view(spark, SF01).withColumn("score", F.floor("value").cast("double"))
    assert evaluate.roc_auc(ev, "y", "score").first()["auc"] == pytest.approx(0.498099, abs=5e-7)
