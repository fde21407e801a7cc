"""Invariants of operators that have no SQL oracle, and repeatability."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from partqc.functions.columns import binary_ratio_class, class_probability
from partqc.operators import evaluate, models, neighbours, quantiles, sampling, scan
from partqc.operators.smote import Smote
from partqc.plans import train
from partqc.sources import model_store
from partqc.sources.tables import EV_FEATURES, embeddings_array_view, events_view
from partqc.session import scratch_path

from conftest import SF01


@pytest.fixture(scope="module")
def production(spark):
    ev = events_view(spark, SF01)
    balanced = train.prepare_balanced(ev, "y", "event_id", 13)
    return train.train_and_score(balanced, EV_FEATURES, "y", "event_id", 42)


def test_probabilities_sum_to_one(production):
    arr = production.scored.select(vector_to_array("probability").alias("p"))
    bad = arr.where(F.abs(F.aggregate("p", F.lit(0.0), lambda a, b: a + b) - 1.0) > 1e-9).count()
    assert bad == 0


def test_prediction_follows_threshold_rule(production):
    s = production.scored.select("prediction", binary_ratio_class(class_probability("probability", 1),
                                                                  [0.18, 0.82]).alias("rule"))
    assert s.where(F.col("prediction") != F.col("rule")).count() == 0


def test_reloaded_model_predicts_the_same(spark, production):
    path = scratch_path(spark, "test_model")
    model_store.save_model(production.model, path)
    again = model_store.load_model(path).transform(production.test)
    a = production.scored.select("event_id", F.col("prediction").alias("a"))
    b = again.select("event_id", F.col("prediction").alias("b"))
    j = a.join(b, "event_id")
    assert j.count() == a.count() and j.where("a != b").count() == 0


def test_splits_disjoint_and_complete(spark):
    ev = events_view(spark, SF01)
    for tagged in (sampling.assign_split(ev, "event_id", [0.7, 0.2, 0.1], 5),
                   sampling.assign_split_exact(ev, "event_id", 0.2, 42)):
        assert tagged.count() == ev.count()
        assert tagged.select("event_id").distinct().count() == ev.count()
    tr, te = sampling.split_exact(ev, "event_id", 0.2, 42)
    assert te.count() == 2000 and tr.count() == 8000
    assert tr.join(te, "event_id").count() == 0


def test_repeatable_across_partitionings(spark):
    ev = events_view(spark, SF01)
    outs = []
    for n in (1, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = ev.repartition(n)
        ids = (sampling.undersample_exact(df, "y", "event_id", 13).select("event_id")
               .union(sampling.shuffle_rows(df, "event_id", 7).where("position <= 50").select("event_id"))
               .union(sampling.undersample_bernoulli(df, "y", "event_id", 13).select("event_id")))
        outs.append(sorted(r[0] for r in ids.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert outs[0] == outs[1]


def test_running_totals_match_window(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 2000), "o": rng.permutation(2000), "v": rng.integers(0, 10, 2000)})
    df = spark.createDataFrame(pdf)
    got = scan.running_totals(df, ["o"], ["v"], partition_cols=["g"], rows_per_block=300).toPandas()
    pdf = pdf.sort_values(["g", "o"])
    pdf["exp"] = pdf.groupby("g")["v"].cumsum()
    m = got.merge(pdf, on=["g", "o"])
    assert len(m) == 2000 and (m["v_cum"] == m["exp"]).all()


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(2)
    vals = np.concatenate([rng.normal(size=999), [5.0] * 300])
    df = spark.createDataFrame(pd.DataFrame({"a": vals, "b": vals * 2}))
    q = {(r["column"], r["prob"]): r["quantile"]
         for r in quantiles.exact_quantiles(df, ["a", "b"], [0.1, 0.25, 0.5, 0.9]).collect()}
    for p in (0.1, 0.25, 0.5, 0.9):
        assert q[("a", p)] == pytest.approx(np.quantile(vals, p), rel=1e-12)
        assert q[("b", p)] == pytest.approx(np.quantile(vals * 2, p), rel=1e-12)


def test_smote_invariants(spark):
    em = embeddings_array_view(spark, SF01)
    res = Smote(k=5, seed=2, block=16).prepare(em, "y", "vec_id", "x")
    counts = {r["y"]: r["count"] for r in res.resampled().groupBy("y").count().collect()}
    assert counts[0] == counts[1] == 456
    # New rows lie on the segment between base and neighbour.
    syn = res.synthetic().join(res.minority.select(F.col("vec_id").alias("base"), F.col("x").alias("xb")), "base") \
        .join(res.minority.select(F.col("vec_id").alias("neighbour"), F.col("x").alias("xn")), "neighbour")
    off = syn.select(F.exists(F.arrays_zip("x", "xb", "xn"),
                              lambda t: F.abs(t["x"] - (t["xb"] + F.col("step") * (t["xn"] - t["xb"]))) > 1e-9).alias("bad"))
    assert off.where("bad").count() == 0
    assert syn.where((F.col("step") < 0) | (F.col("step") >= 1)).count() == 0


def test_roc_points_monotone(spark):
    ev = events_view(spark, SF01)
    pts = evaluate.roc_curve(ev, "y", "value", rows_per_block=1500).orderBy(F.desc("threshold")).toPandas()
    assert pts.iloc[0]["fpr"] == 0 and pts.iloc[0]["tpr"] == 0
    assert pts.iloc[-1]["fpr"] == pytest.approx(1.0) and pts.iloc[-1]["tpr"] == pytest.approx(1.0)
    assert (pts["fpr"].diff().dropna() >= 0).all() and (pts["tpr"].diff().dropna() >= 0).all()


def test_auc_matches_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = events_view(spark, SF01).select(F.col("y").cast("double").alias("y"), "value")
    ours = evaluate.roc_auc(ev, "y", "value").first()["auc"]
    theirs = BinaryClassificationEvaluator(rawPredictionCol="value", labelCol="y", numBins=0).evaluate(ev)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_report_matches_multiclass_metrics(spark):
    from pyspark.mllib.evaluation import MulticlassMetrics
    ev = events_view(spark, SF01).withColumn("prediction", (F.col("value") >= 20).cast("double"))
    rep = {r["class"]: r for r in evaluate.classification_report(ev, "y").collect()}
    mm = MulticlassMetrics(ev.select("prediction", F.col("y").cast("double")).rdd.map(tuple))
    assert rep["1"]["precision"] == pytest.approx(mm.precision(1.0))
    assert rep["0"]["recall"] == pytest.approx(mm.recall(0.0))
    assert rep["accuracy"]["f1"] == pytest.approx(mm.accuracy)
    assert rep["weighted avg"]["f1"] == pytest.approx(mm.weightedFMeasure())


def test_logistic_regularisation_scale(spark):
    lr = models.logistic(400)
    assert lr.getRegParam() == pytest.approx(1 / 400) and not lr.getStandardization()


def test_empty_minority_raises(spark):
    ev = events_view(spark, SF01).where("y = 0")
    with pytest.raises(Exception):
        sampling.undersample_bernoulli(ev, "y", "event_id").count()


def test_correlation_has_one_null_rule_at_every_width(spark):
    from partqc.operators import profile
    ev = events_view(spark, SF01, True)
    wide = ev.withColumn("v2", F.col("value") * 2).withColumn("u2", F.col("user_id") + 1)
    few = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(ev, ["value", "user_id", "k"]).collect()}
    many = {(r["col_a"], r["col_b"]): r["r"]
            for r in profile.correlation_matrix(wide, ["y", "value", "user_id", "k", "v2", "u2"]).collect()}
    for pair, r in few.items():
        assert many[pair] == pytest.approx(r, abs=1e-12)


def test_auc_of_counts_whose_product_passes_a_long(spark, monkeypatch):
    from partqc.operators import evaluate
    counts = spark.createDataFrame([(0.1, 0, 4_000_000_000), (0.9, 4_000_000_000, 0)], "score double, pos long, neg long")
    monkeypatch.setattr(evaluate, "score_counts", lambda *a, **k: counts)
    assert evaluate.roc_auc(counts, "y", "score").first()["auc"] == 1.0


def test_smote_rejects_invalid_vectors(spark):
    from partqc.operators.smote import Smote
    rows = [(i, int(i < 6), [float(i), float("nan") if i == 3 else 1.0]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, y int, x array<double>")
    with pytest.raises(ValueError, match="1 minority rows"):
        Smote(k=2).prepare(df, "y", "id", "x")


def test_forest_bounds_take_effect(spark):
    from partqc.operators import models
    rf = models.forest_full_depth(num_trees=7, max_depth=4, min_instances_per_node=9)
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getMinInstancesPerNode()) == (7, 4, 9)
    assert models.forest_full_depth().getNumTrees() == 100 and models.forest_full_depth().getMaxDepth() == 30


def test_radix_passes_equal_a_sort(spark, monkeypatch):
    ev = events_view(spark, SF01)
    keys = sorted((hashlib.md5(f"13:{r[0]}".encode()).hexdigest(), r[0]) for r in ev.select("event_id").collect())
    for fetch in (16_384, 5):  # one pass of digits, many
        monkeypatch.setattr(sampling, "_FETCH", fetch)
        for n in (0, 1, 3000, len(keys), len(keys) + 5):
            got = sampling.flag_first_n(ev, 13, "event_id", n, "f").where("f").select("event_id").collect()
            assert sorted(r[0] for r in got) == sorted(k for _, k in keys[:n])


def test_first_n_of_repeated_keys_and_equal_rows(spark):
    rows = [(1, i % 400, "a") for i in range(4000)] + [(2, 7, "b")] * 3000 + [(None, 1, None)] * 5 + [(9, 9, "c")]
    df = spark.createDataFrame(rows, "id int, v int, t string")
    for n in (1, 3, 2500, 3005, 5001, 7004, 8006):
        flagged = sampling.flag_first_n(df, 5, "id", n, "f")
        got = [sorted((tuple(r) for r in flagged.where(F.col("f") == f).drop("f").collect()), key=repr) for f in (True, False)]
        assert len(got[0]) == min(n, len(rows)) and sorted(got[0] + got[1], key=repr) == sorted(rows, key=repr)
        again = sampling.first_n(df.repartition(7), 5, "id", n)
        assert sorted((tuple(r) for r in again.collect()), key=repr) == got[0]


def test_exact_sampling_is_one_wide_scan(spark):
    ev = events_view(spark, SF01)
    for df in (sampling.undersample_exact(ev, "y", "event_id", 13), sampling.assign_split_exact(ev, "event_id")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Join" not in plan and "Union" not in plan


def test_shuffle_is_one_wide_exchange_in_order(spark):
    ev = events_view(spark, SF01)
    out = sampling.shuffle_rows(ev, "event_id", 7, rows_per_block=300)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange shufflepartitionid") == 1 and "rangepartitioning" not in plan
    assert plan.count("Exchange") == plan.count("BroadcastExchange") + 1
    assert [r[0] for r in out.select("position").collect()] == list(range(1, 10001))  # partitions follow each other


def test_file_rows_are_a_stable_key(spark):
    path = f"{SF01}/lineitem.parquet"
    li = sampling.with_row_identity(spark.read.parquet(path)).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
    key = ["_file", "_row"]
    assert sampling.duplicate_keys(li, key).isEmpty()
    pick = lambda df: sorted(tuple(r) for r in sampling.undersample_bernoulli(df, "y", key, 3).collect())
    first = pick(li)
    assert pick(li.repartition(13)) == first
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")  # other splits of the file
    try:
        again = sampling.with_row_identity(spark.read.parquet(path)).withColumn("y", (F.col("l_returnflag") == "R").cast("int"))
        assert pick(again) == first
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_keyless_variants(spark):
    ev = events_view(spark, SF01)
    out = sampling.undersample_fraction(ev, "y", 0.25, seed=3)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[1] == 2014 and 1500 < counts[0] < 2500
    parts = sampling.split_random(ev, [0.8, 0.2], seed=13)
    assert sum(p.count() for p in parts) == ev.count()


def test_compound_key_sampling(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn(
        "y", (F.col("l_returnflag") == "R").cast("int"))
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    out = sampling.undersample_exact(li, "y", keys, 13)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[0] == counts[1]


def test_split_exact_size(spark):
    ev = events_view(spark, SF01).where("event_id < 1003")  # a size that needs rounding up
    tagged = sampling.assign_split_exact(ev, "event_id", 0.2, 42)
    assert tagged.where("split = 'test'").count() == 201


def test_rounded_roc_has_bounded_points(spark):
    ev = events_view(spark, SF01).withColumn("p1", F.col("value") / (F.col("value") + 20.0))
    exact = evaluate.roc_curve(ev, "y", "p1").count()
    rounded = evaluate.roc_curve(ev, "y", "p1", decimals=2).toPandas()
    assert len(rounded) <= 102 < exact
    assert rounded["fpr"].max() == pytest.approx(1.0) and rounded["tpr"].max() == pytest.approx(1.0)


def test_exact_quantiles_heavy_tail(spark):
    """Sentinel values far from the bulk force several narrowing levels."""
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(50, 5, size=5000), [1e12, -1e12, 9999.0]])
    df = spark.createDataFrame(pd.DataFrame({"a": vals}))
    got = {r["prob"]: r["quantile"]
           for r in quantiles.exact_quantiles(df, ["a"], [0.01, 0.5, 0.99], size=16, max_candidates=50).collect()}
    for p in (0.01, 0.5, 0.99):
        assert got[p] == pytest.approx(np.quantile(vals, p), rel=1e-12)


def test_duplicate_keys_and_repeatable_ties(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn(
        "y", (F.col("l_returnflag") == "R").cast("int"))
    assert sampling.duplicate_keys(li, ["l_orderkey", "l_linenumber"]).count() > 0
    picks = []
    for n in (1, 8):
        df = li.repartition(n)
        out = sampling.flag_first_n(df, 13, "l_orderkey", 5000, "f").where("f")
        picks.append(sorted(tuple(r) for r in out.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity").collect()))
    assert len(picks[0]) == 5000 and picks[0] == picks[1]


def test_smote_neighbours_exact_in_many_blocks_on_events(spark):
    """2,014 minority rows in blocks of about 150: equal to brute force."""
    ev = events_view(spark, SF01).where("y = 1").select(
        F.col("event_id"), F.array("value", "user_id", "k").alias("x"))
    pdf = ev.toPandas()
    X = np.stack(pdf["x"].to_numpy()).astype(float)
    keys = pdf["event_id"].to_numpy()
    d = np.zeros((len(X), len(X)))
    for j in range(X.shape[1]):
        diff = X[:, j][:, None] - X[:, j][None, :]
        d += diff * diff
    d = np.sqrt(d)
    np.fill_diagonal(d, np.inf)
    expected = {int(k): [int(keys[j]) for j in np.lexsort((keys, d[i]))[:5]] for i, k in enumerate(keys)}
    nb = neighbours.neighbours(ev, "event_id", 5, len(keys), block=150)
    got = {}
    for r in nb.orderBy("event_id", "rank").collect():
        got.setdefault(r["event_id"], []).append(r["neighbour"])
    assert got == expected


def test_rmse_matches_regression_evaluator(production):
    from pyspark.ml.evaluation import RegressionEvaluator
    scored = production.scored.withColumn("yd", F.col("y").cast("double"))
    ours = evaluate.rmse(scored, "yd").first()["rmse"]
    theirs = RegressionEvaluator(labelCol="yd", predictionCol="prediction", metricName="rmse").evaluate(scored)
    assert ours == pytest.approx(theirs, abs=1e-12)


def test_threshold_sweep_many_cutoffs(spark):
    ev = events_view(spark, SF01).withColumn("p1", F.col("value") / (F.col("value") + 20.0))
    cuts = [i / 200 for i in range(200)]
    got = {(r["cutoff"], r["actual"], r["predicted"]): r["count"]
           for r in evaluate.threshold_sweep(ev, "y", "p1", cuts).collect()}
    pdf = ev.select("y", "p1").toPandas()
    for c in cuts[::37]:
        pred = (pdf["p1"] >= c).astype(int)
        for a in (0, 1):
            for p in (0, 1):
                assert got[(c, a, p)] == int(((pdf["y"] == a) & (pred == p)).sum())
    assert len(got) == 4 * len(cuts)


def test_scans_repeatable_across_partitionings(spark):
    from partqc.operators import profile
    ev = events_view(spark, SF01)
    outs = []
    for n in (1, 16):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        df = ev.repartition(n)
        d = sorted(tuple(r) for r in profile.describe_columns(df, ["value", "k"]).collect())
        roc = sorted(tuple(r) for r in evaluate.roc_curve(df, "y", "value").collect())
        auc = evaluate.roc_auc(df, "y", "value").first()["auc"]
        sweep = sorted(tuple(r) for r in evaluate.threshold_sweep(df, "y", "value", [5.0, 50.0]).collect())
        outs.append((d, roc, auc, sweep))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    (d1, r1, a1, s1), (d2, r2, a2, s2) = outs
    assert r1 == r2 and s1 == s2 and a1 == pytest.approx(a2, abs=1e-15)
    for x, y in zip(d1, d2):
        assert x[0] == y[0] and x[1] == y[1]
        assert all(u == pytest.approx(v, rel=1e-12) for u, v in zip(x[2:], y[2:]))


def test_smote_degenerate_classes(spark):
    em = embeddings_array_view(spark, SF01)
    with pytest.raises(ValueError):
        Smote().prepare(em.where("y = 0"), "y", "vec_id", "x")
    one = em.where("y = 0").unionByName(em.where("y = 1").orderBy("vec_id").limit(1))
    with pytest.raises(ValueError):
        Smote().prepare(one, "y", "vec_id", "x")
