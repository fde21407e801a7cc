"""Registered queries: one per operator of the inventory, each
``(spark, sf_dir) -> DataFrame`` over the given tables.

Views: EV (events), EM (embeddings), LI (lineitem), LB (labels); see
``sources.tables``. Floating results are rounded to 6 decimals so that the
SQL oracle (``plans.oracle``) can compare values.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import class_probability, cutoff_class, round6
from ..operators import evaluate, features, models, neighbours, prep, profile, sampling, smote
from ..session import materialize, scratch_path
from ..sources import files, model_store
from ..sources.tables import (EV_FEATURES, LI_FEATURES, embeddings_array_view, events_view, labels_view,
                              lineitem_view, table)
from ..streaming import messages as msg
from ..streaming import run as srun
from ..streaming.score import score_messages
from . import compare, train

EV_KEY = "event_id"
EM_KEY = "vec_id"
EV_SEED_SAMPLE = 13
EV_SEED_SPLIT = 42
EV_SEED_SHUFFLE = 7
SWEEP_CUTOFFS = [0.3, 0.5, 0.7, 0.9]
EV_MESSAGE_FIELDS = ["reason", "event_id", "value", "user_id", "k"]


def _ev(spark, sf, dirty=False):
    return events_view(spark, sf, dirty)


def _ev_scored(spark, sf):
    """EV with a fixed score ``p1 = value / (value + 20)`` and the class at
    cut-off 0.5 (evaluation operators are checked on it without a model)."""
    ev = _ev(spark, sf)
    p1 = F.col("value") / (F.col("value") + F.lit(20.0))
    return ev.withColumn("p1", p1).withColumn("prediction", cutoff_class("p1", 0.5).cast("double"))


def _long(df: DataFrame, key: str, vec_col: str) -> DataFrame:
    lf = features.vector_long(df, key, vec_col)
    return lf.select(key, "position", round6("value").alias("value"))


def _ev_messages(ev: DataFrame) -> DataFrame:
    return msg.to_messages(ev, [F.col("y").cast("double").alias("reason"),
                                F.col("event_id").cast("double").alias("event_id"),
                                "value", "user_id", "k"])


def _ev_message_schema() -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType(), True) for n in EV_MESSAGE_FIELDS])


# ---------------------------------------------------------------- memo of fits
_FITS: dict = {}


def _memo(spark, sf, name, build):
    k = (spark.sparkContext.applicationId, sf, name)
    if k not in _FITS:
        _FITS[k] = build()
    return _FITS[k]


def _production(spark, sf) -> train.TrainResult:
    """The production flow on EV: exact under-sampling, exact split, forest
    with class thresholds."""
    def build():
        balanced = train.prepare_balanced(_ev(spark, sf), "y", EV_KEY, EV_SEED_SAMPLE)
        return train.train_and_score(balanced, EV_FEATURES, "y", EV_KEY, EV_SEED_SPLIT)
    return _memo(spark, sf, "production", build)


# ---------------------------------------------------------------- sources/sinks
def q_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    ev = _ev(spark, sf)
    path = scratch_path(spark, "csv_scan")
    files.write_csv(ev, path)
    return files.read_csv(spark, path, schema=ev.schema)


def q_csv_reordered(spark, sf):
    """The file's columns are in another order than the schema's, with one
    more; they are bound by name."""
    ev = _ev(spark, sf)
    path = scratch_path(spark, "csv_reordered")
    files.write_csv(ev.select(F.lit("x").alias("extra"), *ev.columns[::-1]), path)
    return files.read_csv(spark, path, schema=ev.schema)


def q_alert_messages(spark, sf):
    ev = _ev(spark, sf, dirty=True)
    scored = ev.select(F.col("value").alias("timCycle"), F.col("y").cast("double").alias("prediction"))
    return msg.alert_frame(scored, "timCycle", "prediction")


def q_model_roundtrip(spark, sf):
    res = _production(spark, sf)
    path = scratch_path(spark, "model")
    model_store.save_model(res.model, path)
    loaded = model_store.load_model(path)
    return loaded.transform(res.test).select(EV_KEY, "prediction")


# ---------------------------------------------------------------- projections
def q_drop_columns(spark, sf):
    ev = table(spark, sf, "events").withColumn("y", (F.col("event_type") == "error").cast("int"))
    return prep.drop_columns(ev, ["ts", "props", "event_type", "no_such_column"])


def q_select_columns(spark, sf):
    return prep.select_columns(_ev(spark, sf), [EV_KEY, "y"])


def q_json_flatten(spark, sf):
    return msg.parse_flatten(_ev_messages(_ev(spark, sf, dirty=True)), _ev_message_schema())


def q_attach_metric(spark, sf):
    s = _ev_scored(spark, sf)
    return prep.attach_metric(s.select(EV_KEY, "y", "prediction"), "rmse",
                              evaluate.rmse(s, "y").select(round6("rmse")))


def q_derive_label(spark, sf):
    ev = table(spark, sf, "events").withColumn("reason_text", F.expr("nullif(event_type, 'click')"))
    return prep.derive_label(ev, "reason_text", "reason", good_text="view").select(EV_KEY, "reason")


def q_filter_class(spark, sf):
    return prep.filter_class(_ev(spark, sf), "y", 0)


def q_drop_incomplete(spark, sf):
    return prep.drop_incomplete(_ev(spark, sf, dirty=True))


def q_threshold_class(spark, sf):
    ev = _ev(spark, sf).withColumn("p1", F.col("value") / (F.col("value") + F.lit(20.0)))
    return prep.threshold_class(ev, "p1", 0.5).select(EV_KEY, round6("p1").alias("p1"), "prediction")


def q_class_probability(spark, sf):
    res = _production(spark, sf)
    return prep.with_class_probability(res.scored).select(EV_KEY, "p1")


def q_threshold_ratio(spark, sf):
    ev = _ev(spark, sf).withColumn("p1", F.col("value") / (F.col("value") + F.lit(20.0)))
    ev = ev.withColumn("p0", F.lit(1.0) - F.col("p1"))
    return prep.threshold_ratio(ev, ["p0", "p1"], [0.18, 0.82]).select(EV_KEY, "prediction")


def q_first_rows(spark, sf):
    return prep.first_rows(_ev(spark, sf), 5, [EV_KEY])


# ---------------------------------------------------------------- profiles
def q_class_counts(spark, sf):
    return profile.class_counts(_ev(spark, sf), "y")


def q_imbalance_ratio(spark, sf):
    return profile.imbalance_ratio(_ev(spark, sf), "y")


def q_class_share(spark, sf):
    return profile.class_share(_ev(spark, sf), "y").select("y", "count", round6("share").alias("share"))


def q_class_share_labels(spark, sf):
    """A3 on LB (y = quality 0)."""
    return profile.class_share(labels_view(spark, sf), "y").select("y", "count", round6("share").alias("share"))


def q_imbalance_ratio_lineitem(spark, sf):
    """A2 on LI (y = return flag R; needs no key)."""
    return profile.imbalance_ratio(lineitem_view(spark, sf), "y")


def q_describe_columns(spark, sf):
    d = profile.describe_columns(_ev(spark, sf), ["y", *EV_FEATURES])
    return d.select("column", "count", *[round6(c).alias(c) for c in
                                         ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def q_correlation_matrix(spark, sf):
    c = profile.correlation_matrix(_ev(spark, sf), ["y", *EV_FEATURES])
    return c.select("col_a", "col_b", round6("r").alias("r"))


def q_correlation_dirty(spark, sf):
    """A5 with nulls and NaN: rows that lack any listed column are left out."""
    c = profile.correlation_matrix(_ev(spark, sf, dirty=True), ["y", *EV_FEATURES])
    return c.select("col_a", "col_b", round6("r").alias("r"))


def q_correlation_wide(spark, sf):
    """A5 on the 64 columns of EM."""
    em = embeddings_array_view(spark, sf)
    cols = [f"c{i}" for i in range(64)]
    wide = em.select(*[F.col("x")[i].cast("double").alias(c) for i, c in enumerate(cols)])
    c = profile.correlation_matrix(wide, cols)
    return c.select("col_a", "col_b", round6("r").alias("r"))


def q_describe_lineitem(spark, sf):
    """A4 on LI: columns of few distinct values."""
    d = profile.describe_columns(table(spark, sf, "lineitem"), ["l_quantity", "l_discount", "l_tax", "l_linenumber"])
    return d.select("column", "count", *[round6(c).alias(c) for c in
                                         ["mean", "std", "min", "q25", "q50", "q75", "max"]])


# ---------------------------------------------------------------- sampling
def q_undersample_bernoulli(spark, sf):
    return sampling.undersample_bernoulli(_ev(spark, sf), "y", EV_KEY, EV_SEED_SAMPLE)


def q_undersample_exact(spark, sf):
    return sampling.undersample_exact(_ev(spark, sf), "y", EV_KEY, EV_SEED_SAMPLE)


def q_split_weighted(spark, sf):
    return sampling.assign_split(_ev(spark, sf), EV_KEY, [0.8, 0.2], EV_SEED_SAMPLE,
                                 ["train", "test"]).select(EV_KEY, "split")


def q_split_exact(spark, sf):
    return sampling.assign_split_exact(_ev(spark, sf), EV_KEY, 0.2, EV_SEED_SPLIT).select(EV_KEY, "split")


def q_shuffle_rows(spark, sf):
    return sampling.shuffle_rows(_ev(spark, sf), EV_KEY, EV_SEED_SHUFFLE).select(EV_KEY, "position")


def _li_identified(spark, sf):
    li = sampling.with_row_identity(table(spark, sf, "lineitem"))
    return li.select((F.col("l_returnflag") == "R").cast("int").alias("y"), "l_quantity", "_file", "_row")


def q_undersample_keyless(spark, sf):
    """R1, R2 on a table without a key, by each row's place in its file: class
    sizes, and rows whose Bernoulli draw changes over a repartitioning."""
    li, key = _li_identified(spark, sf), ["_file", "_row"]
    one = sampling.undersample_bernoulli(li, "y", key, EV_SEED_SAMPLE).select(*key, F.lit(1).alias("a"))
    two = sampling.undersample_bernoulli(li.repartition(7), "y", key, EV_SEED_SAMPLE).select(*key, F.lit(1).alias("b"))
    moved = one.join(two, key, "full").agg(F.count_if(F.col("a").isNull() | F.col("b").isNull()).alias("moved"))
    exact = sampling.undersample_exact(li, "y", key, EV_SEED_SAMPLE)
    return exact.groupBy("y").agg(F.count("*").alias("count")).select("y", "count", moved.scalar().alias("moved"))


def q_split_keyless(spark, sf):
    """R5 on a table without a key."""
    li = _li_identified(spark, sf)
    return sampling.assign_split_exact(li, ["_file", "_row"], 0.2, EV_SEED_SPLIT).groupBy("split").agg(
        F.count("*").alias("count"))


def q_union_classes(spark, sf):
    ev = _ev(spark, sf)
    return sampling.union_classes(prep.filter_class(ev, "y", 0), prep.filter_class(ev, "y", 1))


# ---------------------------------------------------------------- SMOTE
def _em_smote(spark, sf):
    def build():
        em = embeddings_array_view(spark, sf)
        return smote.Smote(k=5, seed=2).prepare(em, "y", EM_KEY, "x")
    return _memo(spark, sf, "smote_em", build)


def q_smote_neighbours(spark, sf):
    nb = _em_smote(spark, sf).neighbours
    return nb.select(EM_KEY, "rank", "neighbour", round6("distance").alias("distance"))


def q_smote_rows(spark, sf):
    rows = _em_smote(spark, sf).synthetic()
    return rows.select("new_id", "base", "neighbour",
                       F.posexplode("x").alias("position", "value")
                       ).select("new_id", "base", "neighbour", "position", round6("value").alias("value"))


def _ev_smote(spark, sf, method):
    def build():
        return smote.Smote(k=5, seed=2, method=method).prepare(_ev(spark, sf), "y", EV_KEY, EV_FEATURES)
    return _memo(spark, sf, f"smote_ev_{method}", build)


def q_smote_neighbours_ev(spark, sf):
    """R3 over thousands of minority rows, default parameters."""
    nb = _ev_smote(spark, sf, "exact").neighbours
    return nb.select(EV_KEY, "rank", "neighbour", round6("distance").alias("distance"))


def q_smote_rows_lsh(spark, sf):
    """R3 with neighbours from the random-projection index."""
    rows = _ev_smote(spark, sf, "lsh").synthetic()
    return rows.select("new_id", "base", "neighbour", F.posexplode("x").alias("position", "value")
                       ).select("new_id", "base", "neighbour", "position", round6("value").alias("value"))


def q_smote_lsh_check(spark, sf):
    """The index's lists are whole, its distances true, its recall at least
    0.9, and every synthetic row has its draw."""
    out = []
    em_rows = smote.Smote(k=5, seed=2, method="lsh").prepare(embeddings_array_view(spark, sf), "y", EM_KEY, "x")
    for view, res, exact, key in (("EV", _ev_smote(spark, sf, "lsh"), _ev_smote(spark, sf, "exact"), EV_KEY),
                                  ("EM", em_rows, _em_smote(spark, sf), EM_KEY)):
        good = neighbours.recall(res.neighbours, exact.neighbours, key) >= 0.9
        x = res.minority
        pairs = (res.neighbours.join(x.select(key, F.col("x").alias("xa")), key)
                 .join(x.select(F.col(key).alias("neighbour"), F.col("x").alias("xb")), "neighbour"))
        far = F.sqrt(F.aggregate(F.zip_with("xa", "xb", lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b))
        new = res.synthetic().agg(F.count("*").alias("n_new"))
        out.append(pairs.agg(F.count("*").alias("n"), F.count_if(F.abs(far - F.col("distance")) > 1e-9).alias("off"))
                   .select(F.lit(view).alias("view"), "n", "off", F.lit(good).alias("recalled"), new.scalar().alias("n_new")))
    return out[0].unionByName(out[1])


def q_smote_counts(spark, sf):
    return profile.class_counts(_em_smote(spark, sf).resampled(), "y")


# ---------------------------------------------------------------- features
def q_assemble_features(spark, sf):
    a = features.assemble_features(_ev(spark, sf, dirty=True), EV_FEATURES)
    return _long(a, EV_KEY, "assembler")


def q_scale_minmax(spark, sf):
    ev = _ev(spark, sf)
    tr = sampling.assign_split(ev, EV_KEY, [0.8, 0.2], EV_SEED_SAMPLE, ["train", "test"])
    asm = features.assembler(EV_FEATURES)
    fitted = features.minmax_scaler().fit(asm.transform(tr.where(F.col("split") == "train")))
    return _long(fitted.transform(asm.transform(ev)), EV_KEY, "features")


def q_scale_standard(spark, sf):
    ev = _ev(spark, sf)
    asm = features.assembler(EV_FEATURES).transform(ev)
    fitted = features.fit_standard_scaler(asm)
    return _long(fitted.transform(asm), EV_KEY, "features")


# ---------------------------------------------------------------- models
def q_rf_gini(spark, sf):
    res = _production(spark, sf)
    return res.scored.select(EV_KEY, "y", "prediction", class_probability("probability", 1).alias("p1"))


def q_batch_score(spark, sf):
    res = _production(spark, sf)
    full = models.batch_score(res.model, _ev(spark, sf))
    return full.select(EV_KEY, "y", "prediction",
                       class_probability("probability", 0).alias("p0"),
                       class_probability("probability", 1).alias("p1"))


def _notebook_split(spark, sf):
    def build():
        return compare.notebook_data(_ev(spark, sf), "y", EV_KEY, EV_FEATURES)
    return _memo(spark, sf, "notebook_ev", build)


def q_rf_entropy(spark, sf):
    return compare.fit_and_score(_notebook_split(spark, sf), "forest_entropy").select(EV_KEY, "y", "prediction", "p1")


def q_rf_gini_100(spark, sf):
    return compare.fit_and_score(_notebook_split(spark, sf), "forest_gini").select(EV_KEY, "y", "prediction", "p1")


def q_logreg(spark, sf):
    return compare.fit_and_score(_notebook_split(spark, sf), "logistic").select(EV_KEY, "y", "prediction", "p1")


def _em_compared(spark, sf) -> compare.Comparison:
    return _memo(spark, sf, "compare_em",
                 lambda: compare.compare_all(embeddings_array_view(spark, sf), "y", EM_KEY, "x"))


def q_compare_models(spark, sf):
    return _em_compared(spark, sf).metrics


def q_compare_cells(spark, sf):
    """Confusion cells of the six fits."""
    return _em_compared(spark, sf).confusion


def q_compare_roc(spark, sf):
    """All ROC points of the six fits."""
    return _em_compared(spark, sf).roc


# What holds of the model queries whatever the model is.
def q_model_roundtrip_check(spark, sf):
    a = _production(spark, sf).scored.select(EV_KEY, F.col("prediction").alias("before"))
    both = a.join(q_model_roundtrip(spark, sf), EV_KEY, "full")
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("before").eqNullSafe(F.col("prediction"))).alias("differ"))


def q_class_probability_check(spark, sf):
    s = _production(spark, sf).scored
    s = prep.with_class_probability(prep.with_class_probability(s, cls=0, out_col="p0"))
    return s.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("p0") + F.col("p1") - 1) > 1e-9).alias("off"))


def q_batch_score_check(spark, sf):
    """M2, M7: the prediction follows the class thresholds on every row."""
    rule = prep.threshold_ratio(q_batch_score(spark, sf).withColumnRenamed("prediction", "given"), ["p0", "p1"], [0.18, 0.82])
    return rule.agg(F.count("*").alias("n"), F.count_if(F.col("given") != F.col("prediction")).alias("off"))


def _cutoff_check(scored):
    """M3-M5: the test part's keys and labels, and predictions by the cut-off."""
    wrong = F.when(F.abs(F.col("p1") - 0.5) > 1e-9, F.col("prediction") != (F.col("p1") > 0.5).cast("double"))
    return scored.agg(F.count("*").alias("n"), F.sum(EV_KEY).alias("keys"), F.sum("y").cast("long").alias("positive"),
                      F.count_if(F.coalesce(wrong, F.lit(False)) | ~F.col("p1").between(0, 1)).alias("off"))


def q_rf_entropy_check(spark, sf):
    return _cutoff_check(q_rf_entropy(spark, sf))


def q_rf_gini_100_check(spark, sf):
    return _cutoff_check(q_rf_gini_100(spark, sf))


def q_logreg_check(spark, sf):
    return _cutoff_check(q_logreg(spark, sf))


def q_models_learn_check(spark, sf):
    """M1, M3-M5 on a label that follows from the features (LI: quantity above 25 or
    discount above 0.05), lines numbered 5 held out: their number, keys and
    labels, and an AUC that no random score reaches."""
    y = ((F.col("l_quantity") > 25) | (F.col("l_discount") > 0.05)).cast("int")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", y.alias("y"), *LI_FEATURES)
    fold = F.col("l_linenumber") == 5
    train_part, test = df.where(~fold), df.where(fold)
    data = compare.scaled(*(compare.to_vector(d, LI_FEATURES) for d in (train_part, test)), "y", "l_orderkey")
    model = models.fit(models.production_pipeline(LI_FEATURES, "y"), train_part)
    scored = [(d.select(F.lit(kind).alias("model"), "l_orderkey", "y", class_probability("probability", 1).alias("p1")))
              for kind, d in [(k, compare.fit_and_score(data, k)) for k in compare.KINDS] + [("production", model.transform(test))]]
    every = materialize(functools.reduce(DataFrame.unionByName, scored))
    auc = evaluate.roc_auc(every, "y", "p1", by=["model"])
    floor = F.when(F.col("model") == "logistic", 0.85).otherwise(0.95)
    return (every.groupBy("model").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"),
                                       F.sum("y").cast("long").alias("positive"))
            .join(auc, "model").select("model", "n", "keys", "positive", (F.col("auc") >= floor).alias("learned")))


def q_compare_confusion(spark, sf):
    """The cells of each of the six fits add up to its test rows."""
    c = _em_compared(spark, sf).confusion
    return c.groupBy("sampling", "model").agg(F.sum("count").alias("n"), F.sum(F.when(F.col("actual") == 1, F.col("count"))
                                                                                .otherwise(0)).alias("positive"))


def q_compare_roc_check(spark, sf):
    """Each curve runs from (0, 0) to (1, 1) without falling back, and its
    area is the AUC of the metrics."""
    c = _em_compared(spark, sf)
    w = Window.partitionBy("sampling", "model").orderBy(F.desc("threshold"))
    back = (F.col("fpr") < F.lag("fpr").over(w)) | (F.col("tpr") < F.lag("tpr").over(w))
    strip = (F.col("fpr") - F.lag("fpr").over(w)) * (F.col("tpr") + F.lag("tpr").over(w)) / 2
    pts = c.roc.select("*", back.alias("back"), strip.alias("strip"))
    curve = pts.groupBy("sampling", "model").agg(
        F.min(F.struct("fpr", "tpr")).alias("lo"), F.max(F.struct("fpr", "tpr")).alias("hi"),
        F.count_if("back").alias("falls"), F.sum("strip").alias("area"))
    return curve.join(c.metrics, ["sampling", "model"]).select(
        "sampling", "model", F.col("lo.fpr").alias("x0"), F.col("lo.tpr").alias("y0"), F.col("hi.fpr").alias("x1"),
        F.col("hi.tpr").alias("y1"), "falls", (F.abs(F.col("area") - F.col("auc")) < 1e-9).alias("agrees"))


def q_stream_score_check(spark, sf):
    """The stream's keys and predictions are those of batch scoring."""
    batch = models.batch_score(_production(spark, sf).model, prep.drop_incomplete(_ev(spark, sf, dirty=True)))
    both = (q_stream_score(spark, sf).select(F.col(EV_KEY).cast("long").alias(EV_KEY), "prediction")
            .join(batch.select(EV_KEY, F.col("prediction").alias("batch")), EV_KEY, "full"))
    return both.agg(F.count("*").alias("n"), F.count_if(~F.col("prediction").eqNullSafe(F.col("batch"))).alias("differ"))


# ---------------------------------------------------------------- evaluation
def _ev_odd(spark, sf):
    """Scored EV in which some labels and predictions are null or no class."""
    s, key = _ev_scored(spark, sf), F.col(EV_KEY)
    return s.withColumn("y", F.when(key % 7 == 0, 2).when(key % 11 != 0, F.col("y"))).withColumn(
        "prediction", F.when(key % 13 == 0, 3.0).when(key % 17 != 0, F.col("prediction")))


def q_confusion_dirty(spark, sf):
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("other")).alias(c)
    return evaluate.confusion_matrix(_ev_odd(spark, sf), "y").select(name("actual"), name("predicted"), "count")


def q_metrics_class0(spark, sf):
    """E3-E5 with class 0 as the positive one."""
    m = evaluate.binary_metrics(_ev_scored(spark, sf), "y", positive=0)
    return m.select(*[round6(c).alias(c) for c in m.columns])


def q_rmse(spark, sf):
    return evaluate.rmse(_ev_scored(spark, sf), "y").select(round6("rmse").alias("rmse"))


def q_confusion_matrix(spark, sf):
    return evaluate.confusion_matrix(_ev_scored(spark, sf), "y")


def q_binary_metrics(spark, sf):
    m = evaluate.binary_metrics(_ev_scored(spark, sf), "y")
    return m.select(*[round6(c).alias(c) for c in m.columns])


def q_roc_curve(spark, sf):
    ev = _ev(spark, sf).withColumn("score", F.floor("value").cast("double"))
    r = evaluate.roc_curve(ev, "y", "score")
    return r.select("threshold", round6("fpr").alias("fpr"), round6("tpr").alias("tpr"))


def q_roc_auc(spark, sf):
    ev = _ev(spark, sf).withColumn("score", F.floor("value").cast("double"))
    return evaluate.roc_auc(ev, "y", "score").select(round6("auc").alias("auc"))


def q_classification_report(spark, sf):
    r = evaluate.classification_report(_ev_scored(spark, sf), "y")
    return r.select("class", *[round6(c).alias(c) for c in ["precision", "recall", "f1"]], "support")


def q_threshold_sweep(spark, sf):
    return evaluate.threshold_sweep(_ev_scored(spark, sf), "y", "p1", SWEEP_CUTOFFS)


# ---------------------------------------------------------------- streaming
def _write_ev_message_files(spark, ev: DataFrame, name: str, parts: int = 4) -> str:
    """Messages of EV as parquet files with one ``value binary`` column (a
    stand-in for a topic); several files so a stream takes several batches."""
    path = scratch_path(spark, name)
    _ev_messages(ev).repartition(parts).write.mode("overwrite").parquet(path)
    return path


def q_stream_parse(spark, sf):
    src = _write_ev_message_files(spark, _ev(spark, sf, dirty=True), "stream_parse_src")
    sink, ckpt = scratch_path(spark, "stream_parse_out"), scratch_path(spark, "stream_parse_ckpt")
    srun.run_file_stream(spark, src, lambda d: msg.parse_flatten(d, _ev_message_schema()), sink, ckpt)
    return spark.read.parquet(sink)


def q_stream_restart(spark, sf):
    """T5: a stream is stopped after the first half of the files and restarted
    on the same checkpoint after the second half arrives; every message ends
    up in the sink exactly once."""
    ev = _ev(spark, sf)
    halves = sampling.assign_split(ev, EV_KEY, [0.5, 0.5], 99, ["a", "b"])
    src = scratch_path(spark, "stream_restart_src")
    sink, ckpt = scratch_path(spark, "stream_restart_out"), scratch_path(spark, "stream_restart_ckpt")
    parse = lambda d: msg.parse_flatten(d, _ev_message_schema())
    for part in ("a", "b"):
        _ev_messages(halves.where(F.col("split") == part).drop("split")).repartition(2) \
            .write.mode("append").parquet(src)
        srun.run_file_stream(spark, src, parse, sink, ckpt, query_name=None)
    return spark.read.parquet(sink)


def q_stream_score(spark, sf):
    res = _production(spark, sf)
    test_msgs = _write_ev_message_files(spark, _ev(spark, sf, dirty=True), "stream_score_src")
    sink, ckpt = scratch_path(spark, "stream_score_out"), scratch_path(spark, "stream_score_ckpt")
    srun.run_file_stream(
        spark, test_msgs,
        lambda d: score_messages(d, res.model, _ev_message_schema(), label="reason",
                                 out_cols=(EV_KEY, "value", "prediction")),
        sink, ckpt)
    return spark.read.parquet(sink)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "csv_scan": q_csv_scan,
    "alert_messages": q_alert_messages,
    "model_roundtrip": q_model_roundtrip,
    "drop_columns": q_drop_columns,
    "select_columns": q_select_columns,
    "json_flatten": q_json_flatten,
    "attach_metric": q_attach_metric,
    "derive_label": q_derive_label,
    "filter_class": q_filter_class,
    "drop_incomplete": q_drop_incomplete,
    "threshold_class": q_threshold_class,
    "class_probability": q_class_probability,
    "threshold_ratio": q_threshold_ratio,
    "first_rows": q_first_rows,
    "class_counts": q_class_counts,
    "imbalance_ratio": q_imbalance_ratio,
    "class_share": q_class_share,
    "class_share_labels": q_class_share_labels,
    "imbalance_ratio_lineitem": q_imbalance_ratio_lineitem,
    "describe_columns": q_describe_columns,
    "correlation_matrix": q_correlation_matrix,
    "undersample_bernoulli": q_undersample_bernoulli,
    "undersample_exact": q_undersample_exact,
    "split_weighted": q_split_weighted,
    "split_exact": q_split_exact,
    "shuffle_rows": q_shuffle_rows,
    "undersample_keyless": q_undersample_keyless,
    "split_keyless": q_split_keyless,
    "union_classes": q_union_classes,
    "smote_neighbours": q_smote_neighbours,
    "smote_rows": q_smote_rows,
    "smote_counts": q_smote_counts,
    "smote_neighbours_ev": q_smote_neighbours_ev,
    "smote_rows_lsh": q_smote_rows_lsh,
    "smote_lsh_check": q_smote_lsh_check,
    "assemble_features": q_assemble_features,
    "scale_minmax": q_scale_minmax,
    "scale_standard": q_scale_standard,
    "rf_gini": q_rf_gini,
    "batch_score": q_batch_score,
    "rf_entropy": q_rf_entropy,
    "rf_gini_100": q_rf_gini_100,
    "logreg": q_logreg,
    "compare_models": q_compare_models,
    "rmse": q_rmse,
    "confusion_matrix": q_confusion_matrix,
    "binary_metrics": q_binary_metrics,
    "roc_curve": q_roc_curve,
    "roc_auc": q_roc_auc,
    "classification_report": q_classification_report,
    "threshold_sweep": q_threshold_sweep,
    "stream_parse": q_stream_parse,
    "stream_restart": q_stream_restart,
    "stream_score": q_stream_score,
    "csv_reordered": q_csv_reordered,
    "correlation_dirty": q_correlation_dirty,
    "correlation_wide": q_correlation_wide,
    "describe_lineitem": q_describe_lineitem,
    "model_roundtrip_check": q_model_roundtrip_check,
    "class_probability_check": q_class_probability_check,
    "batch_score_check": q_batch_score_check,
    "rf_entropy_check": q_rf_entropy_check,
    "rf_gini_100_check": q_rf_gini_100_check,
    "logreg_check": q_logreg_check,
    "models_learn_check": q_models_learn_check,
    "compare_confusion": q_compare_confusion,
    "compare_cells": q_compare_cells,
    "compare_roc": q_compare_roc,
    "compare_roc_check": q_compare_roc_check,
    "stream_score_check": q_stream_score_check,
    "confusion_dirty": q_confusion_dirty,
    "metrics_class0": q_metrics_class0,
}
