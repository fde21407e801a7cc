"""Model comparison of the analysis notebook.

Two training sets: exact under-sampling, or SMOTE on the training part; the
scaler is fitted on training rows only and applied to both parts. Three
classifiers each: logistic regression, forest (entropy), forest (gini). One
metrics row per pair (accuracy, precision, recall, AUC), all as aggregates.
The loop over the six fits is a loop over models, not over data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import class_probability
from ..operators import evaluate, features, models, sampling
from ..operators.deepforest import DeepForest
from ..operators.smote import Smote
from ..session import materialize

FeatureSpec = Sequence[str] | str  # columns, or one array<double> column

KINDS = ("logistic", "forest_entropy", "forest_gini")


@dataclass
class ModelData:
    train: DataFrame     # key, label, features (scaled vector)
    test: DataFrame
    label: str
    key: str
    n_train: int
    prepared: dict = field(default_factory=dict)  # binned and drawn training rows, shared by the deep forests


def scaled(train: DataFrame, test: DataFrame, label: str, key: str) -> ModelData:
    """Both parts standardised by the training rows."""
    scaler = features.fit_standard_scaler(train, "assembler", "features")
    tr = scaler.transform(train).select(key, label, "features")
    te = scaler.transform(test).select(key, label, "features")
    return ModelData(tr, te, label, key, train.count())


def to_vector(df: DataFrame, feature_cols: FeatureSpec, out_col: str = "assembler") -> DataFrame:
    """Feature vector from columns (rows with a null/NaN input dropped) or
    from one array column (kept narrow: wide alias projections are costly to
    plan)."""
    if isinstance(feature_cols, str):
        arr = F.col(feature_cols).cast("array<double>")
        ok = arr.isNotNull() & ~F.exists(arr, lambda v: v.isNull() | F.isnan(v))
        return df.where(ok).withColumn(out_col, array_to_vector(arr))
    return features.assemble_features(df, feature_cols, out_col)


def notebook_data(df: DataFrame, label: str, key: str, feature_cols: FeatureSpec,
                  sample_seed: int = 13, split_seed: int = 42, test_size: float = 0.2) -> ModelData:
    """Under-sampled path: balance exactly, split exactly, scale."""
    balanced = materialize(sampling.undersample_exact(df, label, key, sample_seed))
    train, test = sampling.split_exact(balanced, key, test_size, split_seed)
    return scaled(to_vector(train, feature_cols), to_vector(test, feature_cols), label, key)


def smote_data(df: DataFrame, label: str, key: str, feature_cols: FeatureSpec,
               split_seed: int = 42, test_size: float = 0.2, smote_seed: int = 2, k: int = 5,
               smote_method: str = "exact") -> ModelData:
    """SMOTE path: split the full table, drop incomplete rows, scale both parts by
    the natural training rows, then grow the training minority with SMOTE to the
    majority size (neighbours in scaled units, so no unit dominates)."""
    train, test = sampling.split_exact(df, key, test_size, split_seed)
    data = scaled(to_vector(train, feature_cols), to_vector(test, feature_cols), label, key)
    rows = materialize(data.train.select(key, label, vector_to_array("features").alias("x")))
    res = Smote(k=k, seed=smote_seed, method=smote_method).prepare(rows, label, key, "x")
    grown = materialize(res.resampled().select(key, label, array_to_vector("x").alias("features")))
    return ModelData(grown, data.test, label, key, grown.count())


def classifier(kind: str, label: str, n_train: int):
    if kind == "logistic":
        return models.logistic(n_train, label, "features")
    if kind == "forest_entropy":
        return models.forest_full_depth(label, "features", "entropy", seed=3)
    if kind == "forest_gini":
        return models.forest_full_depth(label, "features", "gini", seed=3)
    raise ValueError(f"unknown model kind {kind!r}")


def fit_and_score(data: ModelData, kind: str) -> DataFrame:
    """Fit one classifier on the training part, score the test part; adds
    ``p1`` (probability of class 1)."""
    est = classifier(kind, data.label, data.n_train)
    cached = data.train.persist()
    try:
        if isinstance(est, DeepForest):
            rows = est.rows_key()
            if rows not in data.prepared:
                data.prepared[rows] = est.prepare(cached)
            model = est.fit(cached, data.prepared[rows])
        else:
            model = est.fit(cached)
    finally:
        cached.unpersist()
    return model.transform(data.test).withColumn("p1", class_probability("probability", 1))


@dataclass
class Comparison:
    """Per (sampling, model): metrics, ROC points and confusion cells, and the
    scored test parts they come from."""
    metrics: DataFrame
    roc: DataFrame
    confusion: DataFrame
    scored: dict


def compare_all(df: DataFrame, label: str, key: str, feature_cols: FeatureSpec,
                kinds: Sequence[str] = KINDS) -> Comparison:
    """E10 in full: ``metrics`` (sampling, model, accuracy, precision, recall,
    auc), ``roc`` (sampling, model, threshold, fpr, tpr) and ``confusion``
    (sampling, model, actual, predicted, count). The scored test parts are one
    checkpointed table with the fit as key; each result is one job over it,
    grouped by the fit."""
    scored, every = {}, None
    for name, data in (("undersample", notebook_data(df, label, key, feature_cols)),
                       ("smote", smote_data(df, label, key, feature_cols))):
        for kind in kinds:
            s = fit_and_score(data, kind).select(F.lit(name).alias("sampling"), F.lit(kind).alias("model"),
                                                 key, label, "prediction", "p1")
            every = s if every is None else every.unionByName(s)
    table = materialize(every)  # one pass scores all fits
    for name in ("undersample", "smote"):
        for kind in kinds:
            scored[name, kind] = table.where((F.col("sampling") == name) & (F.col("model") == kind)).drop("sampling", "model")
    by = ["sampling", "model"]
    return Comparison(evaluate.model_metrics(table, label, "prediction", "p1", by),
                      evaluate.roc_curve(table, label, "p1", by=by),
                      evaluate.confusion_matrix(table, label, by=by), scored)


def compare_models(df: DataFrame, label: str, key: str, feature_cols: FeatureSpec,
                   kinds: Sequence[str] = KINDS) -> DataFrame:
    """``sampling, model, accuracy, precision, recall, auc`` for every pair."""
    return compare_all(df, label, key, feature_cols, kinds).metrics
