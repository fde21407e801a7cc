"""Model operators (M1-M7): Spark ML estimators and pipelines.

Training is Spark ML's distributed implementation (histogram aggregation per
tree level for forests, L-BFGS tree-aggregates for logistic regression); forests
of full depth are :mod:`.deepforest`.
The training frame is persisted for the fit (every stage and tree level
re-reads it) and released afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame

from ..schema import LABEL, PRODUCTION_THRESHOLDS
from .deepforest import DeepForest
from .features import assembler, minmax_scaler

SPARK_MAX_DEPTH = 30


def forest(label: str = LABEL, features_col: str = "features", impurity: str = "gini",
           num_trees: int = 20, max_depth: int = 5, max_bins: int = 32,
           subset: str = "auto", seed: int | None = 7,
           thresholds: Sequence[float] | None = None) -> RandomForestClassifier:
    """M1 (defaults = Spark's: 20 trees, depth 5, 32 bins) with an explicit
    seed; M2 when ``thresholds`` are given."""
    rf = RandomForestClassifier(featuresCol=features_col, labelCol=label, impurity=impurity,
                                numTrees=num_trees, maxDepth=max_depth, maxBins=max_bins,
                                featureSubsetStrategy=subset)
    if seed is not None:
        rf = rf.setSeed(seed)
    if thresholds is not None:
        rf = rf.setThresholds(list(thresholds))
    return rf


def forest_full_depth(label: str = LABEL, features_col: str = "features", impurity: str = "gini",
                      seed: int = 3, num_trees: int = 100, max_depth: int = SPARK_MAX_DEPTH,
                      min_instances_per_node: int = 1) -> DeepForest:
    """M3 / M4: 100 trees grown as deep as Spark ML allows (30), square-root
    feature subsets, the given impurity and seed.

    Such trees have about as many nodes as rows, so they are a table, not an object
    of the driver (see :mod:`.deepforest`)."""
    return DeepForest(label, features_col, impurity, seed, num_trees, max_depth, min_instances_per_node)


def logistic(n_train: int, label: str = LABEL, features_col: str = "features", c: float = 1.0) -> LogisticRegression:
    """M5: L2-regularised logistic regression with inverse strength ``c`` on
    the summed loss. Spark averages the loss over rows, so the equivalent
    ``regParam`` is ``1 / (c * n)``; features are used as given."""
    return LogisticRegression(featuresCol=features_col, labelCol=label,
                              regParam=1.0 / (c * max(1, n_train)), elasticNetParam=0.0,
                              standardization=False, maxIter=100)


def production_pipeline(features: Sequence[str], label: str = LABEL,
                        thresholds: Sequence[float] | None = tuple(PRODUCTION_THRESHOLDS),
                        seed: int | None = 7, handle_invalid: str = "skip") -> Pipeline:
    """M6: assemble (dropping invalid rows) -> min-max scale -> forest."""
    return Pipeline(stages=[
        assembler(features, "assembler", handle_invalid),
        minmax_scaler("assembler", "features"),
        forest(label, "features", thresholds=thresholds, seed=seed),
    ])


def pipeline_with(features: Sequence[str], classifier, scaler=None) -> Pipeline:
    """Assemble -> (scaler) -> classifier, for the model comparison."""
    stages = [assembler(features, "assembler", "skip")]
    if scaler is not None:
        stages.append(scaler)
        classifier = classifier.setFeaturesCol(scaler.getOutputCol())
    else:
        classifier = classifier.setFeaturesCol("assembler")
    stages.append(classifier)
    return Pipeline(stages=stages)


def fit(pipeline: Pipeline, train: DataFrame, partitions: int | None = None) -> PipelineModel:
    """Fit with the training frame persisted for the duration of the fit.

    ``partitions`` spreads the training rows over that many tasks first (one
    round-robin shuffle): useful when the input comes in few large splits,
    since every tree level is one pass over the cached partitions."""
    if partitions:
        train = train.repartition(int(partitions))
    cached = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipeline.fit(cached)
    finally:
        cached.unpersist()


def batch_score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """M7: adds ``rawPrediction, probability, prediction`` (and the stage
    outputs)."""
    return model.transform(df)
