"""Feature operators (F1-F3): vector assembly and scaling.

All are Spark ML stages (JVM-side, saveable in a PipelineModel). Fitting a
scaler is one distributed aggregate (``Summarizer``) over the vectors.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import MinMaxScaler, StandardScalerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import vector_has_invalid


def assembler(cols: Sequence[str], out_col: str = "assembler", handle_invalid: str = "skip") -> VectorAssembler:
    """columns to one vector. ``skip`` drops rows with a null or NaN in
    any input; ``keep`` keeps them with NaN in the vector."""
    return VectorAssembler(inputCols=list(cols), outputCol=out_col, handleInvalid=handle_invalid)


def assemble_features(df: DataFrame, cols: Sequence[str], out_col: str = "assembler") -> DataFrame:
    """F1 as an operator: rows with an invalid input are dropped.

    Assembles with ``keep`` and then filters vectors holding NaN: the same
    rows as ``skip``, but the invalid-row test runs once on the vector instead
    of being pushed below a projection as one test per input column."""
    kept = assembler(cols, out_col, "keep").transform(df)
    return kept.where(~vector_has_invalid(out_col))


def vector_long(df: DataFrame, key: str, vec_col: str, value_col: str = "value") -> DataFrame:
    """Vector column as long rows ``key, position, value`` (0-based)."""
    return df.select(key, F.posexplode(vector_to_array(vec_col)).alias("position", value_col))


def minmax_scaler(in_col: str = "assembler", out_col: str = "features") -> MinMaxScaler:
    """rescale each feature to [0, 1] from the fitted min and max. A
    constant feature gives 0.5; values outside the fitted range are not
    clipped."""
    return MinMaxScaler(inputCol=in_col, outputCol=out_col)


def fit_standard_scaler(df: DataFrame, in_col: str = "assembler", out_col: str = "features") -> PipelineModel:
    """centre and divide by the **population** standard deviation (a
    constant feature gives 0).

    One ``Summarizer`` pass gives mean, sample variance and count; the model is
    Spark's own scaler model with the population deviation, so it is saveable and runs entirely in the JVM.
    """
    got = df.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(in_col)).alias("s")).select("s.*").first()
    n = got["count"]
    std = Vectors.dense([math.sqrt(v * (n - 1) / n) if n > 1 else 0.0 for v in got["variance"]])
    # As CountVectorizerModel.from_vocabulary does: a model made from its values.
    java = JavaWrapper._new_java_obj("org.apache.spark.ml.feature.StandardScalerModel",
                                     f"StandardScaler_{uuid.uuid4().hex[:12]}", std, got["mean"])
    model = StandardScalerModel(java)
    model._resetUid(java.uid())
    return PipelineModel(stages=[model._set(inputCol=in_col, outputCol=out_col, withMean=True, withStd=True)])
