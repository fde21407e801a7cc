"""Scoring of parsed messages with a fitted pipeline (T1), batch or stream.

The plain ``model.transform`` of an assembler with ``handleInvalid='skip'``
adds a null/NaN test for every input column. Catalyst pushes that filter
below the flattening projection and rewrites each column to its own
``from_json`` call, so every message is parsed once per feature plus once.
Here the assembler runs with ``keep`` and one test on the finished vector
drops invalid rows: the same rows and predictions, one parse per message.
No session setting is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame

from ..functions.columns import vector_has_invalid
from ..schema import CYCLE_TIME, LABEL
from .messages import parse_flatten, parse_flatten_counted


def score_clean(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Transform with a fitted pipeline whose first stage is an assembler
    with ``handleInvalid='skip'``, dropping rows with a null or NaN input
    once, on the assembled vector. Other pipelines (an assembler that keeps
    or rejects invalid rows, or none) are applied unchanged."""
    stages = list(model.stages)
    if (not stages or not isinstance(stages[0], VectorAssembler)
            or stages[0].getHandleInvalid() != "skip"
            or any(isinstance(df.schema[c].dataType, VectorUDT) for c in stages[0].getInputCols())):
        # 'skip' tests NaN only in numeric inputs, not inside vector inputs.
        return model.transform(df)
    asm = stages[0].copy().setHandleInvalid("keep")
    vec = asm.transform(df).where(~vector_has_invalid(asm.getOutputCol()))
    return PipelineModel(stages[1:]).transform(vec) if len(stages) > 1 else vec


def score_messages(messages: DataFrame, model: PipelineModel, schema, value_col: str = "value",
                   label: str | None = LABEL,
                   out_cols: Sequence[str] = (CYCLE_TIME, "prediction"), counters: str | None = None) -> DataFrame:
    """Parse -> flatten -> drop the label -> score -> project. Works on a
    batch frame and on a streaming frame alike (stateless, one map stage).
    ``counters`` names an observation that tells the messages which scoring
    loses (see ``messages.parse_flatten_counted``)."""
    if counters:
        inputs = [f.name for f in schema.fields if f.name != label]
        flat = parse_flatten_counted(messages, schema, counters, inputs, value_col)
    else:
        flat = parse_flatten(messages, schema, value_col)
    if label and label in flat.columns:
        flat = flat.drop(label)
    return score_clean(flat, model).select(*out_cols)
