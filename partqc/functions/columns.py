"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import GOOD_REASON_TEXT


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_from_text(text: str | Column, good_text: str = GOOD_REASON_TEXT) -> Column:
    """0 for the good-part marker, 1 for any other text, and 1 for a missing
    value (a missing reason is not a known-good part)."""
    return F.when(as_col(text) == F.lit(good_text), F.lit(0)).otherwise(F.lit(1)).cast("int")


def cutoff_class(prob: str | Column, cutoff: float = 0.5) -> Column:
    """Class 1 when the score reaches the inclusive cut-off, else 0."""
    return (as_col(prob) >= F.lit(float(cutoff))).cast("int")


def class_probability(prob_vec: str | Column = "probability", cls: int = 1) -> Column:
    """Probability of one class from an ML probability vector."""
    return vector_to_array(as_col(prob_vec)).getItem(cls)


def ratio_class(probs: Column, thresholds: Sequence[float]) -> Column:
    """Class chosen by per-class thresholds: the argmax of ``p_i / t_i``, first
    class on ties (the rule behind ``setThresholds``). ``probs`` is an array
    column of class probabilities. A zero threshold wins whenever p_i > 0."""
    ts = [float(t) for t in thresholds]
    scaled = F.array(*[
        (F.when(probs.getItem(i) > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
         if t == 0 else probs.getItem(i) / F.lit(t))
        for i, t in enumerate(ts)
    ])
    return (F.array_position(scaled, F.array_max(scaled)) - 1).cast("double")


def binary_ratio_class(p1: str | Column, thresholds: Sequence[float]) -> Column:
    """Two-class form of :func:`ratio_class` from the class-1 probability."""
    p1c = as_col(p1)
    t0, t1 = float(thresholds[0]), float(thresholds[1])
    return F.when(p1c / F.lit(t1) > (F.lit(1.0) - p1c) / F.lit(t0), 1.0).otherwise(0.0)


def vector_has_invalid(vec: str | Column) -> Column:
    """True when an ML vector holds a NaN (what ``handleInvalid='keep'`` puts
    in place of nulls and NaN)."""
    return F.exists(vector_to_array(as_col(vec)), lambda x: F.isnan(x))


def round6(c: str | Column) -> Column:
    return F.round(as_col(c), 6)
