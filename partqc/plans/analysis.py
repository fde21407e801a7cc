"""The analysis notebook's flow as one plan.

raw export -> label from the reason text -> drop non-input columns -> drop
incomplete rows -> class counts, correlation -> model comparison (under-
sampling and SMOTE x three classifiers) -> confusion at a 0.5 cut-off of the
logistic model -> prepared CSV and shuffled balanced CSV.

Every step is one of the operators; results are DataFrames (aggregates), and
the two CSV outputs are written by Spark.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import evaluate, prep, profile, sampling
from ..schema import LABEL, RAW_DROP, RAW_DROP_EXTRA
from ..sources import files
from . import compare


@dataclass
class Analysis:
    prepared: DataFrame          # label + readings, complete rows
    class_counts: DataFrame
    class_share: DataFrame
    summary: DataFrame           # count, mean, std, min, quartiles, max per reading
    correlation: DataFrame
    comparison: DataFrame        # sampling, model, accuracy, precision, recall, auc
    roc: DataFrame               # sampling, model, threshold, fpr, tpr
    confusion: DataFrame         # sampling, model, actual, predicted, count
    cutoff_confusion: DataFrame  # logistic model on the SMOTE training part, p1 >= cut-off


def prepare_raw(raw: DataFrame, label: str = LABEL, text_col: str = LABEL,
                drop: Sequence[str] = tuple(RAW_DROP + RAW_DROP_EXTRA)) -> DataFrame:
    """P9/P10 + P1 + P12: label from the reason text, machine-state columns
    dropped (absent names ignored), rows with a null or NaN dropped."""
    labelled = prep.derive_label(raw, text_col, label)
    return prep.drop_incomplete(prep.drop_columns(labelled, list(drop)))


def analyse(prepared: DataFrame, key: str, features: Sequence[str], label: str = LABEL,
            cutoff: float = 0.5) -> Analysis:
    counts = profile.class_counts(prepared, label)
    corr = profile.correlation_matrix(prepared, [label, *features])
    both = compare.compare_all(prepared, label, key, list(features))
    cut = evaluate.threshold_sweep(both.scored["smote", "logistic"], label, "p1", [cutoff])
    return Analysis(prepared, counts, profile.class_share(prepared, label),
                    profile.describe_columns(prepared, list(features)), corr, both.metrics, both.roc, both.confusion,
                    cut.drop("cutoff"))


def write_outputs(prepared: DataFrame, key: str, label: str, prepared_path: str, balanced_path: str,
                  seed: int = 13, shuffle_seed: int = 7) -> tuple[str, str]:
    """S2 + R2 + R6: the prepared table, and the exactly balanced table in a
    repeatable shuffled order (its position kept as a column)."""
    files.write_csv(prepared, prepared_path)
    balanced = sampling.undersample_exact(prepared, label, key, seed)
    files.write_csv(sampling.shuffle_rows(balanced, key, shuffle_seed), balanced_path)
    return prepared_path, balanced_path
