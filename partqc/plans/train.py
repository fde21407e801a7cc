"""Train-and-evaluate flows built from the operators.

``prepare_balanced`` + ``train_and_score`` are the batch job of the source
application (balance, split, drop incomplete rows, fit assembler + min-max +
forest with class thresholds, score the hold-out) with seeds everywhere and
the confusion matrix as an aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..operators import evaluate, models, prep, sampling
from ..session import materialize


@dataclass
class TrainResult:
    model: PipelineModel
    train: DataFrame
    test: DataFrame
    scored: DataFrame


def prepare_balanced(df: DataFrame, label: str, key: str | Sequence[str], seed: int = 13,
                     exact: bool = True) -> DataFrame:
    """Under-sample the majority class (exactly to the minority size, or by
    the Bernoulli ratio rule)."""
    if exact:
        return sampling.undersample_exact(df, label, key, seed)
    return sampling.undersample_bernoulli(df, label, key, seed)


def train_and_score(balanced: DataFrame, features: Sequence[str], label: str,
                    key: str | Sequence[str], split_seed: int = 42, test_size: float = 0.2,
                    thresholds: Sequence[float] | None = (0.18, 0.82), model_seed: int = 7) -> TrainResult:
    """Split, drop incomplete rows, fit the production pipeline, score the
    hold-out part. The balanced frame is checkpointed once (the split reads
    it several times; re-running the balancing for every read would repeat
    its scans, and the checkpoint survives lost executors)."""
    balanced = materialize(balanced)
    train, test = sampling.split_exact(balanced, key, test_size, split_seed)
    train = prep.drop_incomplete(train, [label, *features])
    test = prep.drop_incomplete(test, [label, *features])
    pipe = models.production_pipeline(features, label, thresholds=thresholds, seed=model_seed)
    model = models.fit(pipe, train)
    scored = models.batch_score(model, test)
    return TrainResult(model, train, test, scored)


def confusion_of(result: TrainResult, label: str) -> DataFrame:
    return evaluate.confusion_matrix(result.scored, label, "prediction")
