"""Save and load fitted pipelines."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str, overwrite: bool = True) -> str:
    """Save a fitted pipeline (JSON metadata + parquet data). Plain ``save``
    fails when the path exists; overwrite is the default here."""
    w = model.write()
    if overwrite:
        w = w.overwrite()
    w.save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
