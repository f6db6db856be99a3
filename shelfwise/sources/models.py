"""Saved models."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
