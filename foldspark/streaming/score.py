"""Predictions for rows as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame

from foldspark.plans.workflow import FittedWorkflow


def score_stream(fitted: FittedWorkflow, stream: DataFrame, kind: str = "numeric") -> DataFrame:
    """Append predictions to a streaming frame."""
    if not stream.isStreaming:
        raise ValueError("score_stream needs a streaming frame; use predict on a table")
    return fitted.predict(stream, kind)
