"""Scoring a stream with a model fitted on a table.

A fitted workflow is a projection, so it needs no state and no watermark.
"""

from foldspark.streaming.score import score_stream  # noqa: F401
