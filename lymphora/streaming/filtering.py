"""FIL1 on a stream: the conditions are stateless, so the batch filter serves unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.filters import quality_filter


def filtered_stream(rows: DataFrame, **limits: float) -> DataFrame:
    if not rows.isStreaming:
        raise ValueError("not a stream")
    return quality_filter(rows, **limits)
