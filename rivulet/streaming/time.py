"""Event time of streams."""

from __future__ import annotations

from pyspark.sql import DataFrame

# How far readings may be out of order, and how late they may be for a window.
DISORDER = "60 seconds"
LATENESS = "3 minutes"


def with_event_time(df: DataFrame, delay: str = DISORDER, column: str = "timestamp") -> DataFrame:
    """Declare ``column`` as event time with bounded disorder."""
    return df.withWatermark(column, delay)
