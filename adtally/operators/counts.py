"""Windowed and running counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_window


def windowed_count(df: DataFrame, key: Sequence[str], window: str, name: str) -> DataFrame:
    """Rows per key and tumbling window (hash aggregate, map-side partial)."""
    return (with_window(df, window)
            .groupBy(*key, "window_start", "window_end")
            .agg(F.count(F.lit(1)).alias(name)))


def total_count(df: DataFrame, key: Sequence[str], name: str) -> DataFrame:
    """Rows per key over all time (no window)."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias(name))
