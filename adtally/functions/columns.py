"""Column helpers shared by the batch and streaming pipelines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_window(df: DataFrame, duration: str, ts: str = "ts",
                prefix: str = "window") -> DataFrame:
    """Add flat ``{prefix}_start`` / ``{prefix}_end`` of an epoch-aligned
    tumbling window ``[start, end)`` over ``ts`` (one projection)."""
    w = F.window(ts, duration)
    return df.select("*", w.start.alias(f"{prefix}_start"), w.end.alias(f"{prefix}_end"))


def rewindow(df: DataFrame, duration: str, start: str = "window_start",
             prefix: str = "window") -> DataFrame:
    """Put a finer window into the coarser tumbling window that holds its
    start (1-minute flags into 5-minute buckets); replaces the bounds."""
    w = F.window(F.col(start), duration)
    keep = [c for c in df.columns if c not in (f"{prefix}_start", f"{prefix}_end")]
    return df.select(*keep, w.start.alias(f"{prefix}_start"), w.end.alias(f"{prefix}_end"))


def output_window(df: DataFrame, start: str = "window_start", end: str = "window_end") -> DataFrame:
    """Window bounds as wall-clock TIMESTAMP_NTZ at the output edge."""
    return df.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in (start, end) else F.col(c)
                       for c in df.columns])


def zero_if_null(c: Column | str) -> Column:
    """null -> 0 for amounts and counts."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0).cast("long"))


def require_keys(df: DataFrame, cols) -> DataFrame:
    """Rows usable by a query that keys on ``cols`` (the others belong to
    the dead letter, see ``functions.codec.dead_letter``)."""
    cond = None
    for c in cols:
        term = F.col(c).isNotNull()
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df
