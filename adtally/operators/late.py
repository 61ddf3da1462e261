"""Exact per-record late rule of a no-grace tumbling window, for batch.

A record is late when the end of its window is at or before the largest
event time among the records that arrived *before* it in the same source
partition. Arrival order is a column (Kafka offset; for the tables a
derived position). The running maximum is computed with
``operators.running.running_sums`` on arrival-position slices, so a single
huge partition is still split over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_window
from .running import running_sums

# Arrival positions per slice of the running maximum. Bounds both the rows
# of one window task (<= this many) and the per-slice offset table (one row
# per slice of a source partition, i.e. rows / 2^20).
ARRIVAL_SLICE_ROWS = 1 << 20


def late_flags(df: DataFrame, window: str = "1 minute", arrival: Sequence[str] = ("arrival", "event_id"),
               partition_cols: Sequence[str] = (), slice_rows: int = ARRIVAL_SLICE_ROWS,
               ts: str = "ts") -> DataFrame:
    """``df`` with window bounds, ``seen_max_ts`` and ``is_late``."""
    d = with_window(df, window, ts).withColumn("_aslice", F.floor(F.col(arrival[0]) / slice_rows))
    run = running_sums(d, list(partition_cols), "_aslice", arrival,
                       {"seen_max_ts": F.col(ts)}, include_current=False, combine="max")
    return (run.drop("_aslice")
               .withColumn("is_late", F.coalesce(F.col("window_end") <= F.col("seen_max_ts"), F.lit(False))))
