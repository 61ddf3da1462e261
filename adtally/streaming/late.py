"""The per-record late rule on a stream: a click is late when its window had
ended before the largest event time that arrived before it in its source
partition. The largest time of the earlier micro-batches is carried in the
state store; inside a micro-batch the batch rule decides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT_RULES, Rules
from ..operators.late import late_flags
from .carry import carry


def late_stream(clicks: DataFrame, partition: str = "partition") -> DataFrame:
    """``clicks`` with ``_seen``: the largest event time (microseconds) of its
    source partition in the micro-batches before."""
    return carry(clicks, [partition], {"_seen": ("max", F.unix_micros("ts"))})


def late_rows(batch: DataFrame, rules: Rules = DEFAULT_RULES, arrival: tuple[str, ...] = ("arrival", "event_id"),
              partition: str = "partition") -> DataFrame:
    """A micro-batch of ``late_stream`` with window bounds, ``seen_max_ts`` and
    ``is_late``, as ``operators.late.late_flags`` gives them for all rows."""
    out = late_flags(batch, rules.billing_window, arrival, (partition,))
    seen = F.greatest("seen_max_ts", F.timestamp_micros("_seen"))
    return (out.withColumn("seen_max_ts", seen).drop("_seen")
               .withColumn("is_late", F.coalesce(F.col("window_end") <= F.col("seen_max_ts"), F.lit(False))))
