"""Running (prefix) aggregates over an ordered stream of rows, split so no
key is processed in one task.

A running count per key is a prefix sum. Done as one window over the key,
a key holding a large share of all rows would sit in one task. Instead the
ordered rows of a key are cut into contiguous slices (``slice_col``: a time
bucket or an arrival-position bucket):

1. per (key, slice) totals — a hash aggregate with map-side partials;
2. totals of all *earlier* slices of the key — a window over the small
   per-slice table;
3. the running value inside each slice — a window on (key, slice);
4. 1 + 3 joined on (key, slice). Step 3 already hash-partitions the rows on
   (key, slice), so only the small offset table is exchanged for the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sums(df: DataFrame, key: Sequence[str], slice_col: str, order: Sequence[str],
                 measures: dict[str, Column], include_current: bool = True,
                 combine: str = "sum") -> DataFrame:
    """Add for each measure ``name`` the running ``combine`` ("sum" or
    "max") over all rows of the same key that sort before this row under
    (``slice_col``, ``order``) — and the row itself when
    ``include_current``. Nulls mean "nothing before".
    """
    agg = {"sum": F.sum, "max": F.max}[combine]
    part = [*key, slice_col]
    d = df
    for name, expr in measures.items():
        d = d.withColumn(f"_m_{name}", expr)
    per_slice = d.groupBy(*part).agg(*[agg(f"_m_{n}").alias(f"_s_{n}") for n in measures])
    earlier = Window.partitionBy(*key).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(*part, *[agg(f"_s_{n}").over(earlier).alias(f"_o_{n}") for n in measures])
    upto = 0 if include_current else -1
    inside = (Window.partitionBy(*part).orderBy(*[F.col(o).asc() for o in order])
              .rowsBetween(Window.unboundedPreceding, upto))
    local = d
    for n in measures:
        local = local.withColumn(f"_l_{n}", agg(f"_m_{n}").over(inside))
    joined = local.join(offsets, part, "inner")
    for n in measures:
        if combine == "sum":
            val = F.coalesce(F.col(f"_o_{n}"), F.lit(0)) + F.coalesce(F.col(f"_l_{n}"), F.lit(0))
        else:
            val = F.greatest(F.col(f"_o_{n}"), F.col(f"_l_{n}"))
        joined = joined.withColumn(n, val)
    return joined.drop(*[c for n in measures for c in (f"_m_{n}", f"_l_{n}", f"_o_{n}")])
