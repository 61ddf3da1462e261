"""The ordered click fold: first N clicks per key and window are billable,
every later one is fraudulent.

The rule is an ordered fold over the clicks of a key in a window (a counter
that sends each click's amount to "normal" while the counter is <= N and to
"fraudulent" after). Its result only depends on *which* clicks are the first
N under a total order, so it is expressed as

    normal     = sum(amount of the first N rows)   # top-N per group
    fraudulent = sum(amount of all rows) - normal

The top-N side is ``row_number() <= N`` over the group; Catalyst turns it
into a *partial* ``WindowGroupLimit`` that runs before the shuffle, so every
map task ships at most N rows per group. The total side is an ordinary hash
aggregate with map-side partial sums. Neither side ever moves a whole group
into one task, so one key holding a large share of all clicks costs no more
than any other key. Null amounts count as 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT_ORDER, FRAUD_CLICK_LIMIT
from ..functions.columns import with_window, zero_if_null


def _order_cols(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc() for c in order]


def first_n(df: DataFrame, group: Sequence[str], n: int = FRAUD_CLICK_LIMIT,
            order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """Rows ranked 1..n in each group under ``order``.

    Written as ``row_number() <= n`` so the optimizer plans a partial
    group limit below the exchange (see ``explain``: ``WindowGroupLimit
    ... Partial``).
    """
    w = Window.partitionBy(*group).orderBy(*_order_cols(order))
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")


def _split_rows(clicks: DataFrame, fine_key: Sequence[str], window: str, out_key: Sequence[str],
                n: int, order: Sequence[str]) -> DataFrame:
    """Union of (all clicks, first-n clicks) tagged so one aggregate on
    ``out_key + window`` yields total and normal amounts.

    ``out_key`` may be coarser than ``fine_key`` (billing sums the fold of
    every placement straight into its partner).
    """
    c = with_window(clicks, window).withColumn("_amt", zero_if_null("amount"))
    keep = list(dict.fromkeys([*out_key, "window_start", "window_end"]))
    every = c.select(*keep, F.lit(1).cast("long").alias("_n"),
                     F.col("_amt").alias("_all"), F.lit(0).cast("long").alias("_first"))
    head = first_n(c.select(*dict.fromkeys([*fine_key, *out_key, "window_start", "window_end", *order, "_amt"])),
                   [*fine_key, "window_start"], n, order)
    head = head.select(*keep, F.lit(0).cast("long").alias("_n"),
                       F.lit(0).cast("long").alias("_all"), F.col("_amt").alias("_first"))
    return every.unionByName(head)


def click_fold(clicks: DataFrame, key: Sequence[str], window: str = "1 minute",
               n: int = FRAUD_CLICK_LIMIT, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """Per ``key`` and tumbling window: click_count, normal_amount,
    fraudulent_amount (window_start/window_end as TIMESTAMP)."""
    rows = _split_rows(clicks, key, window, key, n, order)
    return (rows.groupBy(*key, "window_start", "window_end")
                .agg(F.sum("_n").alias("click_count"),
                     F.sum("_first").alias("normal_amount"),
                     (F.sum("_all") - F.sum("_first")).alias("fraudulent_amount")))


def click_fold_rollup(clicks: DataFrame, fine_key: Sequence[str], out_key: Sequence[str],
                      window: str = "1 minute", n: int = FRAUD_CLICK_LIMIT,
                      order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """The fold on ``fine_key`` summed up to ``out_key`` in one aggregate:
    normal_amount and fraudulent_amount per ``out_key`` and window.

    Summing the per-placement results is linear, so the two-level
    aggregation of the reference needs one exchange here, not two.
    """
    rows = _split_rows(clicks, fine_key, window, out_key, n, order)
    return (rows.groupBy(*out_key, "window_start", "window_end")
                .agg(F.sum("_first").alias("normal_amount"),
                     (F.sum("_all") - F.sum("_first")).alias("fraudulent_amount")))


def tag_fraud(clicks: DataFrame, key: Sequence[str], window: str = "1 minute",
              n: int = FRAUD_CLICK_LIMIT, order: Sequence[str] = DEFAULT_ORDER) -> DataFrame:
    """Every click with ``is_fraud`` (its rank in key and window is > n).

    The first n clicks of each group come from the partial group limit (at
    most n rows per group and map task cross the network), counted per order
    key. Every click is ranked among the clicks with its own group and order
    key, and is fraudulent when its rank exceeds the number of those among the
    first n. Window and join share the key (group, order key), so a hot group
    is hash-spread over all partitions. Clicks that repeat an order key stay
    one row each, and which of them count as the first is arbitrary.
    """
    c = with_window(clicks, window)
    group = [*key, "window_start"]
    at = [*group, *order]
    head = (first_n(c.select(*at), group, n, order).groupBy(*at).agg(F.count(F.lit(1)).alias("_normal")))
    ranked = c.withColumn("_same", F.row_number().over(Window.partitionBy(*at).orderBy(*_order_cols(order))))
    cond = [ranked[g].eqNullSafe(head[g]) for g in at]
    return (ranked.join(head, cond, "left")
                  .select(*[ranked[x] for x in c.columns],
                          (ranked["_same"] > F.coalesce(head["_normal"], F.lit(0))).alias("is_fraud")))
