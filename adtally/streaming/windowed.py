"""The windowed results as streaming plans: chained append-mode aggregates,
JVM-side throughout, nothing folded outside the plan.

1. *Buckets*: per (placement, minute, time bucket, salt) the counts, the amount
   and the first clicks in order. State is cut by a bucket of the event time and
   by a hash of the order key, so an array holds the clicks of one placement in
   one bucket divided by the salts, never a window's.
2. *Placement-minutes*: the buckets' first clicks merged (at most
   ``fraud_limit`` of each, so at most limit x buckets x salts entries), split
   into normal and fraudulent amount.
3. *Result*: partner and minute (billing), or partner, group and five minutes
   (group metrics, group fraud).

Each level groups the window of the level before, so a window's rows of all
levels close in the micro-batch in which the watermark passes its end. A source
has a watermark of its own; the smaller one counts by default. Impressions are
counted per (partner, group), without a placement.

``group_metrics_join_stream`` is the literal form: three windowed aggregates and
two stream-stream left joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CLICK, DEFAULT_RULES, IMPRESSION, STATE_BUCKET, STATE_SALTS, Rules
from ..functions.columns import require_keys, zero_if_null
from ..schemas import BILLING_FRAUD_KEY, GROUP_FRAUD_KEY, GROUP_KEY, PARTNER_BILLING_COLUMNS, PARTNER_GROUP_METRICS_COLUMNS

# Microseconds of each unit of a duration.
UNITS = {"millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}


def micros(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * UNITS[unit.rstrip("s")]


def watermarked(rules: Rules, cols: tuple[str, ...], *streams: DataFrame) -> DataFrame:
    """The streams' usable rows, each with its own watermark, as one."""
    out = None
    for s in streams:
        s = require_keys(s, [*cols, "ts"]).withWatermark("ts", rules.watermark_delay)
        out = s if out is None else out.unionByName(s)
    return out


def click_buckets(ev: DataFrame, key: tuple[str, ...], rules: Rules, salts: int, bucket: str) -> DataFrame:
    """Level 1: (``key``, minute ``_w``, bucket, salt) with ``_imp``, ``_clk``,
    ``_all`` and ``_head``. Impressions keep only partner and group."""
    is_click = F.col("kind") == CLICK
    amount = zero_if_null("amount")
    of_click = [F.when(is_click, F.col(c)).alias(c) for c in key if c not in GROUP_KEY]
    entry = F.struct(*rules.order, amount.alias("_amt"))
    at = F.when(is_click, F.floor(F.unix_micros("ts") / micros(bucket)))
    return (ev.groupBy(*[c for c in key if c in GROUP_KEY], *of_click, F.window("ts", rules.billing_window).alias("_w"),
                       at.alias("_bucket"), F.pmod(F.xxhash64(*rules.order), F.lit(salts)).alias("_salt"))
              .agg(F.count_if(F.col("kind") == IMPRESSION).alias("_imp"), F.count_if(is_click).alias("_clk"),
                   zero_if_null(F.sum(F.when(is_click, amount))).alias("_all"),
                   F.slice(F.sort_array(F.collect_list(F.when(is_click, entry))), 1, rules.fraud_limit).alias("_head")))


def placement_minutes(buckets: DataFrame, key: tuple[str, ...], rules: Rules) -> DataFrame:
    """Level 2: (``key``, minute ``_w``) with the counts, ``_normal`` and ``_fraud``."""
    head = F.slice(F.sort_array(F.flatten(F.collect_list("_head"))), 1, rules.fraud_limit)
    merged = (buckets.groupBy(*key, F.window("_w", rules.billing_window).alias("_w"))
              .agg(F.sum("_imp").alias("_imp"), F.sum("_clk").alias("_clk"), F.sum("_all").alias("_all"), head.alias("_head")))
    normal = F.aggregate("_head", F.lit(0).cast("long"), lambda total, c: total + c["_amt"])
    return (merged.select(*key, "_w", "_imp", "_clk", "_all", normal.alias("_normal"))
            .withColumn("_fraud", F.col("_all") - F.col("_normal")))


def _bounds(df: DataFrame, window: str = "_w") -> list:
    return [F.col(f"{window}.{side}").cast("timestamp_ntz").alias(f"window_{side}") for side in ("start", "end")]


def _minutes(ev: DataFrame, key: tuple[str, ...], rules: Rules, salts: int, bucket: str) -> DataFrame:
    return placement_minutes(click_buckets(ev, key, rules, salts, bucket), key, rules)


def billing_stream(imp: DataFrame, clk: DataFrame, rules: Rules = DEFAULT_RULES, salts: int = STATE_SALTS,
                   bucket: str = STATE_BUCKET) -> DataFrame:
    """Partner billing, from clicks only."""
    minutes = _minutes(watermarked(rules, ("partner_id",), clk), BILLING_FRAUD_KEY, rules, salts, bucket)
    out = (minutes.groupBy("partner_id", F.window("_w", rules.billing_window).alias("_w"))
           .agg(F.sum("_normal").alias("aggregated_amount"), F.sum("_fraud").alias("fraudulent_amount")))
    return (out.select("partner_id", "aggregated_amount", "fraudulent_amount", F.col("aggregated_amount").alias("total_billing_amount"),
                       *_bounds(out)).select(*PARTNER_BILLING_COLUMNS))


def _group_totals(minutes: DataFrame, rules: Rules) -> DataFrame:
    flagged = F.col("_fraud") > 0
    return (minutes.groupBy(*GROUP_KEY, F.window("_w", rules.group_window).alias("_w"))
            .agg(F.sum("_imp").alias("impression_count"), F.sum("_clk").alias("click_count"),
                 F.count_if(flagged).alias("fraudulent_click_count"),
                 zero_if_null(F.sum(F.when(flagged, F.col("_fraud")))).alias("fraudulent_amount")))


def group_metrics_stream(imp: DataFrame, clk: DataFrame, rules: Rules = DEFAULT_RULES, salts: int = STATE_SALTS,
                         bucket: str = STATE_BUCKET, keep_click_only: bool = False) -> DataFrame:
    """Partner-group metrics in one pass over both kinds; a window closes when
    the watermarks of both sources have passed it."""
    out = _group_totals(_minutes(watermarked(rules, GROUP_KEY, imp, clk), GROUP_FRAUD_KEY, rules, salts, bucket), rules)
    if not keep_click_only:
        out = out.where(F.col("impression_count") > 0)
    return out.select("*", *_bounds(out)).select(*PARTNER_GROUP_METRICS_COLUMNS)


def _fraud_windows(clk: DataFrame, rules: Rules, salts: int, bucket: str) -> DataFrame:
    minutes = _minutes(watermarked(rules, GROUP_KEY, clk), GROUP_FRAUD_KEY, rules, salts, bucket).where(F.col("_fraud") > 0)
    return (minutes.groupBy(*GROUP_KEY, F.window("_w", rules.group_window).alias("_w"))
            .agg(F.count(F.lit(1)).alias("fraudulent_click_count"), F.sum("_fraud").alias("fraudulent_amount")))


def group_fraud_stream(imp: DataFrame, clk: DataFrame, rules: Rules = DEFAULT_RULES, salts: int = STATE_SALTS,
                       bucket: str = STATE_BUCKET) -> DataFrame:
    """Flagged placement-minutes per group and five minutes, from clicks only."""
    out = _fraud_windows(clk, rules, salts, bucket)
    return out.select(*GROUP_KEY, *_bounds(out), "fraudulent_click_count", "fraudulent_amount")


def group_metrics_join_stream(imp: DataFrame, clk: DataFrame, rules: Rules = DEFAULT_RULES, salts: int = STATE_SALTS,
                              bucket: str = STATE_BUCKET) -> DataFrame:
    """Partner-group metrics as three windowed aggregates, left-joined on group
    and window: unmatched impression windows come out when the watermark of
    both sides has passed them."""
    def counted(stream: DataFrame, name: str) -> DataFrame:
        return (watermarked(rules, GROUP_KEY, stream).groupBy(*GROUP_KEY, F.window("ts", rules.group_window).alias("_w"))
                .agg(F.count(F.lit(1)).alias(name)))

    on = [*GROUP_KEY, "_w"]
    out = (counted(imp, "impression_count").join(counted(clk, "click_count"), on, "left")
           .join(_fraud_windows(clk, rules, salts, bucket), on, "left"))
    filled = [zero_if_null(c).alias(c) for c in ("click_count", "fraudulent_click_count", "fraudulent_amount")]
    return out.select(*GROUP_KEY, "impression_count", *filled, *_bounds(out)).select(*PARTNER_GROUP_METRICS_COLUMNS)


# result name -> stream builder
WINDOWED_RESULTS: dict[str, Callable] = {
    "partner_billing": billing_stream,
    "partner_group_metrics": group_metrics_stream,
    "partner_group_metrics_join": group_metrics_join_stream,
    "group_fraud_5min": group_fraud_stream,
}
