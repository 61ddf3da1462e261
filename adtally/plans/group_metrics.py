"""Q2 — partner-group metrics per 5-minute window.

Per (partner, group, 5 minutes): impressions, clicks, the number of
*flagged placement-minutes* and their fraud amount. Three rules matter:

* the fraud key **includes** the group: (partner, group, target, display,
  product) per 1 minute, so the 10-click limit applies per group and the
  fraud here does not reconcile with billing;
* ``fraudulent_click_count`` counts flagged placement-minutes (one each), not
  clicks; a placement-minute is flagged only when its excess amount is
  ``> 0`` (amounts are signed, an excess summing to <= 0 adds nothing);
* only (partner, group, window) with impressions appear: clicks or fraud
  without impressions in that window are not reported.

Two plans are provided. ``partner_group_metrics`` (default) makes one pass
over the union of impressions and clicks: 1-minute placement aggregate, then
5-minute rollup — three exchanges, the last two on aggregated rows only.
``partner_group_metrics_join`` is the literal three-aggregate, two-left-join
form; both give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CLICK, DEFAULT_RULES, IMPRESSION, Rules
from ..functions.columns import output_window, require_keys, rewindow, with_window, zero_if_null
from ..operators.counts import windowed_count
from ..operators.fraud import click_fold, first_n
from ..schemas import GROUP_FRAUD_KEY, GROUP_KEY, PARTNER_GROUP_METRICS_COLUMNS
from ..sources.tables import clicks as only_clicks
from ..sources.tables import impressions as only_impressions

_KEYED = ["partner_id", "group_id", "ts"]


def group_impressions_5min(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-1."""
    imp = require_keys(only_impressions(ad), _KEYED)
    return output_window(windowed_count(imp, GROUP_KEY, rules.group_window, "impression_count"))


def group_clicks_5min(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-2 (counts every click: fraudulent and null-amount ones too)."""
    clk = require_keys(only_clicks(ad), _KEYED)
    return output_window(windowed_count(clk, GROUP_KEY, rules.group_window, "click_count"))


def group_click_aggregation_1min(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-4: the click fold on the group-inclusive placement key."""
    clk = require_keys(only_clicks(ad), _KEYED)
    return output_window(click_fold(clk, GROUP_FRAUD_KEY, rules.billing_window,
                                    rules.fraud_limit, rules.order))


def _flagged(ad: DataFrame, rules: Rules) -> DataFrame:
    clk = require_keys(only_clicks(ad), _KEYED)
    fold = click_fold(clk, GROUP_FRAUD_KEY, rules.billing_window, rules.fraud_limit, rules.order)
    return fold.where(F.col("fraudulent_amount") > 0)


def fraud_flagged_keys_1min(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """FLT-1: placement-minutes whose excess amount is > 0."""
    return output_window(_flagged(ad, rules))


def group_fraud_5min(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """AG-6: flagged placement-minutes re-windowed to 5 minutes."""
    flagged = rewindow(_flagged(ad, rules), rules.group_window)
    out = (flagged.groupBy(*GROUP_KEY, "window_start", "window_end")
                  .agg(F.count(F.lit(1)).alias("fraudulent_click_count"),
                       F.sum("fraudulent_amount").alias("fraudulent_amount")))
    return output_window(out)


def group_imp_left_join_clicks(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """JN-1: impression counts left-joined with click counts on
    (partner, group, window); a missing click count is 0."""
    imp = group_impressions_5min(ad, rules)
    clk = group_clicks_5min(ad, rules)
    on = [*GROUP_KEY, "window_start", "window_end"]
    return (imp.join(clk, on, "left")
               .select(*on, "impression_count", zero_if_null("click_count").alias("click_count")))


def partner_group_metrics_join(ad: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """JN-2: the join plan of Q2."""
    base = group_imp_left_join_clicks(ad, rules)
    fraud = group_fraud_5min(ad, rules)
    on = [*GROUP_KEY, "window_start", "window_end"]
    return (base.join(fraud, on, "left")
                .select(*GROUP_KEY, "impression_count", "click_count",
                        zero_if_null("fraudulent_click_count").alias("fraudulent_click_count"),
                        zero_if_null("fraudulent_amount").alias("fraudulent_amount"),
                        "window_start", "window_end"))


def partner_group_metrics(ad: DataFrame, rules: Rules = DEFAULT_RULES,
                          keep_click_only: bool = False) -> DataFrame:
    """Q2 by the union plan (``PARTNER_GROUP_METRICS_COLUMNS``).

    ``keep_click_only=True`` also reports windows that have clicks but no
    impressions (the reference loses them).
    """
    ev = with_window(require_keys(ad, _KEYED), rules.billing_window)
    is_click = F.col("kind") == CLICK
    every = ev.select(
        *GROUP_FRAUD_KEY, "window_start",
        (F.col("kind") == IMPRESSION).cast("long").alias("_imp"),
        is_click.cast("long").alias("_clk"),
        F.when(is_click, zero_if_null("amount")).otherwise(F.lit(0).cast("long")).alias("_all"),
        F.lit(0).cast("long").alias("_first"),
    )
    clk = ev.where(is_click).withColumn("_amt", zero_if_null("amount"))
    head = first_n(clk.select(*GROUP_FRAUD_KEY, "window_start", *rules.order, "_amt"),
                   [*GROUP_FRAUD_KEY, "window_start"], rules.fraud_limit, rules.order)
    head = head.select(*GROUP_FRAUD_KEY, "window_start",
                       F.lit(0).cast("long").alias("_imp"), F.lit(0).cast("long").alias("_clk"),
                       F.lit(0).cast("long").alias("_all"), F.col("_amt").alias("_first"))
    minute = (every.unionByName(head)
              .groupBy(*GROUP_FRAUD_KEY, "window_start")
              .agg(F.sum("_imp").alias("_imp"), F.sum("_clk").alias("_clk"),
                   (F.sum("_all") - F.sum("_first")).alias("_fraud")))
    five = rewindow(minute, rules.group_window)
    flagged = F.col("_fraud") > 0
    out = (five.groupBy(*GROUP_KEY, "window_start", "window_end")
               .agg(F.sum("_imp").alias("impression_count"),
                    F.sum("_clk").alias("click_count"),
                    F.count_if(flagged).alias("fraudulent_click_count"),
                    F.sum(F.when(flagged, F.col("_fraud")).otherwise(F.lit(0).cast("long")))
                     .alias("fraudulent_amount")))
    if not keep_click_only:
        out = out.where(F.col("impression_count") > 0)
    return output_window(out).select(*PARTNER_GROUP_METRICS_COLUMNS)
