"""Registry of the queries: name -> function(spark, sf_dir) -> DataFrame.

Each batch query reads the whole given tables. Names follow the operator
inventory; the matching DuckDB SQL is in ``adtally.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import CLICK, DEFAULT_RULES, IMPRESSION
from .functions import codec
from .operators.late import late_flags
from .plans import billing, display_metrics, group_metrics
from .sinks.files import roundtrip
from .sources.derived import DERIVED_PARTITIONS, topic_records
from .sources.tables import ad_events, load_ad_events, load_events, spread

Query = Callable[[SparkSession, str], DataFrame]


def _on_ad(fn, kind: str | None = None) -> Query:
    """A plan over the ad-event view, restricted to one kind where it uses no other."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(load_ad_events(spark, sf_dir, kind), DEFAULT_RULES)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records derived from ``events`` and decoded (good and bad rows). The
    table is one file with one row group, so it is dealt over all cores."""
    events = spread(load_events(spark, sf_dir), spark.sparkContext.defaultParallelism)
    return codec.decode_records(topic_records(events))


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


def src_impressions(spark, sf_dir):
    v = codec.valid_events(decoded(spark, sf_dir))
    return _ntz(v.where(F.col("kind") == "impression"), "ts", "payload_ts")


def src_clicks(spark, sf_dir):
    v = codec.valid_events(decoded(spark, sf_dir))
    return _ntz(v.where(F.col("kind") == "click"), "ts", "payload_ts")


def decode_events_json(spark, sf_dir):
    d = decoded(spark, sf_dir)
    return _ntz(d.select("topic", "partition", "offset", "ts", "kind", "partner_id", "group_id",
                         "product_id", "display_target", "display_id", "amount", "payload_ts",
                         "error_reason"), "ts", "payload_ts")


def decode_valid_only(spark, sf_dir):
    return _ntz(codec.valid_events(decoded(spark, sf_dir)), "ts", "payload_ts")


def decode_dead_letter(spark, sf_dir):
    return _ntz(codec.dead_letter(decoded(spark, sf_dir)), "timestamp")


def encode_billing_json(spark, sf_dir):
    rows = billing.partner_billing(load_ad_events(spark, sf_dir, CLICK))
    return codec.encode_records(rows, ["partner_id"], codec.BILLING_JSON_FIELDS)


def late_click_filter(spark, sf_dir):
    c = ad_events(load_events(spark, sf_dir), with_arrival=True, kind=CLICK)
    c = c.withColumn("partition", F.col("event_id") % DERIVED_PARTITIONS)
    out = late_flags(c, DEFAULT_RULES.billing_window, ("arrival", "event_id"), ("partition",))
    return _ntz(out.select("event_id", "arrival", "ts", "window_start", "window_end",
                           "seen_max_ts", "is_late"),
                "ts", "window_start", "window_end", "seen_max_ts")


def sink_roundtrip_billing(spark, sf_dir):
    return roundtrip(spark, billing.partner_billing(load_ad_events(spark, sf_dir, CLICK)), "billing")


def sink_roundtrip_group(spark, sf_dir):
    return roundtrip(spark, group_metrics.partner_group_metrics(load_ad_events(spark, sf_dir)), "group")


def sink_roundtrip_display(spark, sf_dir):
    return roundtrip(spark, display_metrics.display_metrics(load_ad_events(spark, sf_dir)), "display")


def queries() -> dict[str, Query]:
    from .streaming import queries as streams
    q: dict[str, Query] = {
        "partner_billing": _on_ad(billing.partner_billing, CLICK),
        "click_aggregation_1min": _on_ad(billing.click_aggregation_1min, CLICK),
        "click_fraud_tagged": _on_ad(billing.click_fraud_tagged, CLICK),
        "group_click_aggregation_1min": _on_ad(group_metrics.group_click_aggregation_1min, CLICK),
        "fraud_flagged_keys_1min": _on_ad(group_metrics.fraud_flagged_keys_1min, CLICK),
        "group_fraud_5min": _on_ad(group_metrics.group_fraud_5min, CLICK),
        "group_impressions_5min": _on_ad(group_metrics.group_impressions_5min, IMPRESSION),
        "group_clicks_5min": _on_ad(group_metrics.group_clicks_5min, CLICK),
        "group_imp_left_join_clicks": _on_ad(group_metrics.group_imp_left_join_clicks),
        "partner_group_metrics_join": _on_ad(group_metrics.partner_group_metrics_join),
        "partner_group_metrics": _on_ad(group_metrics.partner_group_metrics),
        "display_impressions_total": _on_ad(display_metrics.display_impressions_total, IMPRESSION),
        "display_clicks_total": _on_ad(display_metrics.display_clicks_total, CLICK),
        "display_metrics": _on_ad(display_metrics.display_metrics),
        "display_metrics_changelog": _on_ad(display_metrics.display_metrics_changelog),
        "display_metrics_asof": _on_ad(display_metrics.display_metrics_asof),
        "late_click_filter": late_click_filter,
        "src_impressions": src_impressions,
        "src_clicks": src_clicks,
        "decode_events_json": decode_events_json,
        "decode_valid_only": decode_valid_only,
        "decode_dead_letter": decode_dead_letter,
        "encode_billing_json": encode_billing_json,
        "sink_roundtrip_billing": sink_roundtrip_billing,
        "sink_roundtrip_group": sink_roundtrip_group,
        "sink_roundtrip_display": sink_roundtrip_display,
    }
    for run in streams.STREAMS:
        q[run.__name__] = run
    return q
