"""Schemas of the ad events and of the three results.

Impression and click events share one schema. The JSON payload is decoded
with every field as STRING first (see ``functions.codec``) so that quoted
numbers are accepted and a wrong value is reported instead of silently
becoming null.
"""

from pyspark.sql import types as T

# JSON field name of the published event -> typed column name.
JSON_FIELDS = (
    ("groupId", "group_id"),
    ("partnerId", "partner_id"),
    ("productId", "product_id"),
    ("displayTarget", "display_target"),
    ("displayId", "display_id"),
    ("amount", "amount"),
    ("timestamp", "payload_ts"),
)

# Payload as text: every field is read as its raw JSON text.
RAW_PAYLOAD_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType(), True) for name, _ in JSON_FIELDS]
    + [T.StructField("_corrupt", T.StringType(), True)]
)

# Typed ad event: the common currency of every pipeline function.
AD_EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampType(), True),
    T.StructField("kind", T.StringType(), True),
    T.StructField("partner_id", T.LongType(), True),
    T.StructField("group_id", T.LongType(), True),
    T.StructField("product_id", T.LongType(), True),
    T.StructField("display_target", T.StringType(), True),
    T.StructField("display_id", T.StringType(), True),
    T.StructField("amount", T.LongType(), True),
])

# The given ``events`` table (declared, never inferred).
EVENTS_TABLE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType(), True),
    T.StructField("ts", T.TimestampNTZType(), True),
    T.StructField("user_id", T.LongType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("props", T.StringType(), True),
])

# Kafka-style record envelope (the columns Spark's Kafka source provides,
# with key and value already as text).
RAW_RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

PARTNER_BILLING_COLUMNS = (
    "partner_id", "aggregated_amount", "fraudulent_amount",
    "total_billing_amount", "window_start", "window_end",
)
PARTNER_GROUP_METRICS_COLUMNS = (
    "partner_id", "group_id", "impression_count", "click_count",
    "fraudulent_click_count", "fraudulent_amount", "window_start", "window_end",
)
DISPLAY_METRICS_COLUMNS = (
    "partner_id", "group_id", "display_target", "display_id",
    "impression_count", "click_count",
)

# Key columns a good event needs to be used by each result.
RESULT_KEYS = {
    "partner_billing": ("partner_id", "ts"),
    "partner_group_metrics": ("partner_id", "group_id", "ts"),
    "display_metrics": ("partner_id", "group_id", "display_target"),
}

# Key columns of each grouping.
BILLING_FRAUD_KEY = ("partner_id", "display_target", "display_id", "product_id")
GROUP_FRAUD_KEY = ("partner_id", "group_id", "display_target", "display_id", "product_id")
GROUP_KEY = ("partner_id", "group_id")
DISPLAY_KEY = ("partner_id", "group_id", "display_target", "display_id")
