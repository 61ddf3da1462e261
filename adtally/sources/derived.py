"""Kafka-style records derived from the given ``events`` table, so that the
decode and dead-letter path runs on given data.

``view`` rows go to the impressions topic, ``click`` rows to the clicks topic,
and ``error`` rows become *defective* records on either topic (broken JSON,
unknown display target, wrong case, non-numeric amount, missing partner id, or
a quoted amount, which is valid). Used by the registered queries and tests
only; jobs read ``sources.topics`` or record files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import TOPIC_CLICKED, TOPIC_IMPRESSED
from .tables import ad_fields

# Fixed values of the derived envelope.
DERIVED_PARTITIONS = 4
# Defects of ``error`` rows, chosen by event_id % 6, in this order.
DEFECTS = ("truncated", "target_tv", "target_lowercase", "amount_text", "partner_null", "amount_quoted")


def _json_sql(partner: str, target: str, amount: str) -> str:
    """The event payload as JSON text (SQL), fields in the published order.
    ``partner``, ``target`` and ``amount`` are SQL expressions yielding the
    JSON literal of that field."""
    return ("concat('{\"groupId\":', coalesce(CAST(group_id AS STRING), 'null'), "
            f"',\"partnerId\":', {partner}, "
            "',\"productId\":', coalesce(CAST(product_id AS STRING), 'null'), "
            f"',\"displayTarget\":', {target}, "
            "',\"displayId\":\"', display_id, '\"', "
            f"',\"amount\":', {amount}, "
            "',\"timestamp\":\"', date_format(ts, 'yyyy-MM-dd\\'T\\'HH:mm:ss.SSSSSS'), '\"}')")


def topic_records(events: DataFrame) -> DataFrame:
    """Kafka-style records (topic, partition, offset, timestamp, key, value)
    derived from ``events``; one narrow stage, projections written as SQL
    expressions."""
    f = ad_fields(events.where(F.col("event_type").isin("view", "click", "error")))
    defect = f"IF(event_type = 'error', event_id % {len(DEFECTS)}, NULL)"
    partner = "IF(_defect = 4, 'null', coalesce(CAST(partner_id AS STRING), 'null'))"
    target = ("CASE WHEN _defect = 1 THEN '\"TV\"' "
              "WHEN _defect = 2 THEN concat('\"', lower(display_target), '\"') "
              "ELSE concat('\"', display_target, '\"') END")
    amount = ("CASE WHEN _defect = 3 THEN '\"abc\"' "
              "WHEN _defect = 5 THEN concat('\"', CAST(amount AS STRING), '\"') "
              "ELSE coalesce(CAST(amount AS STRING), 'null') END")
    topic = (f"CASE WHEN event_type = 'view' THEN '{TOPIC_IMPRESSED}' "
             f"WHEN event_type = 'click' THEN '{TOPIC_CLICKED}' "
             f"WHEN k % 2 = 0 THEN '{TOPIC_CLICKED}' ELSE '{TOPIC_IMPRESSED}' END")
    staged = (f.selectExpr("*", f"{defect} AS _defect")
               .selectExpr("*", f"{_json_sql(partner, target, amount)} AS _v"))
    return staged.selectExpr(
        f"{topic} AS topic",
        f"CAST(event_id % {DERIVED_PARTITIONS} AS INT) AS partition",
        f"CAST(event_id div {DERIVED_PARTITIONS} AS BIGINT) AS offset",
        "ts AS timestamp",
        "concat('ev-', CAST(event_id AS STRING)) AS key",
        "IF(_defect = 0, substring(_v, 1, length(_v) - 1), _v) AS value",
    )
