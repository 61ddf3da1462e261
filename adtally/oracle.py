"""DuckDB SQL for every registered query: an independent statement of the
expected result, run by the correctness check on the same parquet tables.

The SQL is written from the rules (row_number, plain joins, whole-table
window functions), not from the Spark plans, so it checks them.
"""

from __future__ import annotations

# The ad-event view of ``sources.tables`` (fixed values: epoch 2024-01-01,
# compression 1440, hot clicks k < 50), as CTEs ``fields`` and ``ad``.
_FIELDS = """
fields_base AS (
  SELECT event_id, event_type, user_id,
         make_timestamp(epoch_us(TIMESTAMP '2024-01-01 00:00:00')
           + (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) // 1440) AS ts,
         CAST(props->>'$.k' AS BIGINT) AS k,
         CAST(round(value * 100) AS BIGINT) AS amount
  FROM events WHERE event_type IN ('view', 'click', 'error')
),
fields AS (
  SELECT event_id, event_type, ts, k, amount,
    CASE WHEN event_type = 'view' THEN 'impression' ELSE 'click' END AS kind,
    CAST(100 * (1 + CASE WHEN event_type = 'click' AND k < 50 THEN k % 3 ELSE user_id % 5 END) AS BIGINT) AS partner_id,
    CAST(1 + CASE WHEN event_type = 'click' AND k < 50 THEN k % 2 ELSE (user_id // 5) % 5 END AS BIGINT) AS group_id,
    CAST(1 + CASE WHEN event_type = 'click' AND k < 50 THEN k % 3 ELSE k % 8 END AS BIGINT) AS product_id,
    CASE k % 3 WHEN 0 THEN 'WEB' WHEN 1 THEN 'MOBILE' ELSE 'APP' END AS display_target,
    'display-' || CAST(1 + CASE WHEN event_type = 'click' AND k < 50 THEN k % 3 ELSE k % 10 END AS VARCHAR) AS display_id,
    event_id + CASE WHEN k % 10 = 0 THEN 40 ELSE 0 END AS arrival
  FROM fields_base
),
ad AS (SELECT * FROM fields WHERE event_type IN ('view', 'click'))"""

_CLICKS_1M = """
c1 AS (
  SELECT *, time_bucket(INTERVAL 1 minute, ts) AS ws, COALESCE(amount, 0) AS amt
  FROM ad WHERE kind = 'click'
)"""

# Billing fold: rank per placement-minute.
_BILLING_RANK = _CLICKS_1M + """,
rb AS (
  SELECT *, row_number() OVER (PARTITION BY partner_id, display_target, display_id, product_id, ws
                               ORDER BY ts, event_id) AS rn
  FROM c1
)"""

# Group fold: rank per group-inclusive placement-minute.
_GROUP_RANK = _CLICKS_1M + """,
rg AS (
  SELECT *, row_number() OVER (PARTITION BY partner_id, group_id, display_target, display_id, product_id, ws
                               ORDER BY ts, event_id) AS rn
  FROM c1
),
fold5 AS (
  SELECT partner_id, group_id, display_target, display_id, product_id, ws,
         count(*) AS click_count,
         sum(CASE WHEN rn <= 10 THEN amt ELSE 0 END) AS normal_amount,
         sum(CASE WHEN rn > 10 THEN amt ELSE 0 END) AS fraudulent_amount
  FROM rg GROUP BY ALL
),
flag5 AS (SELECT * FROM fold5 WHERE fraudulent_amount > 0),
fraud5 AS (
  SELECT partner_id, group_id, time_bucket(INTERVAL 5 minute, ws) AS w5,
         count(*) AS fc, sum(fraudulent_amount) AS fa
  FROM flag5 GROUP BY ALL
),
imp5 AS (
  SELECT partner_id, group_id, time_bucket(INTERVAL 5 minute, ts) AS w5, count(*) AS n
  FROM ad WHERE kind = 'impression' GROUP BY ALL
),
clk5 AS (
  SELECT partner_id, group_id, time_bucket(INTERVAL 5 minute, ts) AS w5, count(*) AS n
  FROM ad WHERE kind = 'click' GROUP BY ALL
),
pgm AS (
  SELECT i.partner_id, i.group_id,
         CAST(i.n AS BIGINT) AS impression_count,
         CAST(COALESCE(c.n, 0) AS BIGINT) AS click_count,
         CAST(COALESCE(f.fc, 0) AS BIGINT) AS fraudulent_click_count,
         CAST(COALESCE(f.fa, 0) AS BIGINT) AS fraudulent_amount,
         i.w5 AS window_start, i.w5 + INTERVAL 5 minute AS window_end
  FROM imp5 i
  LEFT JOIN clk5 c ON c.partner_id = i.partner_id AND c.group_id = i.group_id AND c.w5 = i.w5
  LEFT JOIN fraud5 f ON f.partner_id = i.partner_id AND f.group_id = i.group_id AND f.w5 = i.w5
)"""

_BILLING = _BILLING_RANK + """,
billing AS (
  SELECT partner_id,
         CAST(sum(CASE WHEN rn <= 10 THEN amt ELSE 0 END) AS BIGINT) AS aggregated_amount,
         CAST(sum(CASE WHEN rn > 10 THEN amt ELSE 0 END) AS BIGINT) AS fraudulent_amount,
         CAST(sum(CASE WHEN rn <= 10 THEN amt ELSE 0 END) AS BIGINT) AS total_billing_amount,
         ws AS window_start, ws + INTERVAL 1 minute AS window_end
  FROM rb GROUP BY partner_id, ws
)"""

_DISPLAY = """
dlog AS (
  SELECT partner_id, group_id, display_target, display_id, event_id, ts, kind,
         sum(CASE WHEN kind = 'impression' THEN 1 ELSE 0 END) OVER w AS impression_count,
         sum(CASE WHEN kind = 'click' THEN 1 ELSE 0 END) OVER w AS click_count
  FROM ad
  WINDOW w AS (PARTITION BY partner_id, group_id, display_target, display_id
               ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
dtot AS (
  SELECT partner_id, group_id, display_target, display_id,
         CAST(count(*) FILTER (WHERE kind = 'impression') AS BIGINT) AS impression_count,
         CAST(count(*) FILTER (WHERE kind = 'click') AS BIGINT) AS click_count
  FROM ad GROUP BY ALL
)"""

# Kafka-style records derived from events, then decoded.
_RECORDS = """
rec_fields AS (
  SELECT *,
    CASE WHEN event_type = 'error' THEN event_id % 6 END AS defect
  FROM fields
),
rec_json AS (
  SELECT *,
    '{"groupId":' || CAST(group_id AS VARCHAR)
    || ',"partnerId":' || CASE WHEN defect = 4 THEN 'null' ELSE CAST(partner_id AS VARCHAR) END
    || ',"productId":' || CAST(product_id AS VARCHAR)
    || ',"displayTarget":' || CASE WHEN defect = 1 THEN '"TV"'
                                   WHEN defect = 2 THEN '"' || lower(display_target) || '"'
                                   ELSE '"' || display_target || '"' END
    || ',"displayId":"' || display_id || '"'
    || ',"amount":' || CASE WHEN defect = 3 THEN '"abc"'
                            WHEN defect = 5 THEN '"' || CAST(amount AS VARCHAR) || '"'
                            ELSE COALESCE(CAST(amount AS VARCHAR), 'null') END
    || ',"timestamp":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"}' AS v
  FROM rec_fields
),
rec AS (
  SELECT
    CASE WHEN event_type = 'view' THEN 'ad-impressed'
         WHEN event_type = 'click' THEN 'ad-clicked'
         WHEN k % 2 = 0 THEN 'ad-clicked' ELSE 'ad-impressed' END AS topic,
    CAST(event_id % 4 AS INTEGER) AS "partition",
    CAST(event_id // 4 AS BIGINT) AS "offset",
    ts AS "timestamp",
    'ev-' || CAST(event_id AS VARCHAR) AS "key",
    CASE WHEN defect = 0 THEN substring(v, 1, length(v) - 1) ELSE v END AS "value"
  FROM rec_json
),
rec_raw AS (
  SELECT *,
    json_valid("value") AS ok,
    CASE WHEN json_valid("value") THEN "value"->>'$.groupId' END AS r_group,
    CASE WHEN json_valid("value") THEN "value"->>'$.partnerId' END AS r_partner,
    CASE WHEN json_valid("value") THEN "value"->>'$.productId' END AS r_product,
    CASE WHEN json_valid("value") THEN "value"->>'$.displayTarget' END AS r_target,
    CASE WHEN json_valid("value") THEN "value"->>'$.displayId' END AS r_display,
    CASE WHEN json_valid("value") THEN "value"->>'$.amount' END AS r_amount,
    CASE WHEN json_valid("value") THEN "value"->>'$.timestamp' END AS r_ts
  FROM rec
),
dec AS (
  SELECT topic, "partition", "offset", "timestamp", "key", "value",
    CASE topic WHEN 'ad-impressed' THEN 'impression' WHEN 'ad-clicked' THEN 'click' END AS kind,
    TRY_CAST(r_group AS BIGINT) AS group_id,
    TRY_CAST(r_partner AS BIGINT) AS partner_id,
    TRY_CAST(r_product AS BIGINT) AS product_id,
    r_target AS display_target,
    r_display AS display_id,
    TRY_CAST(r_amount AS BIGINT) AS amount,
    TRY_CAST(r_ts AS TIMESTAMP) AS payload_ts,
    CASE
      WHEN "value" IS NULL OR "value" = '' THEN 'empty value'
      WHEN NOT ok THEN 'malformed json'
      WHEN r_target IS NOT NULL AND r_target NOT IN ('WEB', 'MOBILE', 'APP') THEN 'unknown displayTarget'
      WHEN r_group IS NOT NULL AND TRY_CAST(r_group AS BIGINT) IS NULL THEN 'not a number: groupId'
      WHEN r_partner IS NOT NULL AND TRY_CAST(r_partner AS BIGINT) IS NULL THEN 'not a number: partnerId'
      WHEN r_product IS NOT NULL AND TRY_CAST(r_product AS BIGINT) IS NULL THEN 'not a number: productId'
      WHEN r_amount IS NOT NULL AND TRY_CAST(r_amount AS BIGINT) IS NULL THEN 'not a number: amount'
      WHEN r_ts IS NOT NULL AND TRY_CAST(r_ts AS TIMESTAMP) IS NULL THEN 'bad timestamp'
      WHEN r_partner IS NULL THEN 'missing partnerId'
      WHEN topic NOT IN ('ad-impressed', 'ad-clicked') THEN 'unknown topic'
    END AS error_reason
  FROM rec_raw
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join([_FIELDS, *parts]) + "\n"


def _stream_cut(kind_filter: str) -> str:
    """Windows a stream has closed: end <= max event time seen."""
    return f"(SELECT max(ts) FROM ad WHERE {kind_filter})"


def _slower_source() -> str:
    """The smaller of the two sources' largest event times."""
    imp, clk = _stream_cut("kind = 'impression'"), _stream_cut("kind = 'click'")
    return f"least({imp}, {clk})"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["partner_billing"] = _with(_BILLING) + "SELECT * FROM billing"
    q["click_aggregation_1min"] = _with(_BILLING_RANK) + """
SELECT partner_id, display_target, display_id, product_id,
       ws AS window_start, ws + INTERVAL 1 minute AS window_end,
       CAST(count(*) AS BIGINT) AS click_count,
       CAST(sum(CASE WHEN rn <= 10 THEN amt ELSE 0 END) AS BIGINT) AS normal_amount,
       CAST(sum(CASE WHEN rn > 10 THEN amt ELSE 0 END) AS BIGINT) AS fraudulent_amount
FROM rb GROUP BY ALL"""
    q["click_fraud_tagged"] = _with(_BILLING_RANK) + """
SELECT event_id, partner_id, display_target, display_id, product_id, amount,
       ws AS window_start, ws + INTERVAL 1 minute AS window_end, rn > 10 AS is_fraud
FROM rb"""
    q["group_click_aggregation_1min"] = _with(_GROUP_RANK) + """
SELECT partner_id, group_id, display_target, display_id, product_id,
       ws AS window_start, ws + INTERVAL 1 minute AS window_end,
       CAST(click_count AS BIGINT) AS click_count, CAST(normal_amount AS BIGINT) AS normal_amount,
       CAST(fraudulent_amount AS BIGINT) AS fraudulent_amount
FROM fold5"""
    q["fraud_flagged_keys_1min"] = _with(_GROUP_RANK) + """
SELECT partner_id, group_id, display_target, display_id, product_id,
       ws AS window_start, ws + INTERVAL 1 minute AS window_end,
       CAST(click_count AS BIGINT) AS click_count, CAST(normal_amount AS BIGINT) AS normal_amount,
       CAST(fraudulent_amount AS BIGINT) AS fraudulent_amount
FROM flag5"""
    q["group_fraud_5min"] = _with(_GROUP_RANK) + """
SELECT partner_id, group_id, w5 AS window_start, w5 + INTERVAL 5 minute AS window_end,
       CAST(fc AS BIGINT) AS fraudulent_click_count, CAST(fa AS BIGINT) AS fraudulent_amount
FROM fraud5"""
    q["group_impressions_5min"] = _with(_GROUP_RANK) + """
SELECT partner_id, group_id, w5 AS window_start, w5 + INTERVAL 5 minute AS window_end,
       CAST(n AS BIGINT) AS impression_count FROM imp5"""
    q["group_clicks_5min"] = _with(_GROUP_RANK) + """
SELECT partner_id, group_id, w5 AS window_start, w5 + INTERVAL 5 minute AS window_end,
       CAST(n AS BIGINT) AS click_count FROM clk5"""
    q["group_imp_left_join_clicks"] = _with(_GROUP_RANK) + """
SELECT partner_id, group_id, window_start, window_end, impression_count, click_count FROM pgm"""
    q["partner_group_metrics_join"] = _with(_GROUP_RANK) + "SELECT * FROM pgm"
    q["partner_group_metrics"] = _with(_GROUP_RANK) + "SELECT * FROM pgm"
    q["display_impressions_total"] = _with(_DISPLAY) + """
SELECT partner_id, group_id, display_target, display_id, impression_count FROM dtot WHERE impression_count > 0"""
    q["display_clicks_total"] = _with(_DISPLAY) + """
SELECT partner_id, group_id, display_target, display_id, click_count FROM dtot WHERE click_count > 0"""
    q["display_metrics"] = _with(_DISPLAY) + "SELECT * FROM dtot WHERE impression_count > 0"
    q["display_metrics_changelog"] = _with(_DISPLAY) + """
SELECT partner_id, group_id, display_target, display_id, event_id, ts,
       CAST(impression_count AS BIGINT) AS impression_count, CAST(click_count AS BIGINT) AS click_count
FROM dlog WHERE kind = 'impression'"""
    q["display_metrics_asof"] = _with(_DISPLAY) + """
SELECT partner_id, group_id, display_target, display_id,
       CAST(arg_max(impression_count, (ts, event_id)) AS BIGINT) AS impression_count,
       CAST(arg_max(click_count, (ts, event_id)) AS BIGINT) AS click_count
FROM dlog WHERE kind = 'impression' GROUP BY ALL"""
    q["late_click_filter"] = _with("""
lc AS (
  SELECT event_id, arrival, ts, time_bucket(INTERVAL 1 minute, ts) AS window_start,
         max(ts) OVER (PARTITION BY event_id % 4 ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen_max_ts
  FROM ad WHERE kind = 'click'
)""") + """
SELECT event_id, arrival, ts, window_start, window_start + INTERVAL 1 minute AS window_end, seen_max_ts,
       COALESCE(window_start + INTERVAL 1 minute <= seen_max_ts, false) AS is_late
FROM lc"""
    # Sources, decoding, dead letter, encoding.
    for name, topic in (("src_impressions", "ad-impressed"), ("src_clicks", "ad-clicked")):
        q[name] = _with(_RECORDS) + f"""
SELECT "partition", "offset", "timestamp" AS ts, kind, partner_id, group_id, product_id,
       display_target, display_id, amount, payload_ts
FROM dec WHERE error_reason IS NULL AND topic = '{topic}'"""
    q["decode_events_json"] = _with(_RECORDS) + """
SELECT topic, "partition", "offset", "timestamp" AS ts, kind, partner_id, group_id, product_id,
       display_target, display_id, amount, payload_ts, error_reason
FROM dec"""
    q["decode_valid_only"] = _with(_RECORDS) + """
SELECT "partition", "offset", "timestamp" AS ts, kind, partner_id, group_id, product_id,
       display_target, display_id, amount, payload_ts
FROM dec WHERE error_reason IS NULL"""
    q["decode_dead_letter"] = _with(_RECORDS) + """
SELECT topic, "partition", "offset", "timestamp", "key", "value", error_reason
FROM dec WHERE error_reason IS NOT NULL"""
    q["encode_billing_json"] = _with(_BILLING) + """
SELECT CAST(partner_id AS VARCHAR) AS "key",
  '{"partnerId":' || CAST(partner_id AS VARCHAR)
  || ',"aggregatedAmount":' || CAST(aggregated_amount AS VARCHAR)
  || ',"fraudulentAmount":' || CAST(fraudulent_amount AS VARCHAR)
  || ',"totalBillingAmount":' || CAST(total_billing_amount AS VARCHAR)
  || ',"windowStart":"' || strftime(window_start, '%Y-%m-%dT%H:%M:%S')
  || '","windowEnd":"' || strftime(window_end, '%Y-%m-%dT%H:%M:%S') || '"}' AS "value"
FROM billing"""
    # Sinks: what is read back equals what was written.
    q["sink_roundtrip_billing"] = q["partner_billing"]
    q["sink_roundtrip_group"] = q["partner_group_metrics"]
    q["sink_roundtrip_display"] = q["display_metrics"]
    # Streams: the closed windows only.
    q["stream_partner_billing"] = _with(_BILLING) + f"""
SELECT * FROM billing WHERE window_end <= {_stream_cut("kind = 'click'")}"""
    q["stream_group_fraud_5min"] = _with(_GROUP_RANK) + f"""
SELECT partner_id, group_id, w5 AS window_start, w5 + INTERVAL 5 minute AS window_end,
       CAST(fc AS BIGINT) AS fraudulent_click_count, CAST(fa AS BIGINT) AS fraudulent_amount
FROM fraud5 WHERE w5 + INTERVAL 5 minute <= {_stream_cut("kind = 'click'")}"""
    q["stream_partner_group_metrics"] = _with(_GROUP_RANK) + f"""
SELECT * FROM pgm WHERE window_end <= {_slower_source()}"""
    q["stream_billing_restart"] = q["stream_partner_billing"]
    q["stream_display_metrics"] = q["display_metrics"]
    q["stream_display_changelog"] = q["display_metrics_changelog"]
    q["stream_display_restart"] = q["display_metrics_changelog"]
    q["stream_partner_group_metrics_join"] = q["stream_partner_group_metrics"]
    q["stream_late_clicks"] = q["late_click_filter"]
    # The totals after each quarter of the time range, of the displays with an
    # event in that quarter.
    q["stream_display_update_log"] = _with("""
cuts AS (
  SELECT *, (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM ad)) * 4
            // ((SELECT max(epoch_us(ts)) - min(epoch_us(ts)) FROM ad) + 1) AS q
  FROM ad
),
changed AS (SELECT DISTINCT q, partner_id, group_id, display_target, display_id FROM cuts),
totals AS (
  SELECT d.q AS "trigger", d.partner_id, d.group_id, d.display_target, d.display_id,
         CAST(count(*) FILTER (WHERE c.kind = 'impression') AS BIGINT) AS impression_count,
         CAST(count(*) FILTER (WHERE c.kind = 'click') AS BIGINT) AS click_count
  FROM changed d JOIN cuts c ON c.partner_id = d.partner_id AND c.group_id = d.group_id
    AND c.display_target = d.display_target AND c.display_id = d.display_id AND c.q <= d.q
  GROUP BY ALL
)""") + "SELECT * FROM totals WHERE impression_count > 0"
    q["stream_decode_fanout"] = _with(_RECORDS) + """
SELECT topic, "partition", "offset", error_reason,
       CASE WHEN error_reason IS NULL THEN 'good' ELSE 'dead_letter' END AS "output"
FROM dec"""
    q["stream_result_dedup"] = q["encode_billing_json"].replace("FROM billing", ", window_start, window_end\nFROM billing")
    return q
