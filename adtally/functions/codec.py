"""JSON decode with a dead letter, and JSON encode of results.

Decoding reads every payload field as its raw JSON text and casts it
afterwards, so that

* a quoted number (``"amount":"1000"``) is accepted, as a lenient JSON
  mapper does;
* a value that is present but unusable (``"abc"`` as amount, ``TV`` or
  ``web`` as display target, a bad timestamp, broken JSON) is reported
  with a reason instead of turning silently into null;
* a missing or null amount is 0 downstream; a null partner id is an error
  for every result;
* numbers must be integral (``10.5`` is reported, not truncated).

Good and bad rows come out of the same projection; ``valid_events`` and
``dead_letter`` are two filters on it, so one scan feeds both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLICK, DISPLAY_TARGETS, IMPRESSION, Topics
from ..schemas import RAW_PAYLOAD_SCHEMA, RESULT_KEYS

_NUMERIC = ("groupId", "partnerId", "productId", "amount")
# Reasons, in the order they are checked.
REASON_EMPTY = "empty value"
REASON_MALFORMED = "malformed json"
REASON_TARGET = "unknown displayTarget"
REASON_NUMBER = "not a number: "
REASON_TIMESTAMP = "bad timestamp"
REASON_PARTNER = "missing partnerId"
REASON_TOPIC = "unknown topic"
REASON_TIME = "missing event time"
REASON_KEY = "missing key: "


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _reason_sql(topics: Topics, event_ts: str) -> str:
    """First failed check of a record, as one SQL CASE over ``_raw``."""
    targets = ", ".join(f"'{t}'" for t in DISPLAY_TARGETS)
    checks = [
        ("value IS NULL OR value = ''", REASON_EMPTY),
        ("_raw._corrupt IS NOT NULL", REASON_MALFORMED),
        (f"_raw.displayTarget IS NOT NULL AND _raw.displayTarget NOT IN ({targets})", REASON_TARGET),
    ]
    checks += [(f"_raw.{f} IS NOT NULL AND try_cast(_raw.{f} AS BIGINT) IS NULL", REASON_NUMBER + f)
               for f in _NUMERIC]
    checks += [
        ("_raw.timestamp IS NOT NULL AND try_to_timestamp(_raw.timestamp) IS NULL", REASON_TIMESTAMP),
        ("_raw.partnerId IS NULL", REASON_PARTNER),
        (f"topic IS NULL OR topic NOT IN ({_text(topics.impressed)}, {_text(topics.clicked)})", REASON_TOPIC),
        (f"{event_ts} IS NULL", REASON_TIME),
    ]
    return "CASE " + " ".join(f"WHEN {cond} THEN '{why}'" for cond, why in checks) + " END"


def decode_records(records: DataFrame, event_time: str = "record", topics: Topics = Topics()) -> DataFrame:
    """Decode Kafka-style records into typed ad events plus ``error_reason``
    (null for a good row).

    ``event_time`` = ``"record"`` uses the record timestamp (Kafka's default
    event time), ``"payload"`` the payload's ``timestamp`` field; a record
    without that time is bad. ``topics`` names the two source topics.
    Keeps topic, partition, offset, key and value for the dead letter.
    """
    raw = F.from_json("value", RAW_PAYLOAD_SCHEMA,
                      {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    # The payload struct is produced by a one-element explode: a Generate
    # node is a barrier for predicate pushdown, so a later filter on
    # ``error_reason`` is not rewritten into the scan side with the
    # ``from_json`` call copied into every field check (the JSON is parsed
    # once per record, not once per reference).
    staged = records.select("*", F.explode(F.array(raw)).alias("_raw"))
    event_ts = "timestamp" if event_time == "record" else "try_to_timestamp(_raw.timestamp)"
    return staged.selectExpr(
        "topic", "partition", "offset", "timestamp", "key", "value",
        f"CASE topic WHEN {_text(topics.impressed)} THEN '{IMPRESSION}' WHEN {_text(topics.clicked)} THEN '{CLICK}' END AS kind",
        "try_cast(_raw.groupId AS BIGINT) AS group_id",
        "try_cast(_raw.partnerId AS BIGINT) AS partner_id",
        "try_cast(_raw.productId AS BIGINT) AS product_id",
        "_raw.displayTarget AS display_target",
        "_raw.displayId AS display_id",
        "try_cast(_raw.amount AS BIGINT) AS amount",
        "try_to_timestamp(_raw.timestamp) AS payload_ts",
        f"{_reason_sql(topics, event_ts)} AS error_reason",
        f"{event_ts} AS ts",
    )


def valid_events(decoded: DataFrame, envelope: bool = False) -> DataFrame:
    """Good rows as typed ad events. ``envelope`` adds the topic, whose name
    with partition and offset orders records of one event time."""
    return (decoded.where(F.col("error_reason").isNull())
                   .select(*(["topic"] if envelope else []), "partition", "offset", "ts", "kind", "partner_id",
                           "group_id", "product_id", "display_target", "display_id", "amount", "payload_ts"))


def unusable_for(result: str) -> Column:
    """Whether a good row lacks a key of ``result`` (which then skips it)."""
    missing = F.lit(False)
    for k in RESULT_KEYS[result]:
        missing = missing | F.col(k).isNull()
    return missing


def dead_letter(decoded: DataFrame) -> DataFrame:
    """Rows that some result can't use, with their raw record and reason: bad
    rows, which no result uses, and good rows without a key of some result,
    where the reason names the results that skip the row."""
    skipped = F.concat_ws("; ", *[
        F.when(F.col(k).isNull(), F.lit(f"{REASON_KEY}{k} ({', '.join(r for r, ks in RESULT_KEYS.items() if k in ks)})"))
        for k in dict.fromkeys(k for ks in RESULT_KEYS.values() for k in ks)])
    reason = F.coalesce("error_reason", F.when(skipped != "", skipped))
    return (decoded.withColumn("error_reason", reason).where(F.col("error_reason").isNotNull())
                   .select("topic", "partition", "offset", "timestamp", "key", "value", "error_reason"))


def json_value(df: DataFrame, fields: Sequence[tuple[str, str]]) -> Column:
    """``to_json`` of the given (json name, column) pairs, with date-times
    as ISO-8601 text (``2024-01-01T12:00:00``)."""
    st = F.struct(*[F.col(col).alias(name) for name, col in fields])
    return F.to_json(st, {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
                          "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss"})


def encode_records(df: DataFrame, key_cols: Sequence[str], fields: Sequence[tuple[str, str]],
                   keep: Sequence[str] = ()) -> DataFrame:
    """(key, value) text records for a Kafka or file sink: key is the
    ``:``-joined key columns, value the JSON payload; ``keep`` names columns
    of ``df`` that go along (headers)."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in key_cols])
    return df.select(key.alias("key"), json_value(df, fields).alias("value"), *keep)


BILLING_JSON_FIELDS = (
    ("partnerId", "partner_id"), ("aggregatedAmount", "aggregated_amount"),
    ("fraudulentAmount", "fraudulent_amount"), ("totalBillingAmount", "total_billing_amount"),
    ("windowStart", "window_start"), ("windowEnd", "window_end"),
)
GROUP_JSON_FIELDS = (
    ("partnerId", "partner_id"), ("groupId", "group_id"), ("impressionCount", "impression_count"),
    ("clickCount", "click_count"), ("fraudulentClickCount", "fraudulent_click_count"),
    ("fraudulentAmount", "fraudulent_amount"), ("windowStart", "window_start"), ("windowEnd", "window_end"),
)
DISPLAY_JSON_FIELDS = (
    ("partnerId", "partner_id"), ("groupId", "group_id"), ("displayTarget", "display_target"),
    ("displayId", "display_id"), ("impressionCount", "impression_count"), ("clickCount", "click_count"),
)
STREAM_DISPLAY_JSON_FIELDS = DISPLAY_JSON_FIELDS + (("emittedAt", "emitted_at"),)
