"""Bad-input tests: nothing stops the job, bad rows reach the dead letter
with a reason, good rows are unaffected (F15, F16, F17, F22)."""

from __future__ import annotations

import datetime as dt

from adtally.functions import codec
from adtally.plans.billing import partner_billing
from adtally.schemas import RAW_RECORD_SCHEMA

TS = dt.datetime(2024, 1, 1, 12, 0, 0)
GOOD = ('{"groupId":1,"partnerId":100,"productId":1,"displayTarget":"WEB","displayId":"display-1",'
        '"amount":1000,"timestamp":"2024-01-01T12:00:00"}')


def records(spark, values, topic="ad-clicked"):
    rows = [(topic, 0, i, TS, f"k{i}", v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, RAW_RECORD_SCHEMA)


def reasons(spark, values, topic="ad-clicked"):
    d = codec.decode_records(records(spark, values, topic))
    return [r.error_reason for r in d.orderBy("offset").collect()]


def test_f15_malformed_and_wrong_values(spark):
    values = [
        GOOD,
        '{"groupId":1,"partnerId":',
        GOOD.replace('"WEB"', '"TV"'),
        GOOD.replace('"WEB"', '"web"'),
        GOOD.replace('"amount":1000', '"amount":"abc"'),
        GOOD.replace('"2024-01-01T12:00:00"', '"yesterday"'),
        None,
        "",
        GOOD.replace('"amount":1000', '"amount":10.5'),
    ]
    assert reasons(spark, values) == [
        None, codec.REASON_MALFORMED, codec.REASON_TARGET, codec.REASON_TARGET,
        codec.REASON_NUMBER + "amount", codec.REASON_TIMESTAMP, codec.REASON_EMPTY,
        codec.REASON_EMPTY, codec.REASON_NUMBER + "amount",
    ]


def test_f16_null_partner_is_dead_letter(spark):
    assert reasons(spark, [GOOD.replace('"partnerId":100', '"partnerId":null')]) == [codec.REASON_PARTNER]


def test_null_key_reaches_dead_letter_per_result(spark):
    """Per result, rows used + rows dead-lettered = records (E3)."""
    values = [GOOD, GOOD.replace('"groupId":1', '"groupId":null'), GOOD.replace('"WEB"', "null"), "{"]
    d = codec.decode_records(records(spark, values))
    dead = {r.value: r.error_reason for r in codec.dead_letter(d).collect()}
    assert dead == {values[1]: "missing key: group_id (partner_group_metrics, display_metrics)",
                    values[2]: "missing key: display_target (display_metrics)", "{": codec.REASON_MALFORMED}
    good = codec.valid_events(d)
    for result, used in (("partner_billing", 3), ("partner_group_metrics", 2), ("display_metrics", 1)):
        assert good.where(~codec.unusable_for(result)).count() == used
        named = sum(codec.REASON_KEY not in why or result in why for why in dead.values())
        assert used + named == len(values)


def test_missing_event_time_is_dead_letter(spark):
    bare = GOOD.replace(',"timestamp":"2024-01-01T12:00:00"', "")
    d = codec.decode_records(records(spark, [GOOD, bare]), event_time="payload")
    assert [r.error_reason for r in d.orderBy("offset").collect()] == [None, codec.REASON_TIME]


def test_renamed_topics(spark):
    from adtally.config import Topics
    named = Topics(impressed="prod-seen", clicked="prod-click's")
    rows = records(spark, [GOOD], "prod-seen").union(records(spark, [GOOD], "prod-click's")).union(records(spark, [GOOD], "ad-clicked"))
    d = codec.decode_records(rows, topics=named)
    assert sorted((r.kind or "", r.error_reason or "") for r in d.collect()) == \
        [("", codec.REASON_TOPIC), ("click", ""), ("impression", "")]


def test_f22_quoted_number_accepted(spark):
    d = codec.decode_records(records(spark, [GOOD.replace('"amount":1000', '"amount":"1000"')]))
    row = d.collect()[0]
    assert row.error_reason is None and row.amount == 1000


def test_missing_amount_is_zero_downstream(spark):
    d = codec.decode_records(records(spark, [GOOD.replace(',"amount":1000', '')]))
    good = codec.valid_events(d).withColumn("event_id", d["offset"])
    assert [r.aggregated_amount for r in partner_billing(good).collect()] == [0]


def test_f17_display_id_with_colon_kept(spark):
    d = codec.decode_records(records(spark, [GOOD.replace('"display-1"', '"a:b"'),
                                             GOOD.replace('"display-1"', '""')]))
    assert sorted(r.display_id for r in codec.valid_events(d).collect()) == ["", "a:b"]


def test_good_and_bad_split_is_complete(spark):
    values = [GOOD, "{", GOOD.replace('"WEB"', '"TV"'), GOOD]
    d = codec.decode_records(records(spark, values))
    assert codec.valid_events(d).count() == 2
    dl = codec.dead_letter(d).collect()
    assert len(dl) == 2 and {r.value for r in dl} == {"{", values[2]}


def test_unknown_topic(spark):
    assert reasons(spark, [GOOD], topic="other") == [codec.REASON_TOPIC]


def test_payload_event_time(spark):
    d = codec.decode_records(records(spark, [GOOD.replace("12:00:00", "12:03:00")]), event_time="payload")
    assert d.collect()[0].ts == dt.datetime(2024, 1, 1, 12, 3, 0)


def test_encode_roundtrip(spark):
    rows = spark.createDataFrame([(100, 5, 1, 5, TS, TS + dt.timedelta(minutes=1))],
                                 "partner_id long, aggregated_amount long, fraudulent_amount long, "
                                 "total_billing_amount long, window_start timestamp_ntz, window_end timestamp_ntz")
    out = codec.encode_records(rows, ["partner_id"], codec.BILLING_JSON_FIELDS).collect()[0]
    assert out.key == "100"
    assert out.value == ('{"partnerId":100,"aggregatedAmount":5,"fraudulentAmount":1,"totalBillingAmount":5,'
                         '"windowStart":"2024-01-01T12:00:00","windowEnd":"2024-01-01T12:01:00"}')


def test_decode_parses_once(spark):
    plan = codec.valid_events(codec.decode_records(records(spark, [GOOD])))._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("from_json") == 1
