"""Property tests (hypothesis) and a hot-key test, each checked against a
brute-force fold written directly from the rule."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from adtally.plans.billing import click_aggregation_1min, partner_billing
from adtally.plans.group_metrics import partner_group_metrics, partner_group_metrics_join
from adtally.schemas import AD_EVENT_SCHEMA

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)

event = st.tuples(
    st.integers(0, 179),                     # second offset (3 minutes)
    st.sampled_from(["impression", "click", "click"]),
    st.sampled_from([100, 200]),
    st.integers(1, 2),                       # group
    st.integers(1, 2),                       # product
    st.one_of(st.none(), st.integers(-50, 500)),
)


def to_rows(events):
    return [(i, T0 + dt.timedelta(seconds=s), kind, p, g, pr, "WEB", "display-1", a)
            for i, (s, kind, p, g, pr, a) in enumerate(events)]


def brute_billing(rows, limit=10):
    """The ordered counter of the reference, applied literally."""
    state = defaultdict(lambda: [0, 0, 0])
    for eid, ts, kind, p, g, pr, t, d, a in sorted(rows, key=lambda r: (r[1], r[0])):
        if kind != "click":
            continue
        minute = ts.replace(second=0, microsecond=0)
        s = state[(p, t, d, pr, minute)]
        s[0] += 1
        if s[0] > limit:
            s[2] += a or 0
        else:
            s[1] += a or 0
    out = defaultdict(lambda: [0, 0])
    for (p, t, d, pr, minute), (_, normal, fraud) in state.items():
        out[(p, minute)][0] += normal
        out[(p, minute)][1] += fraud
    return {k: tuple(v) for k, v in out.items()}


SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=60))
def test_billing_equals_brute_force(spark, events):
    rows = to_rows(events)
    got = {(r.partner_id, r.window_start): (r.aggregated_amount, r.fraudulent_amount)
           for r in partner_billing(spark.createDataFrame(rows, AD_EVENT_SCHEMA)).collect()}
    assert got == brute_billing(rows)


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=60), st.randoms())
def test_fold_invariants_and_order_independence(spark, events, rnd):
    rows = to_rows(events)
    shuffled = list(rows)
    rnd.shuffle(shuffled)
    a = sorted(tuple(r) for r in click_aggregation_1min(spark.createDataFrame(rows, AD_EVENT_SCHEMA)).collect())
    b = sorted(tuple(r) for r in click_aggregation_1min(spark.createDataFrame(shuffled, AD_EVENT_SCHEMA)).collect())
    assert a == b
    total = sum((r[8] or 0) for r in rows if r[2] == "click")
    assert sum(r.normal_amount + r.fraudulent_amount for r in
               click_aggregation_1min(spark.createDataFrame(rows, AD_EVENT_SCHEMA)).collect()) == total
    for r in click_aggregation_1min(spark.createDataFrame(rows, AD_EVENT_SCHEMA)).collect():
        if r.click_count <= 10:
            assert r.fraudulent_amount == 0


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=60))
def test_union_plan_equals_join_plan(spark, events):
    df = spark.createDataFrame(to_rows(events), AD_EVENT_SCHEMA)
    a = sorted(tuple(r) for r in partner_group_metrics(df).collect())
    b = sorted(tuple(r) for r in partner_group_metrics_join(df).select(*partner_group_metrics(df).columns).collect())
    assert a == b
    for r in a:
        assert r[4] <= 5 * 2  # at most one flag per placement-minute: 5 minutes x 2 products


def test_hot_key_holds_a_third(spark):
    """One placement holds a third of all clicks; results stay exact."""
    rows = []
    eid = 0
    for i in range(3000):
        s = (i * 7) % 180
        if i % 3 == 0:   # the hot placement
            rows.append((eid, T0 + dt.timedelta(seconds=s, microseconds=i), "click", 100, 1, 1, "WEB",
                         "display-1", i % 97))
        else:
            rows.append((eid, T0 + dt.timedelta(seconds=s), "click", 100 + 100 * (i % 7), 1 + i % 3,
                         1 + i % 5, "APP", f"display-{i % 11}", i % 89))
        eid += 1
    df = spark.createDataFrame(rows, AD_EVENT_SCHEMA).repartition(8)
    got = {(r.partner_id, r.window_start): (r.aggregated_amount, r.fraudulent_amount)
           for r in partner_billing(df).collect()}
    assert got == brute_billing(rows)


def brute_group(rows, limit=10):
    """Q2 literally: fold per group-inclusive placement-minute, flag when
    the excess amount is > 0, count impressions/clicks per 5 minutes, keep
    windows with impressions."""
    fold = defaultdict(lambda: [0, 0])
    imps, clks = defaultdict(int), defaultdict(int)
    for eid, ts, kind, p, g, pr, t, d, a in sorted(rows, key=lambda r: (r[1], r[0])):
        w5 = ts.replace(minute=ts.minute - ts.minute % 5, second=0, microsecond=0)
        if kind == "impression":
            imps[(p, g, w5)] += 1
            continue
        clks[(p, g, w5)] += 1
        s = fold[(p, g, t, d, pr, ts.replace(second=0, microsecond=0))]
        s[0] += 1
        if s[0] > limit:
            s[1] += a or 0
    flags, amount = defaultdict(int), defaultdict(int)
    for (p, g, t, d, pr, m), (_, excess) in fold.items():
        if excess > 0:
            w5 = m.replace(minute=m.minute - m.minute % 5)
            flags[(p, g, w5)] += 1
            amount[(p, g, w5)] += excess
    return {k: (n, clks[k], flags[k], amount[k]) for k, n in imps.items()}


@settings(**SETTINGS)
@given(st.lists(event, min_size=1, max_size=80))
def test_group_metrics_equals_brute_force(spark, events):
    rows = to_rows(events)
    got = {(r.partner_id, r.group_id, r.window_start):
           (r.impression_count, r.click_count, r.fraudulent_click_count, r.fraudulent_amount)
           for r in partner_group_metrics(spark.createDataFrame(rows, AD_EVENT_SCHEMA)).collect()}
    assert got == brute_group(rows)


hot_event = st.tuples(
    st.integers(0, 119),
    st.sampled_from(["impression", "click", "click", "click"]),
    st.just(100),
    st.just(1),
    st.integers(1, 2),
    st.one_of(st.none(), st.integers(-30, 300)),
)


@settings(**SETTINGS)
@given(st.lists(hot_event, min_size=20, max_size=90))
def test_concentrated_clicks_against_brute_force(spark, events):
    """Many clicks per placement-minute: the flag path and signed excess
    amounts are exercised in both results."""
    rows = to_rows(events)
    df = spark.createDataFrame(rows, AD_EVENT_SCHEMA)
    got = {(r.partner_id, r.group_id, r.window_start):
           (r.impression_count, r.click_count, r.fraudulent_click_count, r.fraudulent_amount)
           for r in partner_group_metrics(df).collect()}
    assert got == brute_group(rows)
    bill = {(r.partner_id, r.window_start): (r.aggregated_amount, r.fraudulent_amount)
            for r in partner_billing(df).collect()}
    assert bill == brute_billing(rows)


placement_event = st.tuples(
    st.integers(0, 179),
    st.sampled_from(["impression", "click", "click", "click"]),
    st.just(100),
    st.just(1),
    st.one_of(st.none(), st.integers(1, 2)),   # product may be null
    st.one_of(st.none(), st.integers(0, 50)),
)


@settings(**SETTINGS)
@given(st.lists(placement_event, min_size=5, max_size=90))
def test_fraud_tags_equal_rank(spark, events):
    from adtally.plans.billing import click_fraud_tagged
    rows = to_rows(events)
    df = spark.createDataFrame(rows, AD_EVENT_SCHEMA)
    got = {r.event_id: r.is_fraud for r in click_fraud_tagged(df).collect()}
    seen = defaultdict(int)
    want = {}
    for eid, ts, kind, p, g, pr, t, d, a in sorted(rows, key=lambda r: (r[1], r[0])):
        if kind != "click":
            continue
        k = (p, t, d, pr, ts.replace(second=0, microsecond=0))
        seen[k] += 1
        want[eid] = seen[k] > 10
    assert got == want


@settings(**SETTINGS)
@given(st.lists(placement_event, min_size=1, max_size=90))
def test_changelog_equals_running_counts(spark, events):
    from adtally.plans.display_metrics import display_metrics_changelog
    rows = to_rows(events)
    df = spark.createDataFrame(rows, AD_EVENT_SCHEMA)
    got = {r.event_id: (r.impression_count, r.click_count)
           for r in display_metrics_changelog(df, slice_duration="1 minute").collect()}
    imps = clks = 0
    want = {}
    for eid, ts, kind, p, g, pr, t, d, a in sorted(rows, key=lambda r: (r[1], r[0])):
        if kind == "impression":
            imps += 1
            want[eid] = (imps, clks)
        else:
            clks += 1
    assert got == want
