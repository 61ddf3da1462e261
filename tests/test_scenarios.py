"""Scenario tests from FIXTURES.md (window-aligned times, hand-derived
expected values)."""

from __future__ import annotations

import datetime as dt

from conftest import at, ev

from adtally.plans.billing import click_aggregation_1min, click_fraud_tagged, partner_billing
from adtally.plans.display_metrics import (
    display_metrics, display_metrics_asof, display_metrics_changelog,
)
from adtally.plans.group_metrics import partner_group_metrics, partner_group_metrics_join

W0 = dt.datetime(2024, 1, 1, 12, 0)
W1 = dt.datetime(2024, 1, 1, 12, 1)
W5 = dt.datetime(2024, 1, 1, 12, 5)


def billing_rows(df):
    return sorted(tuple(r) for r in partner_billing(df).collect())


def group_rows(df, plan=partner_group_metrics):
    return sorted(tuple(r) for r in plan(df).collect())


def test_f1_single_click(make):
    assert billing_rows(make([ev(1, 0)])) == [(100, 1000, 0, 1000, W0, W1)]


def test_f2_eleven_clicks_one_fraud(make):
    rows = [ev(i, i) for i in range(11)]
    assert billing_rows(make(rows)) == [(100, 10000, 1000, 10000, W0, W1)]


def test_f3_two_partners(make):
    rows = [ev(1, 0, partner=100, amount=1000), ev(2, 0, partner=200, amount=2000)]
    assert billing_rows(make(rows)) == [(100, 1000, 0, 1000, W0, W1), (200, 2000, 0, 2000, W0, W1)]


def test_f4_impression_and_click(make):
    rows = [ev(1, 0, kind="impression"), ev(2, 0)]
    assert group_rows(make(rows)) == [(100, 1, 1, 1, 0, 0, W0, W5)]


def test_f5_exactly_ten_is_not_fraud(make):
    rows = [ev(i, i) for i in range(10)]
    assert billing_rows(make(rows)) == [(100, 10000, 0, 10000, W0, W1)]


def test_f6_minute_boundary_splits(make):
    rows = [ev(i, 54 + i) for i in range(11)]  # 6 before 12:01:00, 5 after
    out = sorted(billing_rows(make(rows)), key=lambda r: r[4])
    assert [r[2] for r in out] == [0, 0]
    assert [r[1] for r in out] == [6000, 5000]


def test_f7_order_by_time_not_file_order(make):
    rows = [ev(i, i, amount=i + 1) for i in range(11)]
    for shuffled in (rows, list(reversed(rows)), rows[5:] + rows[:5]):
        assert billing_rows(make(shuffled)) == [(100, 55, 11, 55, W0, W1)]


def test_f8_group_in_fraud_key_only_for_group_metrics(make):
    clicks = [ev(i, i, group=1 + i % 2) for i in range(12)]
    imps = [ev(100, 0, kind="impression", group=1), ev(101, 0, kind="impression", group=2)]
    df = make(clicks + imps)
    assert billing_rows(df) == [(100, 10000, 2000, 10000, W0, W1)]
    assert [r[4:6] for r in group_rows(df)] == [(0, 0), (0, 0)]


def test_f9_two_flagged_minutes_in_one_window(make):
    rows = [ev(i, i) for i in range(11)] + [ev(20 + i, 60 + i) for i in range(11)]
    rows.append(ev(99, 0, kind="impression"))
    for plan in (partner_group_metrics, partner_group_metrics_join):
        assert group_rows(make(rows), plan) == [(100, 1, 1, 22, 2, 2000, W0, W5)]


def test_f10_null_amount_eleventh_is_not_flagged(make):
    rows = [ev(i, i) for i in range(10)] + [ev(10, 10, amount=None), ev(99, 0, kind="impression")]
    df = make(rows)
    assert billing_rows(df) == [(100, 10000, 0, 10000, W0, W1)]
    assert group_rows(df) == [(100, 1, 1, 11, 0, 0, W0, W5)]


def test_f11_clicks_without_impressions(make):
    df = make([ev(1, 0)])
    assert len(billing_rows(df)) == 1
    assert group_rows(df) == []
    assert display_metrics(df).count() == 0


def test_f12_impression_without_clicks(make):
    df = make([ev(1, 0, kind="impression")])
    assert group_rows(df) == [(100, 1, 1, 0, 0, 0, W0, W5)]
    assert [tuple(r) for r in display_metrics(df).collect()] == [(100, 1, "WEB", "display-1", 1, 0)]


def test_f13_totals_and_asof(make):
    df = make([ev(1, 0, kind="impression"), ev(2, 1), ev(3, 2)])
    assert [tuple(r)[4:] for r in display_metrics(df).collect()] == [(1, 2)]
    assert [tuple(r)[4:] for r in display_metrics_asof(df).collect()] == [(1, 0)]


def test_f14_changelog(make):
    df = make([ev(1, 0, kind="impression"), ev(2, 1), ev(3, 2, kind="impression")])
    log = sorted((r.impression_count, r.click_count) for r in display_metrics_changelog(df).collect())
    assert log == [(1, 0), (2, 1)]


def test_f14_changelog_across_slices(make):
    # History spread over several minutes exercises the slice offsets.
    rows = []
    for m in range(4):
        rows += [ev(10 * m, 60 * m, kind="impression"), ev(10 * m + 1, 60 * m + 1),
                 ev(10 * m + 2, 60 * m + 2)]
    log = sorted((r.impression_count, r.click_count) for r in display_metrics_changelog(make(rows)).collect())
    assert log == [(1, 0), (2, 2), (3, 4), (4, 6)]


def test_f17_display_ids_kept(make):
    df = make([ev(1, 0, kind="impression", display="a:b"), ev(2, 0, kind="impression", display="")])
    assert sorted(r.display_id for r in display_metrics(df).collect()) == ["", "a:b"]


def test_f20_click_on_minute_boundary(make):
    out = billing_rows(make([ev(1, 60)]))
    assert out[0][4] == W1


def test_f21_signed_amounts(make):
    rows = [ev(i, i) for i in range(10)] + [ev(10, 10, amount=-5), ev(11, 11, amount=3),
                                            ev(99, 0, kind="impression")]
    df = make(rows)
    assert billing_rows(df) == [(100, 10000, -2, 10000, W0, W1)]
    assert group_rows(df) == [(100, 1, 1, 12, 0, 0, W0, W5)]


def test_fraud_tags_and_fold_agree(make):
    rows = [ev(i, i % 50, amount=i) for i in range(25)]
    df = make(rows)
    tagged = click_fraud_tagged(df).collect()
    assert sum(r.is_fraud for r in tagged) == 15
    fold = click_aggregation_1min(df).collect()[0]
    assert fold.fraudulent_amount == sum(r.amount for r in tagged if r.is_fraud)
    assert fold.click_count == 25


def test_tie_break_by_event_id(make):
    rows = [ev(i, 0, amount=i) for i in range(12)]  # all at the same instant
    assert billing_rows(make(rows)) == [(100, sum(range(10)), 10 + 11, sum(range(10)), W0, W1)]


def test_null_partner_excluded(make):
    rows = [ev(1, 0), ev(2, 0, partner=None)]
    assert billing_rows(make(rows)) == [(100, 1000, 0, 1000, W0, W1)]


def test_time_fixture_helper():
    assert at(60) == W1


def test_tagged_clicks_that_repeat_an_order_key(make):
    """One row per click, whatever repeats: 12 equal clicks, 2 of them fraud."""
    tagged = click_fraud_tagged(make([ev(1, 5) for _ in range(12)])).collect()
    assert sorted(r.is_fraud for r in tagged) == [False] * 10 + [True] * 2
    few = click_fraud_tagged(make([ev(1, 5), ev(1, 5), ev(2, 6)])).collect()
    assert [r.is_fraud for r in few] == [False] * 3
