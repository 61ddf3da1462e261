"""Plan-shape checks: the properties the design relies on at scale."""

from __future__ import annotations

from adtally.catalog import queries

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_billing_top_n_is_partial_before_shuffle(spark):
    p = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(queries()["partner_billing"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", p)
    assert "WindowGroupLimit" in text and "Partial" in text
    # two exchanges: top-N on placements, final sum per partner-minute
    assert text.count("Exchange hashpartitioning") == 2


def test_group_metrics_union_plan_exchanges(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(queries()["partner_group_metrics"](spark, SF))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert text.count("Exchange hashpartitioning") == 3
    assert "Partial" in text


def test_scan_prunes_and_pushes(spark):
    text = plan(queries()["partner_billing"](spark, SF))
    assert "EqualTo(event_type,click)" in text and "IsNotNull(ts)" in text and "view" not in text.split("ReadSchema")[0]
    # every column of the table is needed by the view (ids, time, type, amount, props.k)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string," \
           "value:double,props:string>" in text
    counts = plan(queries()["display_metrics"](spark, SF))
    assert "PushedFilters: [In(event_type, [click,view])]" in counts


def test_props_parsed_once_per_scan(spark):
    for name in ("partner_billing", "partner_group_metrics", "display_metrics", "click_aggregation_1min"):
        text = plan(queries()[name](spark, SF))
        assert text.count("get_json_object") == text.count("FileScan parquet"), name


def test_no_single_partition_exchange(spark):
    for name in ("late_click_filter", "display_metrics_changelog", "display_metrics_asof"):
        assert "SinglePartition" not in plan(queries()[name](spark, SF)), name


def test_display_changelog_no_unsliced_window(spark):
    import re
    text = optimized(queries()["display_metrics_changelog"](spark, SF))
    windows = re.findall(r"Window \[.*?windowspecdefinition\((.*?)specifiedwindowframe", text)
    assert len(windows) == 2
    # one over rows, partitioned by display and slice; one over the per-slice totals, ordered by slice
    assert all("_slice" in w for w in windows)


def test_no_python_udf_in_batch_queries(spark):
    for name in ("partner_billing", "partner_group_metrics", "display_metrics",
                 "display_metrics_changelog", "late_click_filter", "decode_valid_only"):
        text = plan(queries()[name](spark, SF))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_columns_pruned_at_scan(spark):
    text = plan(queries()["display_metrics"](spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,props:string>" in text
    late = plan(queries()["late_click_filter"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string,props:string>" in late
