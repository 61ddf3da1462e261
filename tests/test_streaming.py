"""Batch = stream on closed windows, over several micro-batches, and a
restart from the checkpoint (F19)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from adtally.config import shared_dir
from adtally.plans.billing import partner_billing
from adtally.plans.group_metrics import group_fraud_5min, partner_group_metrics
from adtally.plans.display_metrics import display_metrics
from adtally.schemas import AD_EVENT_SCHEMA, DISPLAY_KEY
from adtally.sources.tables import ad_events, load_events
from adtally.streaming.queries import compact_display, display_metrics_stream, display_table, read_log, read_result, run_changelog, run_update, run_windowed
from adtally.streaming.windowed import WINDOWED_RESULTS

SF = "/root/testdata/sf0.01"


def split_input(spark, parts: int):
    """The ad events of sf0.01 written as ``parts`` files in arrival order."""
    base = shared_dir(spark, "test-input")
    ad = ad_events(load_events(spark, SF))
    ad = ad.withColumn("_part", (F.col("event_id") * parts / F.lit(10_000)).cast("int"))
    import glob
    import os
    import time
    start = time.time()
    for p in range(parts):
        ad.where(F.col("_part") == p).drop("_part").coalesce(1).write.parquet(f"{base}/in/part={p:03d}")
        for f in glob.glob(f"{base}/in/part={p:03d}/*.parquet"):  # arrival order = file order
            os.utime(f, (start + p, start + p))
    return base


def stream_of(spark, folder, per_trigger="1"):
    """(impressions, clicks) of the ad-event files of a folder, two sources."""
    return tuple((spark.readStream.schema(AD_EVENT_SCHEMA).option("maxFilesPerTrigger", per_trigger)
                  .option("recursiveFileLookup", "true").parquet(folder)).where(F.col("kind") == k)
                 for k in ("impression", "click"))


def arrive(spark, base, steps):
    """Each step's rows as one file, arriving in that order."""
    import glob
    import os
    import time
    now = time.time()
    for i, step in enumerate(steps):
        spark.createDataFrame(step, AD_EVENT_SCHEMA).coalesce(1).write.parquet(f"{base}/in/p={i:03d}")
        for f in glob.glob(f"{base}/in/p={i:03d}/*.parquet"):
            os.utime(f, (now + i, now + i))


def event(i, seconds, kind="click", display="display-1", amount=1000):
    return (i, dt.datetime(2024, 1, 1, 12) + dt.timedelta(seconds=seconds), kind, 100, 1, 1, "WEB", display, amount)


def run(spark, base, result, **options):
    q = run_windowed(result, *stream_of(spark, f"{base}/in"), f"{base}/{result}/data", f"{base}/{result}/cp", **options)
    q.awaitTermination()
    return read_result(spark, f"{base}/{result}/data", result)


def rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def closed(batch, cut):
    return batch.where(F.col("window_end") <= F.lit(cut))


def test_stream_equals_batch_multi_batch(spark):
    base = split_input(spark, 4)
    ad_batch = spark.read.schema(AD_EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    cases = [
        ("partner_billing", partner_billing, "kind = 'click'", 3),
        ("partner_group_metrics", partner_group_metrics, "true", 5),
        ("partner_group_metrics_join", partner_group_metrics, "true", 2),
        ("group_fraud_5min", group_fraud_5min, "kind = 'click'", 1),
    ]
    for name, make_batch, kinds, salts in cases:
        got = run(spark, base, name, salts=salts)
        # the slower of the sources that the result reads
        cut = min(ad_batch.where(kinds).groupBy("kind").agg(F.max("ts").cast("timestamp_ntz").alias("m")).collect(), key=lambda r: r.m).m
        want = closed(make_batch(ad_batch), cut)
        cols = sorted(want.columns)
        assert rows(got, cols) == rows(want, cols), name
        if name != "group_fraud_5min":  # the last window stays open in the stream, batch shows it
            assert make_batch(ad_batch).count() > got.count()


def test_display_update_stream_equals_batch(spark):
    base = split_input(spark, 3)
    q = run_update(display_metrics_stream(*stream_of(spark, f"{base}/in")), f"{base}/table", f"{base}/cp")
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/table/log").select("batch_id").distinct().count() == 3
    got = display_table(spark, f"{base}/table")
    ad_batch = spark.read.schema(AD_EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    cols = [*DISPLAY_KEY, "impression_count", "click_count"]
    want = rows(display_metrics(ad_batch), cols)
    assert rows(got, cols) == want
    assert compact_display(spark, f"{base}/table")
    assert rows(display_table(spark, f"{base}/table"), cols) == want


def test_restart_resumes_without_duplicates(spark):
    base = split_input(spark, 4)
    src = f"{base}/in"
    # First run sees the first two files only.
    live = f"{base}/live"
    spark.read.parquet(f"{src}/part=000").write.parquet(f"{live}/part=000")
    spark.read.parquet(f"{src}/part=001").write.parquet(f"{live}/part=001")

    def start():
        return run_windowed("partner_billing", *stream_of(spark, live), f"{base}/out", f"{base}/cp")

    q = start()
    q.awaitTermination()
    first = read_result(spark, f"{base}/out").count()
    for p in (2, 3):
        spark.read.parquet(f"{src}/part={p:03d}").write.parquet(f"{live}/part={p:03d}")
    q = start()
    q.awaitTermination()
    got = read_result(spark, f"{base}/out")
    assert got.count() > first
    assert got.groupBy("partner_id", "window_start").count().where("count > 1").count() == 0
    ad_batch = spark.read.schema(AD_EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(src)
    cut = ad_batch.where("kind = 'click'").agg(F.max("ts").cast("timestamp_ntz")).first()[0]
    want = closed(partner_billing(ad_batch), cut)
    cols = sorted(want.columns)
    assert rows(got, cols) == rows(want, cols)


def test_late_rows_dropped_in_stream(spark):
    """A row for a window the watermark already closed is not counted."""
    base = shared_dir(spark, "test-late")
    arrive(spark, base, [[event(1, 10), event(2, 130)], [event(3, 20), event(4, 200)], [event(5, 30), event(6, 300)]])
    out = {r.window_start.minute: r.aggregated_amount for r in run(spark, base, "partner_billing").collect()}
    assert out[0] <= 2000  # the row at :20 may still count (Spark's rule is a micro-batch behind), that at :30 may not
    assert out[2] == 1000


def test_out_of_order_clicks_in_an_open_window(spark):
    base = shared_dir(spark, "test-order")
    arrive(spark, base, [[event(1, 30)], [event(2, 35)], [event(3, 40)], [event(4, 10)], [event(5, 200)], [event(6, 400)]])
    out = {r.window_start.minute: r.aggregated_amount for r in run(spark, base, "partner_billing").collect()}
    assert out[0] == 4000


def test_out_of_order_fraud_equals_batch(spark):
    """11 clicks and an impression over several micro-batches, the largest out
    of order: one flagged placement-minute, 1000."""
    base = shared_dir(spark, "test-fraud")
    clicks = [event(i, 20 + i) for i in range(2, 12)]
    late = [event(1, 5), event(50, 6, "impression")]
    after = [[event(90 + k, 400 * k), event(95 + k, 400 * k, "impression")] for k in (1, 2, 3)]
    arrive(spark, base, [clicks[:4], clicks[4:7], clicks[7:], late, *after])
    first = [r for r in run(spark, base, "partner_group_metrics").collect() if r.window_start.minute == 0]
    assert [(r.impression_count, r.click_count, r.fraudulent_click_count, r.fraudulent_amount) for r in first] == [(1, 11, 1, 1000)]


def test_slower_source_keeps_windows_open(spark):
    """Impressions that arrive behind the clicks count (minimum of the watermarks)."""
    base = shared_dir(spark, "test-lag")
    after = [[event(90 + k, 400 * k), event(95 + k, 400 * k, "impression")] for k in (2, 3, 4)]
    arrive(spark, base, [[event(1, 10), event(2, 5, "impression")], [event(3, 700)], [event(4, 60, "impression")], *after])
    first = [r for r in run(spark, base, "partner_group_metrics").collect() if r.window_start.minute == 0]
    assert [(r.impression_count, r.click_count) for r in first] == [(2, 1)]


def test_hot_placement_has_bounded_state_values(spark):
    """A million clicks of one placement in an open minute, in four
    micro-batches: no state value holds more than a bucket's share of a salt."""
    base = shared_dir(spark, "test-hot")
    n, salts, bucket = 1_000_000, 4, "100 milliseconds"
    i = F.col("id")
    hot = spark.range(n).select(
        i.alias("event_id"), F.timestamp_micros(F.lit(1704110400000000) + (i * 7919 % n) * 60).alias("ts"), F.lit("click").alias("kind"),
        *[F.lit(v).cast("long").alias(c) for c, v in (("partner_id", 100), ("group_id", 1), ("product_id", 1))],
        F.lit("WEB").alias("display_target"), F.lit("display-1").alias("display_id"), (i % 97).alias("amount"))
    later = spark.createDataFrame([event(n + 1, 200), event(n + 2, 400)], AD_EVENT_SCHEMA)

    def start():
        return run_windowed("partner_billing", *stream_of(spark, f"{base}/in", "100"), f"{base}/out", f"{base}/cp", salts=salts, bucket=bucket)

    for part in range(4):
        hot.where(i % 4 == part).coalesce(2).write.parquet(f"{base}/in/p={part}")
        start().awaitTermination()
    state = spark.read.format("statestore").option("operatorId", 2).load(f"{base}/cp")  # the buckets
    sizes = state.select(F.length(F.to_json("value"))).toDF("size").agg(F.max("size"), F.count("size")).first()
    clicks = n // 600 // salts  # of one placement in a bucket and salt, on average
    assert sizes[1] == 600 * salts and sizes[0] < 2 * clicks * 60  # bytes as text; a window's would be 600 times that
    later.coalesce(1).write.parquet(f"{base}/in/p=9")
    start().awaitTermination()
    got = [r for r in read_result(spark, f"{base}/out").collect() if r.window_start.minute == 0]
    want = partner_billing(hot).collect()
    assert [(r.aggregated_amount, r.fraudulent_amount) for r in got] == [(r.aggregated_amount, r.fraudulent_amount) for r in want]


def test_windowed_results_are_single_streaming_plans(spark):
    """Chained aggregates (and joins) inside the plan, no Python in it, and no
    placement among the keys of impressions."""
    base = shared_dir(spark, "test-plans")
    arrive(spark, base, [[event(1, 10), event(2, 11, "impression"), event(3, 12, "impression", display="other")], [event(8, 400), event(9, 400, "impression")]])
    operators = {"partner_billing": 3, "group_fraud_5min": 3, "partner_group_metrics": 3, "partner_group_metrics_join": 7}
    for name, n in operators.items():
        q = run_windowed(name, *stream_of(spark, f"{base}/in"), f"{base}/{name}/out", f"{base}/{name}/cp", salts=1)
        q.awaitTermination()
        first = next(p for p in q.recentProgress if p["batchId"] == 0)
        assert len(first["stateOperators"]) == n, name
        if name == "partner_group_metrics":
            assert first["stateOperators"][-1]["numRowsTotal"] == 2  # a placement's clicks, and the impressions of both displays
        plan = WINDOWED_RESULTS[name](*stream_of(spark, f"{base}/in"))._jdf.queryExecution().analyzed().toString()
        assert "Python" not in plan and "Pandas" not in plan and "_salt" in plan


def test_join_form_waits_for_the_idle_side(spark):
    """An impression window without clicks comes out when the clicks' watermark
    has passed it, not before."""
    base = shared_dir(spark, "test-idle")
    start = lambda: run(spark, base, "partner_group_metrics_join")
    arrive(spark, base, [[event(1, 5, "impression"), event(2, 6)], [event(3, 700, "impression")], [event(4, 1400, "impression")]])
    assert start().count() == 0  # clicks stand at second 6
    for n in (100, 101):  # a source's watermark starts anew with a restart
        more = [event(n, 1300), event(n + 2, 1400, "impression")]
        spark.createDataFrame(more, AD_EVENT_SCHEMA).coalesce(1).write.parquet(f"{base}/in/p={n}")
    got = sorted((r.window_start.minute, r.impression_count, r.click_count) for r in start().collect())
    assert got == [(0, 1, 1), (10, 1, 0)]


def test_stream_reads_a_folder_shaped_table(spark):
    import pytest

    from adtally.catalog import queries
    from adtally.sources.tables import load_events
    base = shared_dir(spark, "test-layout")
    load_events(spark, "/root/testdata/sf0.001").repartition(4).write.parquet(f"{base}/events.parquet")
    for name in ("stream_partner_billing", "stream_partner_group_metrics", "stream_display_metrics", "stream_display_changelog"):
        one, four = (queries()[name](spark, d) for d in ("/root/testdata/sf0.001", base))
        assert rows(one, sorted(one.columns)) == rows(four, sorted(one.columns)), name
    with pytest.raises(FileNotFoundError):
        queries()["stream_partner_billing"](spark, f"{base}/nothing")


def test_retried_batch_replaces_its_output(spark):
    """foreachBatch may run a micro-batch again after a failure; the sink
    overwrites that batch's partition only."""
    from adtally.streaming.queries import batch_partition_writer, read_result
    base = shared_dir(spark, "test-retry")
    rows = spark.createDataFrame([(100, 5, 0, 5, dt.datetime(2024, 1, 1, 12), dt.datetime(2024, 1, 1, 12, 1))],
                                 "partner_id long, aggregated_amount long, fraudulent_amount long, "
                                 "total_billing_amount long, window_start timestamp_ntz, window_end timestamp_ntz")
    other = rows.withColumn("partner_id", F.lit(200).cast("long"))
    write = batch_partition_writer(f"{base}/out")
    write(rows, 0)
    write(other, 1)
    write(other, 1)  # retry of batch 1
    got = read_result(spark, f"{base}/out")
    assert sorted(r.partner_id for r in got.collect()) == [100, 200]


def test_display_changelog_stream_equals_batch(spark):
    """The reference's display update stream over several micro-batches
    (arrival = file order) equals the batch changelog (F13, F14 at scale),
    whatever the size of Arrow batches."""
    from adtally.plans.display_metrics import display_metrics_changelog
    base = split_input(spark, 3)
    ad_batch = spark.read.schema(AD_EVENT_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{base}/in")
    want = display_metrics_changelog(ad_batch)
    cols = sorted(want.columns)
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    for n, per_trigger in (("50", "1"), ("10000", "100")):
        spark.conf.set(size, n)
        q = run_changelog(*stream_of(spark, f"{base}/in", per_trigger), f"{base}/log{n}", f"{base}/cp{n}")
        q.awaitTermination()
        spark.conf.unset(size)
        got = read_log(spark, f"{base}/log{n}", "display_changelog").drop("batch_id")
        assert rows(got, cols) == rows(want, cols)


def test_changelog_restarts_from_the_state_store(spark):
    """Totals outlive a restart; one hot display; clicks after the last impression."""
    base = shared_dir(spark, "test-changelog-restart")
    for step in range(3):
        kinds = ["impression", "click", "click"]
        batch = [event(10 * step + i, 100 * step + i, kinds[i % 3]) for i in range(9)] + [event(500 + step, 100 * step, "impression", display=None)]
        spark.createDataFrame(batch, AD_EVENT_SCHEMA).coalesce(1).write.parquet(f"{base}/in/p={step}")
        run_changelog(*stream_of(spark, f"{base}/in", "100"), f"{base}/log", f"{base}/cp").awaitTermination()
    got = {(r.display_id, r.event_id): (r.impression_count, r.click_count) for r in read_log(spark, f"{base}/log", "display_changelog").collect()}
    want = {("display-1", 10 * s + 3 * i): (3 * s + i + 1, 6 * s + 2 * i) for s in range(3) for i in range(3)}
    assert got == want | {("", 500 + s): (s + 1, 0) for s in range(3)}


def test_late_stream_equals_batch(spark):
    """Out-of-order clicks of two source partitions over several files."""
    import random

    from adtally.operators.late import late_flags
    from adtally.streaming.queries import run_late
    base, rng = shared_dir(spark, "test-late-stream"), random.Random(5)
    t0 = dt.datetime(2024, 1, 1)
    data = [(i, i, t0 + dt.timedelta(seconds=i * 7 + rng.randint(-90, 90)), rng.choice([0, 0, 0, 1])) for i in range(300)]
    schema = "event_id long, arrival long, ts timestamp, partition long"
    for n, at in enumerate(range(0, 300, 60)):
        spark.createDataFrame(data[at:at + 60], schema).write.parquet(f"{base}/in/p={n}")
        s = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        run_late(s, f"{base}/out", f"{base}/cp").awaitTermination()
    cols = ["event_id", "window_end", "seen_max_ts", "is_late"]
    want = late_flags(spark.createDataFrame(data, schema), partition_cols=["partition"])
    got = read_log(spark, f"{base}/out", "late_clicks")
    key = lambda r: r[0]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=key) == sorted((tuple(r) for r in want.select(*cols).collect()), key=key)
    assert 0 < got.where("is_late").count() < 300


def test_repeated_result_records_are_read_once(spark):
    from adtally.functions.codec import BILLING_JSON_FIELDS
    from adtally.streaming.consume import result_records, unique_results
    from adtally.streaming.queries import run_append
    base = shared_dir(spark, "test-dedup")
    windows = [dt.datetime(2024, 1, 1, 12, m) for m in range(3)]
    results = spark.createDataFrame([(p, 5 * p, 0, 5 * p, w, w + dt.timedelta(minutes=1)) for p in (1, 2) for w in windows],
                                    "partner_id long, aggregated_amount long, fraudulent_amount long, total_billing_amount long, "
                                    "window_start timestamp_ntz, window_end timestamp_ntz")
    records = result_records(results, ["partner_id"], BILLING_JSON_FIELDS)
    assert records.first().headers[0].key == "window_start" and bytes(records.first().headers[0].value).startswith(b"2024-01-01 12:0")
    for n, part in enumerate((records, records.where("key = '1'"), records)):
        part.write.parquet(f"{base}/in/p={n}")
        s = spark.readStream.schema(records.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        run_append(unique_results(s), f"{base}/out", f"{base}/cp").awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    assert sorted((r.key, r.window_start.minute, r.value) for r in got.collect()) == sorted((r.key, r.m, r.value) for r in records.select(
        "key", "value", F.minute(F.col("headers")[0]["value"].cast("string").cast("timestamp")).alias("m")).collect())


def test_fan_out_reconciles(spark):
    """good + dead letter = records, from one read; a retried batch changes nothing."""
    from adtally.functions import codec
    from adtally.sources.derived import topic_records
    from adtally.streaming.queries import fan_out_writer
    base = shared_dir(spark, "test-fanout")
    decoded = codec.decode_records(topic_records(load_events(spark, "/root/testdata/sf0.001")))
    write = fan_out_writer({"good": codec.valid_events, "dead": codec.dead_letter}, base)
    for batch_id in (0, 1, 1):
        write(decoded.where(F.col("offset") % 2 == batch_id), batch_id)
    good, dead = (spark.read.parquet(f"{base}/{n}").count() for n in ("good", "dead"))
    assert good + dead == decoded.count() and good > 0 and dead > 0
