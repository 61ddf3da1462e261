"""Late-record rule (batch, exact, per record) and the sliced running
aggregates it uses."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from adtally.operators.late import late_flags
from adtally.operators.running import running_sums

T = dt.datetime(2024, 1, 1, 12, 0, 0)


def test_f18_third_row_late(spark):
    rows = [(1, 1, T + dt.timedelta(seconds=10)), (2, 2, T + dt.timedelta(seconds=90)),
            (3, 3, T + dt.timedelta(seconds=50))]
    df = spark.createDataFrame(rows, "event_id long, arrival long, ts timestamp")
    out = {r.event_id: r.is_late for r in late_flags(df).collect()}
    assert out == {1: False, 2: False, 3: True}


def test_slices_equal_single_window(spark):
    rows = [(i, (i * 7919) % 1000, T + dt.timedelta(seconds=(i * 37) % 600)) for i in range(400)]
    df = spark.createDataFrame(rows, "event_id long, arrival long, ts timestamp")
    small = {r.event_id: (r.is_late, r.seen_max_ts) for r in late_flags(df, slice_rows=16).collect()}
    big = {r.event_id: (r.is_late, r.seen_max_ts) for r in late_flags(df, slice_rows=1 << 30).collect()}
    w = Window.orderBy("arrival", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    ref = {r.event_id: r.m for r in df.withColumn("m", F.max("ts").over(w)).collect()}
    assert small == big
    assert {k: v[1] for k, v in small.items()} == ref


def test_running_sums_match_window(spark):
    rows = [(i % 3, i, i % 5) for i in range(300)]
    df = spark.createDataFrame(rows, "key long, pos long, x long").withColumn("slice", F.floor(F.col("pos") / 17))
    got = running_sums(df, ["key"], "slice", ["pos"], {"s": F.col("x")})
    w = Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    want = {r.pos: r.s for r in df.withColumn("s", F.sum("x").over(w)).collect()}
    assert {r.pos: r.s for r in got.collect()} == want


def test_spread_only_when_asked(spark):
    from adtally.sources.tables import spread
    one = spark.range(100).coalesce(1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    assert spread(one) is one


def test_late_rule_per_source_partition(spark):
    rows = [(1, 1, 0, T + dt.timedelta(seconds=90)), (2, 2, 1, T + dt.timedelta(seconds=10)), (3, 3, 0, T + dt.timedelta(seconds=20))]
    df = spark.createDataFrame(rows, "event_id long, arrival long, partition int, ts timestamp")
    out = {r.event_id: r.is_late for r in late_flags(df, partition_cols=["partition"]).collect()}
    assert out == {1: False, 2: False, 3: True}  # 2 is the first of its partition


def test_compaction_keeps_readers_and_the_log(spark):
    """Updates, a compaction between them, a retried batch: the newest row per
    key; a reader that listed its files before still reads them."""
    from adtally.config import shared_dir
    from adtally.sinks.files import compact_updates, read_updates
    from adtally.streaming.queries import batch_partition_writer
    path = shared_dir(spark, "test-updates")
    schema = "k long, n long"
    write = batch_partition_writer(f"{path}/log")
    rows = lambda *x: spark.createDataFrame(list(x), schema).coalesce(1)
    now = lambda: {r.k: r.n for r in read_updates(spark, path, ["k"], schema).collect()}
    assert now() == {} and compact_updates(spark, path, ["k"], schema) is None
    for b in range(6):
        early = read_updates(spark, path, ["k"], schema) if b else None
        before = now()
        write(rows((b % 2, b), (100 + b, b)), b)
        write(rows((b % 2, b), (100 + b, b)), b)  # the batch runs again
        if b in (2, 4):
            assert compact_updates(spark, path, ["k"], schema)
        if early is not None:
            assert {r.k: r.n for r in early.collect()} == before
        assert now() == {b % 2: b, **({(b + 1) % 2: b - 1} if b else {}), **{100 + i: i for i in range(b + 1)}}
    plan = read_updates(spark, path, ["k"], schema)._jdf.queryExecution().executedPlan().toString()
    assert "batch_id" in plan.split("PartitionFilters")[1].split("]")[0]  # the log up to the snapshot is pruned


def test_latest_per_key(spark):
    from adtally.sinks.files import latest_per_key
    log = spark.createDataFrame([(1, "a", 1, 0), (1, "a", 3, 2), (1, "a", 2, 1), (2, "b", 5, 0)],
                                "k long, d string, n long, batch_id long")
    assert sorted(tuple(r) for r in latest_per_key(log, ["k", "d"]).collect()) == [(1, "a", 3), (2, "b", 5)]
