"""End to end: records derived from the events table, written as files,
through the streaming job; results equal the batch queries on closed
windows and the dead letter equals the batch dead letter."""

from __future__ import annotations

from pyspark.sql import functions as F

from adtally import compact
from adtally.app import JobConfig, start
from adtally.config import shared_dir
from adtally.functions import codec
from adtally.plans.billing import partner_billing
from adtally.plans.display_metrics import display_metrics
from adtally.schemas import DISPLAY_KEY
from adtally.sources.tables import load_events
from adtally.sources.derived import topic_records
from adtally.sources.topics import kafka_options
from adtally.streaming.queries import display_table, read_result

SF = "/root/testdata/sf0.01"


def ordered(frame, cols):
    return sorted(tuple(r) for r in frame.select(*cols).collect())


def run_job(spark, base, **options):
    cfg = JobConfig(source="files", input=f"{base}/records", input_format="json", sink="parquet",
                    output=f"{base}/out", checkpoint_root=f"{base}/cp", available_now=True, **options)
    for q in start(spark, cfg).values():
        q.awaitTermination()
    return cfg


def test_job_on_record_files(spark):
    base = shared_dir(spark, "test-app")
    recs = topic_records(load_events(spark, SF))
    recs.repartition(3).write.json(f"{base}/records")
    cfg = run_job(spark, base)
    decoded = codec.decode_records(spark.read.schema(recs.schema).json(f"{base}/records"))
    good = codec.valid_events(decoded, envelope=True)
    # billing: closed windows equal batch
    got = read_result(spark, f"{base}/out/partner_billing")
    cut = good.where("kind = 'click'").agg(F.max("ts")).first()[0]
    want = partner_billing(good, cfg.rules).where(F.col("window_end") <= F.lit(cut).cast("timestamp_ntz"))
    cols = sorted(want.columns)
    assert ordered(got, cols) == ordered(want, cols) and got.count() > 0
    # display: the job's own table equals batch totals
    cols = [*DISPLAY_KEY, "impression_count", "click_count"]
    assert ordered(display_table(spark, f"{base}/out/display_metrics"), cols) == ordered(display_metrics(good), cols)
    compact.main(["--table", f"{base}/out/display_metrics"])
    assert ordered(display_table(spark, f"{base}/out/display_metrics"), cols) == ordered(display_metrics(good), cols)
    # dead letter: same rows as batch
    dl = spark.read.parquet(f"{base}/out/dead_letter")
    assert dl.count() == codec.dead_letter(decoded).count() > 0


def test_renamed_topics_equal_default(spark):
    from adtally.config import Topics
    base, other = shared_dir(spark, "test-app-names"), shared_dir(spark, "test-app-renamed")
    recs = topic_records(load_events(spark, "/root/testdata/sf0.001"))
    recs.coalesce(1).write.json(f"{base}/records")
    recs.withColumn("topic", F.concat(F.lit("prod-"), "topic")).coalesce(1).write.json(f"{other}/records")
    run_job(spark, base)
    run_job(spark, other, topics=Topics(impressed="prod-ad-impressed", clicked="prod-ad-clicked"))
    for name in ("partner_billing", "partner_group_metrics"):
        a, b = (read_result(spark, f"{d}/out/{name}", name) for d in (base, other))
        assert ordered(a, a.columns) == ordered(b, a.columns) and a.count() > 0
    a, b = (spark.read.parquet(f"{d}/out/dead_letter").drop("topic") for d in (base, other))
    assert ordered(a, a.columns) == ordered(b, a.columns)


def test_kafka_options():
    o = kafka_options("b:9092", ["ad-impressed", "ad-clicked"], maxOffsetsPerTrigger="1000")
    assert o["subscribe"] == "ad-impressed,ad-clicked"
    assert o["kafka.bootstrap.servers"] == "b:9092" and o["maxOffsetsPerTrigger"] == "1000"


def test_batch_job_reads_its_input_once(spark):
    from adtally.batch import run_batch
    from adtally.config import RECORD_ORDER, Rules
    from adtally.plans.group_metrics import partner_group_metrics
    base = shared_dir(spark, "test-batch")
    recs = topic_records(load_events(spark, "/root/testdata/sf0.001"))
    recs.write.json(f"{base}/records")
    reads = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    raw = spark.read.schema(recs.schema).json(f"{base}/records")
    paths = run_batch(spark, raw.mapInArrow(counted, raw.schema), f"{base}/out")
    assert reads.value == recs.count()  # each record was read and decoded once
    decoded = codec.decode_records(recs)
    good, rules = codec.valid_events(decoded, envelope=True), Rules(order=RECORD_ORDER)
    for name, fn in (("partner_billing", partner_billing), ("partner_group_metrics", partner_group_metrics),
                     ("display_metrics", display_metrics)):
        want = fn(good, rules)
        cols = sorted(want.columns)
        assert ordered(spark.read.parquet(paths[name]), cols) == ordered(want, cols), name
    assert spark.read.parquet(paths["dead_letter"]).count() == codec.dead_letter(decoded).count()


def test_cli_help():
    import pytest

    from adtally import app, batch, compact
    for main in (app.main, batch.main, compact.main):
        with pytest.raises(SystemExit) as e:
            main(["--help"])
        assert e.value.code == 0


def test_job_display_changelog_mode(spark):
    from adtally.plans.display_metrics import display_metrics_changelog
    base = shared_dir(spark, "test-app-changelog")
    recs = topic_records(load_events(spark, "/root/testdata/sf0.001"))
    recs.repartition(4).write.json(f"{base}/records")
    cfg = run_job(spark, base, display_mode="changelog")
    good = codec.valid_events(codec.decode_records(spark.read.schema(recs.schema).json(f"{base}/records")), envelope=True)
    got = spark.read.parquet(f"{base}/out/display_metrics").drop("batch_id")
    want = display_metrics_changelog(good, cfg.rules)
    cols = sorted(want.columns)
    assert ordered(got, cols) == ordered(want, cols)
