"""Starting streams, reading what they wrote, and the registered streams.

Plans live beside this module: ``windowed`` (billing, group metrics, group
fraud: chained append-mode aggregates), ``display`` (totals and changelog),
``late`` (the per-record late rule). A windowed result row is written once; a
retried micro-batch replaces its own output, so results are exactly once with
the checkpoint.

``run_*`` start a query with ``availableNow`` (or a processing-time trigger) and
a checkpoint under the shared checkpoint folder; a restarted job resumes where
it stopped. The ``stream_*`` registry entries run a stream over the whole events
table and return what the sink holds.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CLICK, DEFAULT_RULES, IMPRESSION, STATE_BUCKET, STATE_SALTS, Rules, shared_dir
from ..functions import codec
from ..plans.billing import partner_billing
from ..schemas import AD_EVENT_SCHEMA, DISPLAY_KEY
from ..sinks.files import compact_updates, exists, read_updates
from ..sources.derived import DERIVED_PARTITIONS, topic_records
from ..sources.tables import ad_events, load_ad_events, load_events
from .consume import result_records, unique_results
from .display import changelog_rows, changelog_stream, display_metrics_stream
from .late import late_rows, late_stream
from .sources import ad_event_streams, event_file_stream
from .windowed import WINDOWED_RESULTS

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def batch_partition_writer(path: str, transform: Callable[[DataFrame], DataFrame] = lambda df: df):
    """foreachBatch function: ``transform(micro-batch)`` goes to its own
    ``batch_id`` partition; a retried batch overwrites that partition only."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (transform(batch).withColumn("batch_id", F.lit(batch_id).cast("long"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("batch_id").parquet(path))
    return write


def persisted(write: Callable[[DataFrame, int], None]):
    """A foreachBatch function over the micro-batch computed once: for writers
    that read it more than once (and so would run its stateful steps again)."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            write(batch, batch_id)
        finally:
            batch.unpersist()
    return run


def fan_out_writer(outputs: dict[str, Callable[[DataFrame], DataFrame]], path: str):
    """foreachBatch function: one micro-batch, several outputs, each under
    ``path``/name with a partition per micro-batch."""
    writers = [batch_partition_writer(f"{path}/{name}", transform) for name, transform in outputs.items()]

    def write(batch: DataFrame, batch_id: int) -> None:
        for w in writers:
            w(batch, batch_id)
    return persisted(write)


def start_stream(stream: DataFrame, mode: str, writer, checkpoint: str, available_now: bool,
           processing_time: str | None):
    w = (stream.writeStream.outputMode(mode).foreachBatch(writer)
               .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start()


def run_windowed(result: str, imp: DataFrame, clk: DataFrame, path: str, checkpoint: str, rules: Rules = DEFAULT_RULES,
                 available_now: bool = True, processing_time: str | None = None,
                 salts: int = STATE_SALTS, writer=None, bucket: str = STATE_BUCKET):
    """Start a windowed result stream over impressions and clicks; result rows
    go under ``path`` (or to ``writer(rows, batch_id)`` when given, e.g. a
    Kafka writer)."""
    stream = WINDOWED_RESULTS[result](imp, clk, rules, salts, bucket)
    return start_stream(stream, "append", writer or batch_partition_writer(path), checkpoint, available_now, processing_time)


def run_append(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
               processing_time: str | None = None, partition_by: list[str] | None = None):
    """Start an append stream into a parquet file sink, exactly once through
    the sink's commit log."""
    w = (stream.writeStream.format("parquet").outputMode("append").partitionBy(*(partition_by or []))
               .option("path", path).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start()


def run_update(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True,
               processing_time: str | None = None):
    """Start the display totals stream: its updates go to the log under
    ``path`` (one row per display that changed in a micro-batch)."""
    return start_stream(stream, "update", batch_partition_writer(f"{path}/log"), checkpoint, available_now, processing_time)


def display_table(spark: SparkSession, path: str) -> DataFrame:
    """The newest totals per display, with the micro-batch they come from."""
    return read_updates(spark, path, DISPLAY_KEY, RESULT_SCHEMAS["display_metrics"])


def compact_display(spark: SparkSession, path: str) -> str | None:
    """Batch job beside the stream: see ``sinks.files.compact_updates``."""
    return compact_updates(spark, path, DISPLAY_KEY, RESULT_SCHEMAS["display_metrics"])


def run_changelog(imp: DataFrame, clk: DataFrame, path: str, checkpoint: str, rules: Rules = DEFAULT_RULES,
                  available_now: bool = True, processing_time: str | None = None, writer=None):
    """Start the display changelog: rows go under ``path`` or to ``writer``."""
    put = writer or batch_partition_writer(path)
    sink = persisted(lambda batch, batch_id: put(changelog_rows(batch, rules), batch_id))
    return start_stream(changelog_stream(imp, clk, rules), "append", sink, checkpoint, available_now, processing_time)


def run_late(clicks: DataFrame, path: str, checkpoint: str, rules: Rules = DEFAULT_RULES, available_now: bool = True,
             processing_time: str | None = None):
    """Start the per-record late rule over clicks with ``partition`` and ``arrival``."""
    put = batch_partition_writer(path, lambda batch: late_rows(batch, rules))
    return start_stream(late_stream(clicks), "append", persisted(put), checkpoint, available_now, processing_time)


RESULT_SCHEMAS = {
    "partner_billing": ("partner_id long, aggregated_amount long, fraudulent_amount long, "
                        "total_billing_amount long, window_start timestamp_ntz, window_end timestamp_ntz"),
    "partner_group_metrics": ("partner_id long, group_id long, impression_count long, click_count long, "
                              "fraudulent_click_count long, fraudulent_amount long, "
                              "window_start timestamp_ntz, window_end timestamp_ntz"),
    "group_fraud_5min": ("partner_id long, group_id long, window_start timestamp_ntz, window_end timestamp_ntz, "
                         "fraudulent_click_count long, fraudulent_amount long"),
    "display_metrics": ("partner_id long, group_id long, display_target string, display_id string, "
                        "impression_count long, click_count long, emitted_at timestamp"),
    "display_changelog": ("partner_id long, group_id long, display_target string, display_id string, "
                          "event_id long, ts timestamp_ntz, impression_count long, click_count long"),
    "late_clicks": ("event_id long, arrival long, ts timestamp, window_start timestamp, window_end timestamp, "
                    "seen_max_ts timestamp, is_late boolean"),
    "good": "topic string, partition int, offset long",
    "dead_letter": "topic string, partition int, offset long, error_reason string",
    "result_records": "key string, value string, window_start timestamp, window_end timestamp",
}
RESULT_SCHEMAS["partner_group_metrics_join"] = RESULT_SCHEMAS["partner_group_metrics"]


def read_log(spark: SparkSession, path: str, result: str) -> DataFrame:
    """A sink table with its ``batch_id`` partitions; empty (with the right
    schema) when no micro-batch has written rows yet."""
    schema = RESULT_SCHEMAS[result] + ", batch_id long"
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_result(spark: SparkSession, path: str, result: str = "partner_billing") -> DataFrame:
    """Rows of a windowed result table (each written once)."""
    return read_log(spark, path, result).drop("batch_id")


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Number of state partitions of streams *started* inside the block
    (``spark.sql.shuffle.partitions`` when a checkpoint is created; it is then
    fixed for that checkpoint). Default: the cluster's cores."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        n = n or spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no SparkContext handle
        n = int(old)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield n
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@contextmanager
def rocksdb_state(spark: SparkSession):
    """Streams started inside the block keep their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(name, old) if old else spark.conf.unset(name)


def _run_to_table(spark: SparkSession, sf_dir: str, result: str) -> DataFrame:
    base = shared_dir(spark, f"stream-{result}")
    with state_partitions(spark):
        q = run_windowed(result, *ad_event_streams(spark, sf_dir), f"{base}/out", f"{base}/checkpoint")
        q.awaitTermination()
    return read_result(spark, f"{base}/out", result)


def stream_partner_billing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_to_table(spark, sf_dir, "partner_billing")


def stream_group_fraud_5min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_to_table(spark, sf_dir, "group_fraud_5min")


def stream_partner_group_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_to_table(spark, sf_dir, "partner_group_metrics")


def stream_partner_group_metrics_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by two stream-stream left joins of three windowed aggregates."""
    return _run_to_table(spark, sf_dir, "partner_group_metrics_join")


def stream_display_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream-display")
    with state_partitions(spark):
        q = run_update(display_metrics_stream(*ad_event_streams(spark, sf_dir)), f"{base}/table", f"{base}/checkpoint")
        q.awaitTermination()
    return display_table(spark, f"{base}/table").select(*DISPLAY_KEY, "impression_count", "click_count")


def stream_display_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = shared_dir(spark, "stream-display-changelog")
    with state_partitions(spark):
        q = run_changelog(*ad_event_streams(spark, sf_dir), f"{base}/log", f"{base}/checkpoint")
        q.awaitTermination()
    return read_log(spark, f"{base}/log", "display_changelog").drop("batch_id")


def quarters(rows: DataFrame, by) -> list[DataFrame]:
    """``rows`` in four arrivals: the quarters of the range of ``by`` (a long)."""
    lo, hi = rows.agg(F.min(by), F.max(by)).first()
    quarter = F.floor((by - F.lit(lo or 0)) * 4 / F.lit((hi or 0) - (lo or 0) + 1))
    return [rows.where(quarter == n) for n in range(4)]


def in_arrivals(spark: SparkSession, base: str, arrivals: list[DataFrame], start: Callable[[DataFrame], object]) -> None:
    """Write each arrival into a folder and run the stream that ``start`` makes
    of the folder until it has read it: a restart from the checkpoint each time."""
    with state_partitions(spark):
        for n, rows in enumerate(arrivals):
            rows.write.parquet(f"{base}/in/part={n}")
            stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
            start(stream).awaitTermination()


def _by_kind(stream: DataFrame) -> tuple[DataFrame, DataFrame]:
    return tuple(stream.where(F.col("kind") == k) for k in (IMPRESSION, CLICK))


def stream_display_update_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The display totals' updates over four time-ordered arrivals, a trigger
    each: one row per display that changed, however many events changed it."""
    base = shared_dir(spark, "stream-updates")
    arrivals = quarters(load_ad_events(spark, sf_dir), F.unix_micros("ts"))
    in_arrivals(spark, base, arrivals, lambda s: run_update(display_metrics_stream(*_by_kind(s)), f"{base}/table", f"{base}/checkpoint"))
    log = read_log(spark, f"{base}/table/log", "display_metrics")
    return log.select(F.col("batch_id").alias("trigger"), *DISPLAY_KEY, "impression_count", "click_count")


def stream_display_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The display changelog over four time-ordered arrivals, restarted for
    each: the displays' totals come from the state store."""
    base = shared_dir(spark, "stream-display-restart")
    arrivals = quarters(load_ad_events(spark, sf_dir), F.unix_micros("ts"))
    in_arrivals(spark, base, arrivals, lambda s: run_changelog(*_by_kind(s), f"{base}/log", f"{base}/checkpoint"))
    return read_log(spark, f"{base}/log", "display_changelog").drop("batch_id")


def stream_late_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The per-record late rule over clicks that arrive in four parts."""
    base = shared_dir(spark, "stream-late")
    clicks = ad_events(load_events(spark, sf_dir), with_arrival=True, kind=CLICK)
    clicks = clicks.select("event_id", "arrival", "ts", (F.col("event_id") % DERIVED_PARTITIONS).alias("partition"))
    in_arrivals(spark, base, quarters(clicks, F.col("arrival")), lambda s: run_late(s, f"{base}/out", f"{base}/checkpoint"))
    out = read_log(spark, f"{base}/out", "late_clicks").drop("batch_id")
    times = ("ts", "window_start", "window_end", "seen_max_ts")
    return out.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in times else c for c in out.columns])


def stream_decode_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One read of the records, decoded once, two outputs: good events and dead
    letters, by their place in the topics."""
    base = shared_dir(spark, "stream-fanout")
    decoded = codec.decode_records(topic_records(event_file_stream(spark, sf_dir)))
    place = ("topic", "partition", "offset")
    outputs = {"good": lambda b: codec.valid_events(b, envelope=True).select(*place),
               "dead_letter": lambda b: codec.dead_letter(b).select(*place, "error_reason")}
    q = start_stream(decoded, "append", fan_out_writer(outputs, base), f"{base}/checkpoint", True, None)
    q.awaitTermination()
    good, dead = (read_log(spark, f"{base}/{name}", name).drop("batch_id").withColumn("output", F.lit(name)) for name in outputs)
    return good.withColumn("error_reason", F.lit(None).cast("string")).unionByName(dead)


def stream_result_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing records as a producer that retries leaves them in the topic (the
    records of every second minute twice), read by a consumer that
    keeps one per key and window."""
    base = shared_dir(spark, "stream-dedup")
    records = result_records(partner_billing(load_ad_events(spark, sf_dir, CLICK)), ["partner_id"], codec.BILLING_JSON_FIELDS)
    minute = F.floor(F.unix_seconds(F.col("headers")[0]["value"].cast("string").cast("timestamp")) / 60)
    again = records.where(minute % 2 == 0)
    in_arrivals(spark, base, [records, again], lambda s: run_append(unique_results(s), f"{base}/out", f"{base}/checkpoint"))
    out = spark.read.schema(RESULT_SCHEMAS["result_records"]).parquet(f"{base}/out")
    return out.select("key", "value", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")])


def stream_billing_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Billing over the whole table in four time-ordered arrivals: two under a
    processing-time trigger, then stopped, two more, and restarted from the
    checkpoint. State is in RocksDB."""
    base = shared_dir(spark, "stream-restart")
    arrivals = quarters(load_ad_events(spark, sf_dir, CLICK), F.unix_micros("ts"))

    def arrive(n: int) -> None:
        arrivals[n].write.parquet(f"{base}/in/part={n}")

    def start(**how):
        files = (spark.readStream.schema(AD_EVENT_SCHEMA).option("maxFilesPerTrigger", "1")
                 .option("recursiveFileLookup", "true").parquet(f"{base}/in"))
        return run_windowed("partner_billing", files, files, f"{base}/out", f"{base}/checkpoint", **how)

    with state_partitions(spark), rocksdb_state(spark):
        arrive(0)
        arrive(1)
        q = start(available_now=False, processing_time="1 second")
        q.processAllAvailable()
        q.stop()
        arrive(2)
        arrive(3)
        start().awaitTermination()
    return read_result(spark, f"{base}/out")


STREAMS = (stream_partner_billing, stream_group_fraud_5min, stream_partner_group_metrics, stream_partner_group_metrics_join,
           stream_display_metrics, stream_display_changelog, stream_display_update_log, stream_display_restart,
           stream_late_clicks, stream_decode_fanout, stream_result_dedup, stream_billing_restart)
