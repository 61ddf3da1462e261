"""The streaming job: event topics in, three result streams and a dead
letter out.

    python -m adtally.app --source kafka --bootstrap host:9092 \\
        --sink kafka --output s3://bucket/adtally --checkpoint-root s3://bucket/adtally/cp
    python -m adtally.app --source files --input /shared/records \\
        --sink parquet --output /shared/results --available-now

Sources: Kafka (topics ``ad-impressed``, ``ad-clicked`` unless named
otherwise), or a folder of record files with the same envelope columns (topic,
partition, offset, timestamp, key, value) as parquet or JSON lines.

A first query reads and decodes each record once into the table ``decoded``
under the output folder (partitioned by kind); the results and the dead letter
are streams over that table, reading only their columns and kinds. Impressions
and clicks are two sources with a watermark each; ``watermark_policy`` says
which one counts ("min" waits for the slower topic; "max" lets an idle topic
lag, and drops its rows that then come late).

Each result is its own streaming query with its own checkpoint: exactly once
into files, at least once into Kafka (record key: partner[:group]; the window
bounds are in the value and in the headers, by which ``streaming.consume``
reads each result once). ``adtally.compact`` compacts the display totals' log.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import CLICK, DEFAULT_RULES, IMPRESSION, RECORD_ORDER, STATE_BUCKET, STATE_SALTS, Rules, Topics, checkpoint_base, get_session
from .functions import codec
from .schemas import DISPLAY_KEY, RAW_RECORD_SCHEMA
from .sources.topics import kafka_records
from .streaming.consume import result_records
from .streaming.queries import ROCKSDB_PROVIDER, display_metrics_stream, run_append, run_changelog, run_update, run_windowed


@dataclass
class JobConfig:
    source: str = "files"              # "files" | "kafka"
    input: str | None = None           # folder of record files
    input_format: str = "parquet"      # "parquet" | "json"
    bootstrap: str | None = None
    sink: str = "parquet"              # "parquet" | "kafka"
    output: str | None = None          # results, and the decoded table
    checkpoint_root: str | None = None
    available_now: bool = False
    trigger: str = "1 second"          # commit interval of the reference
    max_per_trigger: int | None = None
    rocksdb: bool = True
    state_salts: int = STATE_SALTS     # fixed for the life of a checkpoint
    state_bucket: str = STATE_BUCKET   # likewise
    display_mode: str = "totals"       # "totals" (update mode) | "changelog" (one row per impression)
    event_time: str = "record"         # "record" | "payload"
    watermark_policy: str = "min"      # "min" | "max", see above
    topics: Topics = Topics()
    rules: Rules = replace(DEFAULT_RULES, order=RECORD_ORDER)


def record_stream(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    if cfg.source == "kafka":
        extra = {"maxOffsetsPerTrigger": str(cfg.max_per_trigger)} if cfg.max_per_trigger else {}
        return kafka_records(spark, cfg.bootstrap, (cfg.topics.impressed, cfg.topics.clicked), **extra)
    reader = spark.readStream.schema(RAW_RECORD_SCHEMA)
    if cfg.max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(cfg.max_per_trigger))
    return reader.format(cfg.input_format).load(cfg.input)


def start(spark: SparkSession, cfg: JobConfig) -> dict:
    """Start the streaming queries; returns name -> StreamingQuery. With
    ``available_now`` the decoding query has ended when this returns."""
    if cfg.rocksdb:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", cfg.watermark_policy)
    cp_root = (cfg.checkpoint_root or f"{checkpoint_base(spark)}/adtally").rstrip("/")
    table = f"{(cfg.output or cp_root).rstrip('/')}/decoded"
    started = {}

    decoded = codec.decode_records(record_stream(spark, cfg), cfg.event_time, cfg.topics)
    started["decoded"] = run_append(decoded, table, f"{cp_root}/decoded", cfg.available_now, cfg.trigger, ["kind"])
    if cfg.available_now:
        started["decoded"].awaitTermination()

    def rows() -> DataFrame:
        return spark.readStream.schema(decoded.schema).parquet(table)

    imp, clk = (codec.valid_events(rows().where(F.col("kind") == k), envelope=True) for k in (IMPRESSION, CLICK))

    def kafka_writer(key, names, topic, encode=result_records):
        def write(out: DataFrame, batch_id: int) -> None:
            (encode(out, key, names).write.format("kafka")
                 .option("kafka.bootstrap.servers", cfg.bootstrap).option("topic", topic).save())
        return write

    windowed = {
        "partner_billing": (["partner_id"], codec.BILLING_JSON_FIELDS, cfg.topics.partner_billing),
        "partner_group_metrics": (["partner_id", "group_id"], codec.GROUP_JSON_FIELDS,
                                  cfg.topics.partner_group_metrics),
    }
    for name, (key, names, topic) in windowed.items():
        writer = kafka_writer(key, names, topic) if cfg.sink == "kafka" else None
        started[name] = run_windowed(name, imp, clk, f"{cfg.output}/{name}", f"{cp_root}/{name}", cfg.rules,
                                     cfg.available_now, cfg.trigger, cfg.state_salts, writer, cfg.state_bucket)
    where, checkpoint = f"{cfg.output}/display_metrics", f"{cp_root}/display_metrics"
    if cfg.display_mode == "changelog":
        writer = (kafka_writer(list(DISPLAY_KEY), codec.DISPLAY_JSON_FIELDS, cfg.topics.display_metrics, codec.encode_records)
                  if cfg.sink == "kafka" else None)
        started["display_metrics"] = run_changelog(imp, clk, where, checkpoint, cfg.rules, cfg.available_now, cfg.trigger, writer)
    elif cfg.sink == "kafka":
        out = codec.encode_records(display_metrics_stream(imp, clk), list(DISPLAY_KEY), codec.STREAM_DISPLAY_JSON_FIELDS)
        started["display_metrics"] = _to_kafka(out, "update", cfg, cfg.topics.display_metrics, checkpoint)
    else:
        started["display_metrics"] = run_update(display_metrics_stream(imp, clk), where, checkpoint, cfg.available_now, cfg.trigger)
    dead = codec.dead_letter(rows())
    if cfg.sink == "kafka":
        out = dead.select("key", F.to_json(F.struct(*dead.columns)).alias("value"))
        started["dead_letter"] = _to_kafka(out, "append", cfg, cfg.topics.dead_letter, f"{cp_root}/dead_letter")
    else:
        started["dead_letter"] = run_append(dead, f"{cfg.output}/dead_letter", f"{cp_root}/dead_letter",
                                            cfg.available_now, cfg.trigger)
    return started


def _to_kafka(out: DataFrame, mode: str, cfg: JobConfig, topic: str, checkpoint: str):
    w = (out.writeStream.format("kafka").outputMode(mode).option("kafka.bootstrap.servers", cfg.bootstrap)
            .option("topic", topic).option("checkpointLocation", checkpoint))
    return (w.trigger(availableNow=True) if cfg.available_now else w.trigger(processingTime=cfg.trigger)).start()


def add_topic_flags(p: argparse.ArgumentParser) -> None:
    """A flag for every topic name, e.g. --topic-impressed."""
    for f in fields(Topics):
        p.add_argument(f"--topic-{f.name.replace('_', '-')}", default=f.default)


def topics_of(a: argparse.Namespace) -> Topics:
    return Topics(**{f.name: getattr(a, f"topic_{f.name}") for f in fields(Topics)})


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--source", choices=["files", "kafka"], default="files")
    p.add_argument("--input")
    p.add_argument("--input-format", choices=["parquet", "json"], default="parquet")
    p.add_argument("--bootstrap")
    p.add_argument("--sink", choices=["parquet", "kafka"], default="parquet")
    p.add_argument("--output")
    p.add_argument("--checkpoint-root")
    p.add_argument("--available-now", action="store_true")
    p.add_argument("--trigger", default="1 second")
    p.add_argument("--max-per-trigger", type=int)
    p.add_argument("--watermark-delay", default=DEFAULT_RULES.watermark_delay)
    p.add_argument("--fraud-limit", type=int, default=DEFAULT_RULES.fraud_limit)
    p.add_argument("--state-salts", type=int, default=STATE_SALTS)
    p.add_argument("--state-bucket", default=STATE_BUCKET)
    p.add_argument("--display-mode", choices=["totals", "changelog"], default="totals")
    p.add_argument("--event-time", choices=["record", "payload"], default="record")
    p.add_argument("--watermark-policy", choices=["min", "max"], default="min")
    add_topic_flags(p)
    a = p.parse_args(argv)
    rules = Rules(fraud_limit=a.fraud_limit, watermark_delay=a.watermark_delay,
                  order=RECORD_ORDER)
    cfg = JobConfig(source=a.source, input=a.input, input_format=a.input_format, bootstrap=a.bootstrap,
                    sink=a.sink, output=a.output, checkpoint_root=a.checkpoint_root,
                    available_now=a.available_now, trigger=a.trigger, max_per_trigger=a.max_per_trigger,
                    state_salts=a.state_salts, state_bucket=a.state_bucket, display_mode=a.display_mode, event_time=a.event_time,
                    watermark_policy=a.watermark_policy, topics=topics_of(a), rules=rules)
    spark = get_session()
    queries = start(spark, cfg)
    for q in queries.values():
        q.awaitTermination()


if __name__ == "__main__":
    main()
