"""Sinks: parquet tables, Kafka-style (key, value) records, and the log of an
update stream with its compaction.

Outputs go to the shared folder named by ``spark.checkpoint.dir`` (or a
path given by the caller), never to a machine-local folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import shared_dir
from ..functions.codec import encode_records


def exists(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)
    except Exception:  # noqa: BLE001 - no JVM handle: let the reader decide
        return True


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = ()) -> str:
    """Write parquet; returns the path. File commit is atomic per job, so a
    retried task or a lost executor leaves no partial output."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def roundtrip(spark: SparkSession, df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table and return the table read back."""
    path = path or shared_dir(spark, f"sink-{name}")
    write_table(df, path)
    return spark.read.parquet(path)


def kafka_sink_frame(df: DataFrame, key_cols: Sequence[str], fields: Sequence[tuple[str, str]],
                     topic: str | None = None) -> DataFrame:
    """The (key, value[, topic]) frame Spark's Kafka sink expects."""
    out = encode_records(df, key_cols, fields)
    return out.withColumn("topic", F.lit(topic)) if topic else out


def write_kafka(df: DataFrame, bootstrap_servers: str, topic: str, key_cols: Sequence[str],
                fields: Sequence[tuple[str, str]]) -> None:
    """Batch write to Kafka (needs the Kafka connector on the classpath)."""
    (kafka_sink_frame(df, key_cols, fields)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("topic", topic)
        .save())


def read_updates(spark: SparkSession, path: str, key: Sequence[str], schema: str) -> DataFrame:
    """The newest row per key of an update log, with its ``batch_id``.

    ``path``/log has the updates, a partition ``batch_id`` per micro-batch;
    ``path``/snapshots has a row per compaction (``upto``, ``folder``). The last
    snapshot stands for the log up to ``upto``, whose partitions are pruned.
    """
    columns = f"{schema}, batch_id long"
    found = spark.read.parquet(f"{path}/snapshots").orderBy(F.desc("upto")).first() if exists(spark, f"{path}/snapshots") else None
    log = (spark.read.schema(columns).parquet(f"{path}/log") if exists(spark, f"{path}/log") else spark.createDataFrame([], columns))
    if found:
        log = log.where(F.col("batch_id") > found.upto).unionByName(spark.read.schema(columns).parquet(found.folder))
    return latest_per_key(log, key, keep_version=True)


def compact_updates(spark: SparkSession, path: str, key: Sequence[str], schema: str) -> str | None:
    """Batch job: write the newest rows so far as a snapshot in a folder of its
    own and add its row to ``path``/snapshots, which is what makes readers
    use it. Nothing is deleted or rewritten: a reader that listed its
    files before goes on, and a compaction that fails midway is never seen. Log
    partitions up to ``upto`` and older snapshots can be expired by the store's
    own rules once no reader is that old. Returns the folder."""
    rows = read_updates(spark, path, key, schema)
    folder = f"{path}/compacted/{uuid.uuid4().hex}"
    write_table(rows, folder)
    upto = spark.read.parquet(folder).agg(F.max("batch_id")).first()[0]
    if upto is None:
        return None
    spark.createDataFrame([(upto, folder)], "upto long, folder string").coalesce(1).write.mode("append").parquet(f"{path}/snapshots")
    return folder


def latest_per_key(updates: DataFrame, key: Sequence[str], version: str = "batch_id", keep_version: bool = False) -> DataFrame:
    """Collapse an update log (one row per changed key per micro-batch) to
    the newest row per key: the state an upserting consumer ends with.
    A partial aggregate (max_by), so a hot key is combined map-side."""
    value_cols = [c for c in updates.columns if c not in (*key, version)]
    latest = F.max_by(F.struct(*value_cols), F.col(version))
    out = updates.groupBy(*key).agg(latest.alias("_v"), F.max(version).alias(version))
    return out.select(*key, "_v.*", *([version] if keep_version else []))
