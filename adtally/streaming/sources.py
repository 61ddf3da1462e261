"""Streaming sources: the events table read as a file stream, one stream per
kind of event, as the topics are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import CLICK, IMPRESSION, prepare_session
from ..schemas import EVENTS_TABLE_SCHEMA
from ..sources.tables import ad_events, table_path


def require_path(spark: SparkSession, path: str) -> str:
    """``path`` if it exists; a stream over nothing would wait for ever."""
    try:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no SparkContext handle (Spark Connect): the reader will tell
        return path
    found = jvm.org.apache.hadoop.fs.Path(path)
    if not found.getFileSystem(conf).exists(found):
        raise FileNotFoundError(path)
    return path


def event_file_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """``events.parquet`` of a folder, one file or a folder of files, as a
    stream with the declared schema."""
    prepare_session(spark)
    path = require_path(spark, table_path(sf_dir, "events"))
    reader = spark.readStream.schema(EVENTS_TABLE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    # as a pattern: the file source takes a folder, or a glob that names one file
    return reader.parquet(path[:-1] + f"[{path[-1]}]")


def ad_event_streams(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(impressions, clicks) of the ad-event view, each a source of its own."""
    return tuple(ad_events(event_file_stream(spark, sf_dir, max_files_per_trigger), kind=k) for k in (IMPRESSION, CLICK))
