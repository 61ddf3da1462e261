"""Result records with their window as record headers, and the consumer that
reads each result once.

A Kafka sink is at least once: a micro-batch that fails after some records were
sent is sent again. The window bounds in the headers identify a result row
without opening its value, so a consumer drops repeats by record key and window,
with state only for windows that can still be repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codec import encode_records

HEADERS = ("window_start", "window_end")
# How long after a window's end (in event time) a repeat may arrive.
REPEAT_WITHIN = "1 hour"


def result_records(rows: DataFrame, key: Sequence[str], fields: Sequence[tuple[str, str]]) -> DataFrame:
    """(key, value, headers) of windowed result rows; a header is (name, UTF-8
    time), as Spark's Kafka sink takes them."""
    header = [F.struct(F.lit(h).alias("key"), F.date_format(h, "yyyy-MM-dd HH:mm:ss").cast("binary").alias("value")) for h in HEADERS]
    return encode_records(rows.select("*", F.array(*header).alias("headers")), key, fields, keep=("headers",))


def unique_results(records: DataFrame, within: str = REPEAT_WITHIN) -> DataFrame:
    """A stream of result records with ``headers`` as (key, value, window_start,
    window_end), each key and window once."""
    times = [F.col("headers")[i]["value"].cast("string").cast("timestamp").alias(h) for i, h in enumerate(HEADERS)]
    rows = records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *times)
    return rows.withWatermark("window_end", within).dropDuplicatesWithinWatermark(["key", "window_start"])
