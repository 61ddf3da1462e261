"""The Kafka source of the event topics.

``kafka_records`` reads the two event topics with Spark's Kafka source
(key/value as text plus topic, partition, offset and record timestamp). The
Kafka connector jar is not part of this environment, so that path is written
against Spark's documented options but only exercised through its option
builder in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import TOPIC_CLICKED, TOPIC_IMPRESSED


def kafka_options(bootstrap_servers: str, topics: list[str], starting_offsets: str = "earliest",
                  min_partitions: int | None = None, **extra: str) -> dict[str, str]:
    """Options of Spark's Kafka source for the event topics.

    ``min_partitions`` splits topic partitions into more Spark tasks
    (decode is CPU-heavy; a topic may have fewer partitions than cores).
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting_offsets,
        "includeHeaders": "false",
    }
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    opts.update(extra)
    return opts


def kafka_records(spark: SparkSession, bootstrap_servers: str,
                  topics: tuple[str, ...] = (TOPIC_IMPRESSED, TOPIC_CLICKED),
                  streaming: bool = True, **extra: str) -> DataFrame:
    """Kafka records with key and value as text (needs the Kafka connector)."""
    reader = spark.readStream if streaming else spark.read
    df = reader.format("kafka").options(**kafka_options(bootstrap_servers, list(topics), **extra)).load()
    return df.select("topic", "partition", "offset", "timestamp",
                     F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"))
