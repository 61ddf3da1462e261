"""Session helpers and the fixed parameters of the ad-event rules.

Every parameter below is a default; the pipeline functions take them as
keyword arguments so a deployment can change them without code edits.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values that must equal the behaviour being reproduced.
# ---------------------------------------------------------------------------
# A click is fraudulent when it is the 11th or later click on the same key
# within one window ("more than 10").
FRAUD_CLICK_LIMIT = 10
# Tumbling window of the billing fold and of the fraud flags.
BILLING_WINDOW = "1 minute"
# Tumbling window of the partner-group metrics.
GROUP_WINDOW = "5 minutes"
# Windows close with no grace period.
DEFAULT_WATERMARK_DELAY = "0 seconds"
# Allowed values of displayTarget, case-sensitive.
DISPLAY_TARGETS = ("WEB", "MOBILE", "APP")
# Topic names and their defaults.
TOPIC_IMPRESSED = "ad-impressed"
TOPIC_CLICKED = "ad-clicked"
TOPIC_PARTNER_BILLING = "partner-billing-aggregation"
TOPIC_PARTNER_GROUP_METRICS = "partner-group-metrics"
TOPIC_DISPLAY_METRICS = "display-metrics"
TOPIC_DEAD_LETTER = "ad-streams-dlq"

# Salts of a placement's open window on streams: how many state rows (and
# tasks) the clicks of one placement are spread over. Part of the state key,
# so it must stay the same for the life of a checkpoint.
STATE_SALTS = 4
# Width of the time buckets that cut an open window's clicks in the state: an
# array holds the clicks of one placement in one bucket, divided by the salts.
# Part of the state key as well.
STATE_BUCKET = "1 second"

IMPRESSION = "impression"
CLICK = "click"

# Total order of events inside one key and window: event time, then a
# tie-break (event_id in the tables; topic, partition, offset of a record).
DEFAULT_ORDER = ("ts", "event_id")
RECORD_ORDER = ("ts", "topic", "partition", "offset")


@dataclass(frozen=True)
class Topics:
    """Source and sink names, overridable per deployment."""

    impressed: str = TOPIC_IMPRESSED
    clicked: str = TOPIC_CLICKED
    partner_billing: str = TOPIC_PARTNER_BILLING
    partner_group_metrics: str = TOPIC_PARTNER_GROUP_METRICS
    display_metrics: str = TOPIC_DISPLAY_METRICS
    dead_letter: str = TOPIC_DEAD_LETTER


@dataclass(frozen=True)
class Rules:
    """Parameters of the three results."""

    fraud_limit: int = FRAUD_CLICK_LIMIT
    billing_window: str = BILLING_WINDOW
    group_window: str = GROUP_WINDOW
    watermark_delay: str = DEFAULT_WATERMARK_DELAY
    order: tuple = field(default=DEFAULT_ORDER)


DEFAULT_RULES = Rules()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "adtally") -> SparkSession:
    """Create (or reuse) a session with the settings the pipelines assume.

    On a cluster the master, memory and checkpoint directory come from the
    submit configuration; here they are only filled in where unset.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    prepare_session(spark)
    return spark


def prepare_session(spark: SparkSession) -> SparkSession:
    """Settings every pipeline relies on; safe to call repeatedly.

    * Session time zone UTC: window bounds are compared as wall-clock
      TIMESTAMP_NTZ at the output edge.
    * A checkpoint directory: taken from ``spark.checkpoint.dir`` when the
      cluster names one; only a test session without it gets a default.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    base = checkpoint_base(spark)
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(base)
    except Exception:  # noqa: BLE001 - no SparkContext handle (Spark Connect)
        pass
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a session on a local master (a test) may leave it unset and gets a
    local default; anywhere else that is an error, because executors would
    write to folders that nobody else can read.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001
            base = None
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.split("[")[0] == "local":
            raise ValueError(f"spark.checkpoint.dir must name a folder shared by the cluster (master {master!r})")
        base = os.environ.get("ADTALLY_CHECKPOINT_DIR", "/tmp/adtally-checkpoints")
    return base.rstrip("/")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    Used for streaming checkpoints and written intermediate tables; never a
    machine-local temporary folder.
    """
    prepare_session(spark)
    base = checkpoint_base(spark)
    return f"{base}/adtally/{purpose}-{uuid.uuid4().hex}"
