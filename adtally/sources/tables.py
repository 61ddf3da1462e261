"""Batch sources: the given parquet tables and the ad-event view over them.

``events`` (event_id, ts, user_id, event_type, value, props) is the only
stream-shaped table. ``ad_events`` turns it into impressions and clicks with
a fixed, deterministic rule (written once more as DuckDB SQL in
``adtally.oracle``):

* ``view`` -> impression, ``click`` -> click, other types are dropped;
* time is compressed 1440-fold from 2024-01-01 (30 days -> 30 minutes) so
  that minutes hold enough clicks for the fraud rule to fire;
* ``k = props.k``; clicks with ``k < 50`` are "hot" and concentrate on few
  placements, imitating the generator's fraud scenarios.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CLICK, DISPLAY_TARGETS, IMPRESSION, prepare_session
from ..schemas import EVENTS_TABLE_SCHEMA

# Fixed values of the view: epoch of the compressed clock and its factor.
VIEW_EPOCH = "2024-01-01 00:00:00"
TIME_COMPRESSION = 1440
HOT_K_BELOW = 50


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt round-robin over ``partitions`` tasks, or as it is.

    For CPU-heavy per-record work (JSON decode) on a source that arrives in
    few splits: one large file with a single row group, a topic with few
    partitions. The caller decides; a source that is already wide (the normal
    case at scale) needs no such exchange.
    """
    return df.repartition(partitions) if partitions else df


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table with its declared schema (no footer-reading
    inference job per query)."""
    prepare_session(spark)
    return spark.read.schema(EVENTS_TABLE_SCHEMA).parquet(table_path(sf_dir, "events"))


def compressed_ts_sql(ts: str = "ts") -> str:
    """2024-01-01 + (micros since then) div 1440, as TIMESTAMP_NTZ (SQL).

    Integer arithmetic on TIMESTAMP_NTZ: independent of the session zone.
    """
    epoch = f"TIMESTAMP_NTZ'{VIEW_EPOCH}'"
    return f"timestampadd(MICROSECOND, timestampdiff(MICROSECOND, {epoch}, `{ts}`) div {TIME_COMPRESSION}, {epoch})"


def compressed_ts(ts: str) -> Column:
    return F.expr(compressed_ts_sql(ts))


def ad_fields(events: DataFrame) -> DataFrame:
    """The ad fields of every ``events`` row (before choosing event types).

    Columns: event_id, ts, event_type, k, user_id and the typed ad fields.
    Written as SQL expressions: the projection is parsed on the JVM in one
    call instead of being assembled from hundreds of column objects.
    """
    hot = f"(event_type = 'click' AND k < {HOT_K_BELOW})"
    targets = ", ".join(f"'{t}'" for t in DISPLAY_TARGETS)
    # a one-element explode keeps later filters on columns derived from ``k``
    # above the parse, so that each row's JSON is parsed once
    base = events.selectExpr(
        "event_id", "event_type", "user_id",
        f"CAST({compressed_ts_sql('ts')} AS TIMESTAMP) AS ts",
        "explode(array(CAST(get_json_object(props, '$.k') AS BIGINT))) AS k",
        "CAST(round(value * 100) AS BIGINT) AS amount",
    )
    return base.selectExpr(
        "event_id", "ts", "event_type", "k", "user_id",
        f"IF(event_type = 'view', '{IMPRESSION}', '{CLICK}') AS kind",
        f"CAST(100 * (1 + IF({hot}, k % 3, user_id % 5)) AS BIGINT) AS partner_id",
        f"CAST(1 + IF({hot}, k % 2, (user_id div 5) % 5) AS BIGINT) AS group_id",
        f"CAST(1 + IF({hot}, k % 3, k % 8) AS BIGINT) AS product_id",
        f"element_at(array({targets}), CAST(k % 3 + 1 AS INT)) AS display_target",
        f"concat('display-', CAST(1 + IF({hot}, k % 3, k % 10) AS STRING)) AS display_id",
        "amount",
    )


AD_COLUMNS = ("event_id", "ts", "kind", "partner_id", "group_id", "product_id",
              "display_target", "display_id", "amount")


def ad_events(events: DataFrame, with_arrival: bool = False, kind: str | None = None) -> DataFrame:
    """Typed ad events (schema ``AD_EVENT_SCHEMA``) from the ``events`` table.

    Only projections and a pushed-down filter on ``event_type``: one narrow
    stage, no shuffle. ``kind`` restricts the view to impressions or clicks,
    which then reaches the scan as an equality. ``with_arrival`` adds ``arrival``: the
    position at which the row reaches the engine — ``event_id``, except
    that rows with ``k % 10 = 0`` arrive 40 positions late (the input of
    the late-record rule).
    """
    types = {IMPRESSION: ["view"], CLICK: ["click"]}.get(kind, ["view", "click"])
    f = ad_fields(events.where(F.col("event_type").isin(*types)))
    cols = list(AD_COLUMNS)
    if with_arrival:
        cols.append("CAST(event_id + IF(k % 10 = 0, 40, 0) AS BIGINT) AS arrival")
    return f.selectExpr(*cols)


def load_ad_events(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    return ad_events(load_events(spark, sf_dir), kind=kind)


def impressions(ad: DataFrame) -> DataFrame:
    return ad.where(F.col("kind") == IMPRESSION)


def clicks(ad: DataFrame) -> DataFrame:
    return ad.where(F.col("kind") == CLICK)
