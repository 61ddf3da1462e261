"""The batch (backfill) job: records in, the three results and the dead
letter out, as parquet tables.

    python -m adtally.batch --input <records> --input-format json --output <folder>

The records are read and decoded once, into a table in the output folder
(good and bad rows, partitioned by kind); the dead letter and the three results
are computed from that table. Writing it cuts the lineage: a lost executor
re-reads the table instead of decoding the JSON again.
"""

from __future__ import annotations

import argparse
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from .app import add_topic_flags, topics_of
from .config import DEFAULT_RULES, RECORD_ORDER, Rules, Topics, get_session
from .functions import codec
from .plans.billing import partner_billing
from .plans.display_metrics import display_metrics
from .plans.group_metrics import partner_group_metrics
from .schemas import RAW_RECORD_SCHEMA
from .sinks.files import write_table
from .sources.tables import spread


def run_batch(spark: SparkSession, records: DataFrame, output: str, rules: Rules = replace(DEFAULT_RULES, order=RECORD_ORDER),
              event_time: str = "record", topics: Topics = Topics(), partitions: int | None = None) -> dict[str, str]:
    """Decode once into a table, then the dead letter and the three results
    from that table. ``partitions`` deals records of a narrow source over so
    many tasks first. Returns name -> table path."""
    out = output.rstrip("/")
    decoded = codec.decode_records(spread(records, partitions), event_time, topics)
    paths = {"decoded": write_table(decoded, f"{out}/decoded", partition_by=["kind"])}
    decoded = spark.read.schema(decoded.schema).parquet(paths["decoded"])
    events = codec.valid_events(decoded, envelope=True)
    paths["dead_letter"] = write_table(codec.dead_letter(decoded), f"{out}/dead_letter")
    paths["partner_billing"] = write_table(partner_billing(events, rules), f"{out}/partner_billing")
    paths["partner_group_metrics"] = write_table(partner_group_metrics(events, rules),
                                                 f"{out}/partner_group_metrics")
    paths["display_metrics"] = write_table(display_metrics(events, rules), f"{out}/display_metrics")
    return paths


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--input", required=True)
    p.add_argument("--input-format", choices=["parquet", "json"], default="parquet")
    p.add_argument("--output", required=True)
    p.add_argument("--event-time", choices=["record", "payload"], default="record")
    p.add_argument("--partitions", type=int, help="deal the records over so many tasks before decoding")
    add_topic_flags(p)
    a = p.parse_args(argv)
    spark = get_session()
    records = spark.read.schema(RAW_RECORD_SCHEMA).format(a.input_format).load(a.input)
    for name, path in run_batch(spark, records, a.output, event_time=a.event_time, topics=topics_of(a),
                                 partitions=a.partitions).items():
        print(name, path)


if __name__ == "__main__":
    main()
