"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is fully materialised (written to a no-op sink) after one
untimed warm-up; the reported time per query is the median of the runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from adtally.catalog import queries  # noqa: E402
from adtally.config import get_session  # noqa: E402

HEADLINE = (
    "partner_billing", "click_aggregation_1min", "partner_group_metrics",
    "partner_group_metrics_join", "display_metrics", "display_metrics_changelog",
    "display_metrics_asof", "late_click_filter", "decode_valid_only", "decode_dead_letter",
    "stream_partner_billing", "stream_partner_group_metrics", "stream_display_metrics", "stream_display_changelog",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()
    names = only or [q for q in HEADLINE if q in registry]
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in names:
        fn = registry[name]
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            df = fn(spark, sf_dir)
            df.write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0 or runs == 0:
                samples.append(dt)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = fn(spark, sf_dir).count() if not name.startswith("stream_") else -1
    sf = sf_dir.rsplit("sf", 1)[-1]
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    # events read per second by the streaming queries (start-up included)
    throughput = {n: round(ev / t) for n, t in times.items() if n.startswith("stream_") and t > 0}
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        "stream_events_per_sec": throughput,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "events_rows": ev,
        "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
