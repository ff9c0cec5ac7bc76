"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import load_all  # noqa: E402
from trackgrid.session import local_session  # noqa: E402

# Stage tables are written while the plans are built; that is a timed step of its own and part of the total.
HEADLINE = (
    "ser10_resample",
    "ser02_linear_channels",
    "ser04_raw_distance",
    "ser14_resample_session",
    "ser17_delta_t",
    "agg01_median_traces",
    "seg06b_detect_events",
    "agg05_microsector_times",
    "agg06_microsector_summary",
    "seg19_corner_metrics",
    "val06_ground_truth",
    "fct01_fact_grid",
    "qry04_overlay_pruned",
    "par04_pairings",
    "qua09_validate_table",
    "flagship_overlay",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").count()
    registry, times = load_all(), {}
    start = time.perf_counter()
    for name in HEADLINE:
        registry[name].run(spark, sf_dir)
    times["stage_tables"] = round(time.perf_counter() - start, 3)
    print(f"stage tables {times['stage_tables']:.2f}s", file=sys.stderr)
    for name in HEADLINE:
        start = time.perf_counter()
        registry[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {times[name]:.2f}s", file=sys.stderr)
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
