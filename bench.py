"""Time the headline queries and print one JSON line.

Every query runs once to warm up, then BENCH_RUNS times into a sink that
discards its rows; the median counts, `spread` is the longest run less the
shortest. Settings: BENCH_SF_DIR, BENCH_CPUS,
BENCH_RUNS, BENCH_QUERIES (comma-separated names).
"""

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks.queries import QUERIES  # noqa: E402
from gridmill.session import build_session  # noqa: E402

HEADLINE = (
    "daily_total_energy", "features_ml", "wide_unpivot", "stream_bronze", "eval_metrics",
    "system_rollup", "daily_silver", "features_silver", "chunked_window", "describe_profile",
    "peak_interval", "envelope_explode", "kafka_batch_parse", "latest_snapshot", "monthly_merge",
    "serving_union", "pick_version", "score_batch", "describe_table", "shifted_window",
    "file_ingest_report", "day_file_readings", "written_table", "rf_autumn",
    "stream_compacted", "incremental_daily", "monthly_customers", "coverage_gaps", "long_window", "score_by_season",
)


def run(query, spark, folder):
    started = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false",
        "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    times, spread = {}, {}
    for name in names:
        run(QUERIES[name], spark, folder)
        taken = [run(QUERIES[name], spark, folder) for _ in range(runs)]
        times[name], spread[name] = round(statistics.median(taken), 3), round(max(taken) - min(taken), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "spread": spread,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
