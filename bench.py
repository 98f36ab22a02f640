"""Time the headline queries: one warm-up, then the median of the runs. Prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the timed runs, ``BENCH_QUERIES``
a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gustline.session import local_session  # noqa: E402
from gustline.workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "q_clean", "q_clean_all", "q_clean_many_stations", "q_dedup_best", "q_resample_hourly", "q_dense_grid", "q_interpolate",
    "q_scale_standard", "q_split_daily", "q_lowess", "q_nearest", "q_box_stats", "q_histogram", "q_kde", "q_payload_parse",
    "q_station_lookup", "q_dtw_assign", "q_info_layers", "q_nearest_outside", "q_kmeans_fit", "q_dtw_kmeans", "q_cluster_days",
    "q_scale_stage", "q_split_stage", "q_preprocess", "q_profile_distribution", "q_split_rows", "q_train_test_exact",
    "q_resample_5h", "q_resample_month", "q_train_test_strata", "q_distinct_counts", "q_sink_roundtrip",
)


def timed(spark, name: str, folder: str) -> float:
    begin = time.perf_counter()
    # Every row is computed and dropped; nothing is collected.
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begin


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, "gustline-bench")
    times = {}
    for name in names:
        timed(spark, name, folder)
        times[name] = round(statistics.median(timed(spark, name, folder) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "headline queries, median seconds each, summed", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": cpus, "runs": runs,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"), "spark": spark.version}))


if __name__ == "__main__":
    main()
