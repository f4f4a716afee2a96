"""Time the headline queries: ``BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``, one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from kerbside.queries import QUERIES  # noqa: E402
from kerbside.session import configure  # noqa: E402

HEADLINE = [
    "nearest_road_point", "nearest_stop_per_student", "nearest_road_point_per_student", "nearest_other_student",
    "k_distance_eps", "dbscan_labels", "kmeans_lloyd", "plan_clusters_summary", "cluster_coverage", "stop_demand",
    "bus_matching", "student_assignment_view", "road_lines", "road_line_points", "surrogate_keys",
    "relocate_all_students", "cdc_location_history", "cdc_latest_assignment", "cdc_stream_assignments",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        configure(SparkSession.builder.master(f"local[{cpus}]").appName("bench"))
        .config("spark.sql.shuffle.partitions", cpus).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the first job of a session pays for class loading; keep that out of the first query
    QUERIES["stop_demand"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
        spark.catalog.clearCache()
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
