"""Time the headline queries; prints one JSON line.

Every query is drained through the ``noop`` sink, so no result travels to the driver.
``BENCH_SF_DIR``, ``BENCH_CPUS`` and ``BENCH_QUERIES`` (comma-separated) choose the run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from sensorloom.plans.catalog import QUERIES
from sensorloom.session import build_session, clear_scratch

HEADLINE = [
    "tumbling_mean_by_split", "tumbling_features", "describe_numeric", "pairwise_corr", "histogram",
    "missing_counts", "zscore_flag", "ksigma_flag", "minmax_scale", "nearest_centroid", "rolling_band_flag",
    "rolling_stats_chunked", "cusum_two_sided", "cusum_two_sided_chunked", "ewma_recursive",
    "ewma_recursive_chunked", "adwin", "knn_score", "gap_fill", "thin_series", "sample_per_class",
    "classification_report", "parse_json_envelope", "legacy_regex_extract", "parse_line", "log_volume",
    "log_patterns", "detected_fields", "outlier_series", "line_contains", "isolation_forest",
    "kmeans_anomalies", "stream_tumbling", "stream_ksigma", "stream_ewma",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark_ui_enabled="false", spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="12g", spark_ui_showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Class loading and code generation of the first jobs are not the queries' time.
    for warm in ("split_counts", "value_counts"):
        QUERIES[warm](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        clear_scratch(spark)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
