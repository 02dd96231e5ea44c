"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` is the data folder, ``BENCH_CPUS`` the number of local cores. Every query is run
twice to completion; ``queries`` holds the second (warm) time and ``cold`` the first.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from basketry.catalog.queries import QUERIES

HEADLINE = [
    "clean_lines", "trim_lines_p99", "quantile_p99", "basket_stats", "rfm_assemble", "revenue_share_by_country",
    "pareto_customers", "corr_matrix_all", "basket_occurrence", "join_label_lookup", "first_basket_features",
    "horizon_features", "knn_classify", "class_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold: dict[str, float] = {}
    warm: dict[str, float] = {}
    for times in (cold, warm):
        for name in chosen:
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
            print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total warm seconds over the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
