"""Time the headline queries; print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads, ``BENCH_RUNS`` the
timed runs after one warm-up run; the reported time is their median.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = [
    "select_companies",
    "first_per_year",
    "corpus_values",
    "section_profile",
    "sections",
    "chunk_words",
    "chunk_raw",
    "chunk_wide",
    "embed_shape",
    "semantic_search",
    "retrieval_eval",
    "cosine_topk",
    "scale",
    "kmeans7",
    "outliers",
    "plot_combined",
    "explore_filings",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        spent = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(spent[1:]), 3)
        print(name, [round(s, 2) for s in spent], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
