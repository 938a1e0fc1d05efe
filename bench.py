"""Times the headline queries, results written in full, and prints one line of JSON.

BENCH_SF_DIR: folder of the tables; BENCH_CPUS: local cores; BENCH_RUNS: timed runs of each
query, of which the median counts, after one that does not.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from talmir.plans.registry import QUERIES  # noqa: E402

HEADLINE = [
    "doc_word_count",
    "word_count",
    "word_count_salted",
    "word_count_salted_groupby",
    "word_count_by_partition",
    "num_distinct_words",
    "avg_distinct_word_length",
    "last_review_per_document",
    "reviews_by_user",
    "user_totals",
    "normalize_ratings",
    "top_products",
    "sample_clusters",
    "silhouette_points",
    "approx_silhouette",
    "exact_sample_silhouette",
    "repeated_silhouette",
    "kmeans_random",
    "lloyd_kmeans",
    "assign_clusters",
    "k_sweep",
]


def seconds(spark: SparkSession, name: str, folder: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        seconds(spark, name, folder)
        times[name] = round(statistics.median(seconds(spark, name, folder) for _ in range(runs)), 3)
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
