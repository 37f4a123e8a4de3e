"""Time the workloads and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. After one round to
warm up come ``BENCH_RUNS`` rounds over all queries; the best time of each counts, with
building its frame and writing all its rows. ``BENCH_PLAIN=1`` also times the plain formulations of
``benchmarks/plain.py`` and reports them under ``plain``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from palate.operators.staging import clear_staged
from palate.registry import QUERIES

HEADLINE = (
    "iceberg_tag_genre",
    "dominant_tag_per_genre",
    "iceberg_relevant_tags",
    "tag_sentiment",
    "skyline_tag_genre",
    "skyline_movies",
    "corr_relevance_rating",
    "movie_rating_relevance",
    "user_target_cosine",
    "overhyped_movies",
    "topk_users",
)


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    started = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    took = time.perf_counter() - started
    clear_staged(spark)
    return took


def best_times(queries: dict, spark: SparkSession, sf_dir: str, runs: int) -> dict[str, float]:
    rounds = [
        {name: seconds(query, spark, sf_dir) for name, query in queries.items()}
        for _ in range(runs + 1)
    ]
    return {name: round(min(times[name] for times in rounds[1:]), 4) for name in queries}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="palate-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timed = best_times({name: QUERIES[name] for name in names}, spark, sf_dir, runs)
    report = {
        "metric": "workloads_total",
        "value": round(sum(timed.values()), 4),
        "unit": "sec",
        "queries": timed,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
    }
    if os.environ.get("BENCH_PLAIN"):
        from benchmarks.plain import PLAIN

        plain = {name: PLAIN[name] for name in names if name in PLAIN}
        report["plain"] = best_times(plain, spark, sf_dir, runs)
    print(json.dumps(report))


if __name__ == "__main__":
    main()
