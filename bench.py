"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tastewell.plans.queries import registered

# Counts and joins, histories, the content model, the hybrid, and whole training runs.
HEADLINE = [
    "ratings_latest",
    "movie_avg_rating",
    "genre_count",
    "system_overview",
    "movie_enriched",
    "movie_details",
    "user_history",
    "user_history_numbered",
    "user_genre_profile",
    "ingest_ratings",
    "wide_ratings",
    "tfidf_hashed",
    "user_profile",
    "cbf_topk",
    "cbf_eval",
    "hybrid_lists",
    "recs_listing",
    "report_rows",
    "als_eval",
    "als_topk",
    "hybrid_topk",
    "training_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    # One small query first, so the first timing does not hold the start of the JVM.
    queries["movie_rating_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
