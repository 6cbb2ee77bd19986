"""Jobs for ``spark-submit`` or ``python -m tastewell``: load CSV files, train models."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tastewell.plans.statistics_job import load_store, merge_into_store
from tastewell.plans.training import TrainingConfig, chosen_models, run_training
from tastewell.session import discard_scratch


def main() -> None:
    parser = argparse.ArgumentParser(prog="tastewell")
    jobs = parser.add_subparsers(dest="job", required=True)
    load = jobs.add_parser("load", help="CSV files to stored tables with statistics")
    for name in ("movies", "ratings", "tags", "store"):
        load.add_argument(f"--{name}", required=True)
    load.add_argument("--merge", action="store_true", help="keep what the store has and the files do not mention")
    train = jobs.add_parser("train", help="train, evaluate and store lists")
    train.add_argument("--store", required=True)
    train.add_argument("--run-id", required=True)
    train.add_argument("--model", default="all", choices=["als", "cbf", "hybrid", "all"])
    args = parser.parse_args()

    spark = SparkSession.builder.appName(f"tastewell-{args.job}").getOrCreate()
    try:
        if args.job == "load":
            job = merge_into_store if args.merge else load_store
            rejects = job(spark, args.movies, args.ratings, args.tags, args.store)
            rejects.groupBy("source", "reason").count().show(truncate=False)
        else:
            config = TrainingConfig(models=chosen_models(args.model))
            run_training(spark, args.store, args.run_id, config).show(truncate=False)
    finally:
        discard_scratch(spark)
        spark.stop()


if __name__ == "__main__":
    main()
