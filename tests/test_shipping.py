"""Functions reach workers that have no copy of the package: they are run from a folder that does not hold it."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent

# The driver finds the package by its path; its workers start without it.
SESSION = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").getOrCreate())
"""


def run_elsewhere(script, folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SESSION.format(repo=str(REPO)) + script], cwd=folder, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.split()


def test_scoring_and_sources(tmp_path):
    (tmp_path / "m.csv").write_text('movieId,title,genres\n1,"Two\nlines",Drama\n')
    script = """
from tastewell.operators import factorisation as fa
from tastewell.sources import csv_files
from tastewell.sources.tables import merge_table, read_table
users = spark.createDataFrame([(u, [1.0, float(u)]) for u in range(5)], "userId long, features array<double>")
movies = spark.createDataFrame([(m, [float(m), 1.0]) for m in range(9)], "movieId long, features array<double>")
print(fa.als_top_k(fa.Factors(users, movies, 2), 3).count())
print(csv_files.read_movies(spark, "m.csv")[0].count())
rows = users.selectExpr("userId", "userId AS movieId", "1.0D AS rating", "0L AS ts")
for _ in range(2):
    merge_table(rows, "store", "ratings", rows_per_unit=2)
print(read_table(spark, "store", "ratings").count())
"""
    assert run_elsewhere(script.replace('"m.csv"', repr(str(tmp_path / "m.csv"))).replace('"store"', repr(str(tmp_path / "store"))), tmp_path) == ["15", "1", "5"]
