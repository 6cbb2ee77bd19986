"""The stored Parquet tables: checked schemas, pruned reads, atomic whole-table writes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell import schemas
from tastewell.operators.statistics import enriched_movies
from tastewell.session import written
from tastewell.sources import keyed_tables

PARTITIONS = {"recommendations": ["model"]}
# Lookups filter on these; sorting inside files lets row-group statistics skip most of a file.
CLUSTERED_BY = {
    "movies": ["movieId"],
    "ratings": ["userId", "movieId"],
    "tags": ["movieId", "userId"],
    "recommendations": ["userId", "rank"],
}
APPENDED = {"model_metrics", "tags"}
# Tables that loads can merge into, by key.
KEYS = {"ratings": ["userId", "movieId"], "catalogue": ["movieId"], "rating_counts": ["movieId", "rating"]}


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table; fails when its schema is not the expected one."""
    path = table_path(root, name)
    if name in KEYS and keyed_tables.version(spark, path):
        return keyed_tables.read_keyed(spark, path, schemas.TABLES[name])
    stored = schemas.conform(spark.read.parquet(table_path(root, name)), schemas.TABLES[name], name)
    if name == "recommendations" and table_exists(spark, root, "model_metrics"):
        # The metrics of the newest run name the winner; a stored flag may be of an older run.
        runs = read_table(spark, root, "model_metrics").filter("is_winner")
        newest = runs.agg(F.max_by("model", F.struct("updated_at", "run_id")))
        stored = stored.withColumn("is_winner", F.coalesce(F.col("model") == newest.scalar(), F.lit(False)))
    return stored


def _replace(df_writer, spark: SparkSession, path: str) -> None:
    """Write a whole table beside the old one, then take its place: a failed write leaves the old one."""
    fresh = f"{path}.new-{uuid.uuid4().hex}"
    df_writer.parquet(fresh)
    _move(spark, fresh, path)


def _move(spark: SparkSession, fresh: str, path: str) -> None:
    """Puts a folder in the place of a table."""
    old = f"{path}.old-{uuid.uuid4().hex}"
    here, there, aside = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, fresh, old))
    files = here.getFileSystem(spark._jsc.hadoopConfiguration())
    held = files.exists(here)
    if held and not files.rename(here, aside):
        raise OSError(f"cannot set {path} aside")
    if not files.rename(there, here):
        raise OSError(f"cannot move {fresh} to {path}")
    if held:
        files.delete(aside, True)


def write_table(df: DataFrame, root: str, name: str, mode: str | None = None, emptied: tuple[str, ...] = ()) -> None:
    """Write a table after checking its schema. A partitioned table keeps the partitions that get no rows, but for ``emptied``.

    Large tables are range-partitioned by their lookup key: files then cover narrow key
    ranges, and a range split is balanced by sampled volume, so a hot user spreads over several
    files instead of landing in one task.
    """
    rows = schemas.conform(df, schemas.TABLES[name], name)
    keys = CLUSTERED_BY.get(name)
    if keys:
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*PARTITIONS.get(name, []), *keys)
    mode = mode or ("append" if name in APPENDED else "overwrite")
    writer, path = rows.write, table_path(root, name)
    if name in PARTITIONS:
        # Only the partitions that the rows belong to are replaced, and those named in ``emptied`` go.
        for value in emptied:
            here = df.sparkSession._jvm.org.apache.hadoop.fs.Path(f"{path}/{PARTITIONS[name][0]}={value}")
            here.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(here, True)
        writer.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*PARTITIONS[name]).parquet(path)
    elif mode == "overwrite":
        _replace(writer, df.sparkSession, path)
    else:
        writer.mode(mode).parquet(path)


def merge_table(rows: DataFrame, root: str, name: str, add: tuple[str, ...] = (), rows_per_unit: int = keyed_tables.ROWS_PER_UNIT) -> DataFrame:
    """Merges rows, one a key, into a keyed table and returns what changed; see ``keyed_tables.merge_keyed``.

    A table that was written as a whole is first dealt into units.
    """
    spark, path = rows.sparkSession, table_path(root, name)
    if not keyed_tables.version(spark, path) and table_exists(spark, root, name):
        whole = written(read_table(spark, root, name), "whole")
        fresh = f"{path}.keyed-{uuid.uuid4().hex}"
        keyed_tables.replace_keyed(whole, fresh, KEYS[name], rows_per_unit)
        _move(spark, fresh, path)
    return keyed_tables.merge_keyed(schemas.conform(rows, schemas.TABLES[name], name), path, KEYS[name], add, rows_per_unit)


def load_dataset(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings, movies and tags of a store."""
    movies = read_table(spark, root, "movies").select("movieId", "title", "genres")
    return (
        read_table(spark, root, "ratings"),
        # Rows that carry statistics only are not part of the catalogue (null title).
        movies.filter(F.col("title").isNotNull()).fillna({"genres": ""}),
        read_table(spark, root, "tags"),
    )


def merge_statistics(movies: DataFrame, statistics: DataFrame) -> DataFrame:
    """Movies with merged statistics, in the stored schema."""
    return schemas.conform(enriched_movies(movies, statistics), schemas.MOVIES_ENRICHED, "movies")
