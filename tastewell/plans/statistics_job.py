"""The batch statistics job: CSV files to stored tables with statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell import schemas
from tastewell.operators import maintained as mt
from tastewell.operators import statistics as st
from tastewell.session import written
from tastewell.sources.csv_files import last_written, read_movies, read_ratings, read_tags
from tastewell.sources.tables import merge_statistics, merge_table, read_table, table_exists, write_table


def load_store(
    spark: SparkSession, movies_csv: str, ratings_csv: str, tags_csv: str, root: str
) -> DataFrame:
    """Read the CSV files, write all tables of the store, return the rejects.

    Counts, means, histogram and overview describe the accepted rows as they stand in the
    files; the stored ratings and movies have one row per key, the last in the files.
    """
    movie_rows, movie_rejects = read_movies(spark, movies_csv)
    rating_rows, rating_rejects = read_ratings(spark, ratings_csv)
    tag_rows, tag_rejects = read_tags(spark, tags_csv)

    # Parsed once: the statistics and the deduplicated table read the columnar copy.
    accepted = written(rating_rows, "accepted-ratings")
    movie_rows = written(movie_rows, "accepted-movies")
    write_table(last_written(accepted, ["userId", "movieId"]), root, "ratings")
    write_table(tag_rows, root, "tags", mode="overwrite")
    write_statistics(accepted, last_written(movie_rows, ["movieId"]), movie_rows, root)
    return movie_rejects.unionByName(rating_rejects).unionByName(tag_rejects)


def write_statistics(
    ratings: DataFrame, movies: DataFrame, movie_rows: DataFrame, root: str
) -> None:
    """Movies with merged statistics, genre counts, histogram and overview."""
    write_table(merge_statistics(movies, st.movie_statistics(ratings)), root, "movies")
    write_table(st.genre_counts(movies), root, "genre_stats")
    write_table(st.rating_histogram(ratings), root, "rating_stats")
    overview = st.system_overview(ratings, movie_rows).select(
        F.col("user_count"), F.col("movie_count"), F.col("rating_count")
    )
    write_table(overview, root, "system_stats")


def merge_into_store(
    spark: SparkSession, movies_csv: str, ratings_csv: str, tags_csv: str, root: str
) -> DataFrame:
    """Merge the CSV files into a store, new or existing, and return the rejects.

    A movie or rating takes the place of the stored one with its key and all others stay; tags are added. Only
    the units of the tables that hold such keys are written anew. The statistics describe the stored ratings: they move by what changed.
    """
    movie_rows, movie_rejects = read_movies(spark, movies_csv)
    rating_rows, rating_rejects = read_ratings(spark, ratings_csv)
    tag_rows, tag_rejects = read_tags(spark, tags_csv)
    if table_exists(spark, root, "movies") and not table_exists(spark, root, "catalogue"):
        # A store written as a whole: its titles are the catalogue so far.
        whole = read_table(spark, root, "movies").filter(F.col("title").isNotNull()).select(*schemas.MOVIES.fieldNames())
        merge_table(written(whole, "catalogue"), root, "catalogue")
    merge_table(last_written(movie_rows, ["movieId"]), root, "catalogue")
    merge_ratings(last_written(rating_rows, ["userId", "movieId"]), root)
    write_table(tag_rows, root, "tags")
    movies = read_table(spark, root, "catalogue")
    counts = read_table(spark, root, "rating_counts")
    write_table(merge_statistics(movies, mt.statistics_of(counts)), root, "movies")
    write_table(st.genre_counts(movies), root, "genre_stats")
    write_table(mt.histogram_of(counts), root, "rating_stats")
    users = mt.bit_count(read_table(spark, root, "user_bits")).select("n").scalar()
    ratings = counts.select(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    overview = movies.agg(F.count("*").alias("movie_count")).select(users.alias("user_count"), "movie_count", ratings.alias("rating_count"))
    write_table(overview.select(*schemas.SYSTEM_STATS.fieldNames()), root, "system_stats")
    return movie_rejects.unionByName(rating_rejects).unionByName(tag_rejects)


def merge_ratings(ratings: DataFrame, root: str, rows_per_unit: int | None = None) -> None:
    """Merge ratings, one a key, into the store's ratings, counts by movie and value, and bits of the users.

    The counts and bits of a store that has ratings but none of them yet are counted once. A load that ends between its parts is
    repaired by ``recount``.
    """
    spark = ratings.sparkSession
    size = {} if rows_per_unit is None else {"rows_per_unit": rows_per_unit}
    fresh = table_exists(spark, root, "ratings") and not table_exists(spark, root, "rating_counts")
    changes = merge_table(ratings, root, "ratings", **size)
    if fresh:
        recount(spark, root)
        return
    merge_table(mt.rating_changes(changes), root, "rating_counts", add=("n",), **size)
    bits = [mt.id_bits(ratings, "userId")]
    if table_exists(spark, root, "user_bits"):
        bits.append(read_table(spark, root, "user_bits"))
    write_table(written(mt.united_bits(*bits), "user-bits"), root, "user_bits")


def recount(spark: SparkSession, root: str) -> None:
    """Count the stored ratings anew: counts by movie and value, and bits of the users."""
    ratings = read_table(spark, root, "ratings")
    write_table(mt.value_counts(ratings), root, "rating_counts")
    write_table(mt.id_bits(ratings, "userId"), root, "user_bits")
