"""Counts, means, genres, histograms and the figures of the user and genre views.

Everything here is a hash aggregation with partial sums before the shuffle, so hot movies,
users and genres are reduced where they are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.constants import CHART_LABEL_SHARE, NO_GENRES, RATING_BINS
from tastewell.functions.display import rounded
from tastewell.functions.genres import genre_array
from tastewell.functions.ranking import numbered

ROWS_PER_TASK = 500_000  # ratings, a few genres each: some 400 MB of groups


def rating_counts(ratings: DataFrame) -> DataFrame:
    """Ratings per movie, repeated ratings included."""
    return ratings.groupBy("movieId").agg(F.count("*").alias("rating_count"))


def average_ratings(ratings: DataFrame) -> DataFrame:
    """Mean rating per movie, exact and as shown with two decimals."""
    return ratings.groupBy("movieId").agg(F.avg("rating").alias("avg_rating")).withColumn(
        "avg_shown", rounded(F.col("avg_rating"), 2)
    )


def movie_statistics(ratings: DataFrame) -> DataFrame:
    """Mean and count per movie in one pass."""
    return ratings.groupBy("movieId").agg(
        F.avg("rating").alias("avg_rating"), F.count("rating").alias("rating_count")
    )


def movies_with_votes(ratings: DataFrame, min_votes: int) -> DataFrame:
    """Ids of movies with at least so many ratings."""
    return (
        ratings.groupBy("movieId")
        .agg(F.count("rating").alias("votes"))
        .filter(F.col("votes") >= min_votes)
        .select("movieId")
    )


def enriched_movies(movies: DataFrame, statistics: DataFrame) -> DataFrame:
    """Movies with statistics; a movie known from ratings only keeps a row without title."""
    return movies.join(statistics, "movieId", "full_outer").select(
        "movieId", "title", "genres", "avg_rating", "rating_count"
    )


def genre_counts(movies: DataFrame) -> DataFrame:
    """Movies per genre; movies without genres and blank genre names do not count."""
    genre = F.trim(F.col("genre")).alias("genre")
    return (
        movies.filter((F.col("genres") != "") & (F.col("genres") != NO_GENRES))
        .select(F.explode(genre_array(F.col("genres"))).alias("genre"))
        .select(genre)
        .filter(F.col("genre") != "")
        .groupBy("genre")
        .agg(F.count("*").alias("count"))
    )


def genre_totals(genres: DataFrame) -> DataFrame:
    """One row: all assignments, the largest genre (ties by name) and the mean per genre."""
    top = F.min(F.struct((-F.col("count")).alias("rest"), "genre")).alias("top")
    return genres.agg(
        F.sum("count").alias("assignments"), top, F.avg("count").alias("avg_per_genre")
    ).select(
        "assignments",
        F.col("top.genre").alias("top_genre"),
        (-F.col("top.rest")).alias("top_count"),
        "avg_per_genre",
    )


def genre_chart(genres: DataFrame, label_share: float = CHART_LABEL_SHARE) -> DataFrame:
    """Genres with their place by size, and a label on those above a share of the total."""
    total = genres.select(F.sum("count")).scalar()
    labelled = genres.withColumn(
        "label",
        F.when(F.col("count") > total * F.lit(label_share), F.col("count").cast("string")).otherwise(""),
    )
    return numbered(labelled, [], [(F.col("count"), True)], [F.col("genre")], "ordinal")


def rating_histogram(ratings: DataFrame) -> DataFrame:
    """Count per rating value that occurs, in order of value."""
    counted = ratings.dropna(subset=["rating"]).groupBy("rating").agg(F.count("*").alias("count"))
    return counted.orderBy("rating")


def binned_histogram(histogram: DataFrame) -> DataFrame:
    """Count per standard rating value, zero where none occurs; other values are left out."""
    bins = histogram.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(b) for b in RATING_BINS])).alias("rating")
    )
    return bins.join(histogram, "rating", "left").select(
        "rating", F.coalesce("count", F.lit(0)).alias("count")
    )


def wide_histogram(histogram: DataFrame) -> DataFrame:
    """The standard bins as one row, one column per rating value."""
    return binned_histogram(histogram).agg(
        *[
            F.sum(F.when(F.col("rating") == b, F.col("count"))).alias(f"r_{str(b).replace('.', '_')}")
            for b in RATING_BINS
        ]
    )


def system_overview(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """One row: distinct users, movies and ratings."""
    movie_count = movies.select(F.count("*")).scalar()
    return ratings.agg(
        F.count_distinct("userId").alias("user_count"), F.count("*").alias("rating_count")
    ).select("user_count", movie_count.alias("movie_count"), "rating_count")


def user_summary(ratings: DataFrame) -> DataFrame:
    """Number of rated movies and mean rating per user."""
    return ratings.groupBy("userId").agg(
        F.count("*").alias("rated"), F.avg("rating").alias("avg_rating")
    )


def user_genre_profile(history: DataFrame, rows: int | None = None) -> DataFrame:
    """Mean rating and count per user and genre, over the detailed history of so many ``rows`` (counted if not given).

    Hardly a user's genre repeats in a map task, so rows are dealt by user before their genres are taken apart, to as many
    tasks as keeps the groups of one task few however long the history is.
    """
    rows = history.count() if rows is None else rows
    tasks = max(history.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))
    return (
        history.select("userId", "rating", "genres")
        .repartition(tasks, "userId")
        .select("userId", "rating", F.explode(genre_array(F.col("genres"))).alias("genre"))
        .groupBy("userId", "genre")
        .agg(F.avg("rating").alias("avg_rating"), F.count("rating").alias("count"))
    )


def user_top_genre(genre_profile: DataFrame) -> DataFrame:
    """The genre a user rated most often, ties by name; reads ``user_genre_profile``."""
    top = F.min(F.struct((-F.col("count")).alias("rest"), "genre")).alias("top")
    return (
        genre_profile.groupBy("userId")
        .agg(top)
        .select("userId", F.col("top.genre").alias("genre"), (-F.col("top.rest")).alias("count"))
    )
