"""Ratings, movies and tags derived from the driver tables.

Customer is the user, part the movie, order line the rating.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell.constants import NO_GENRES
from tastewell.operators.ratings import latest_ratings


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lines_with_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("o_orderdate")
    # Calendar arithmetic: the session time zone cannot shift it.
    seconds = (
        F.unix_date(F.to_date(at)).cast("bigint") * 86400
        + F.hour(at) * 3600
        + F.minute(at) * 60
        + F.second(at)
    )
    # Once an order, not once a line.
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("bigint").alias("userId"), seconds.alias("ts"), _word().alias("word")
    )
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("movieId", F.col("l_partkey").cast("bigint"))
    )


def _half_stars() -> Column:
    return F.ceil(F.col("l_quantity") / 5.0).cast("double") / 2


def _word() -> Column:
    return F.lower(F.split_part(F.col("o_orderpriority"), F.lit("-"), F.lit(2)))


def _tag() -> Column:
    return F.when(F.col("l_linenumber") == 7, " ").otherwise(F.col("word"))


def rated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line once, ``userId, movieId, rating, ts, tag``: for queries that need ratings and tags.

    Lines that were not returned have no tag.
    """
    tag = F.when(F.col("l_returnflag") == "R", _tag())
    return _lines_with_orders(spark, sf_dir).select(
        "userId", "movieId", _half_stars().alias("rating"), "ts", tag.alias("tag")
    )


def tags_of(lines: DataFrame) -> DataFrame:
    """The tags of ``rated_lines``; rows and columns are those of ``tags``."""
    return lines.filter(F.trim("tag") != "").select("userId", "movieId", "tag", "ts")


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-star ratings with repeated keys."""
    return _lines_with_orders(spark, sf_dir).select(
        "userId", "movieId", _half_stars().alias("rating"), "ts"
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_ratings(ratings_raw(spark, sf_dir))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some movies carry the "no genres" marker, some an empty genre text."""
    word = F.split("p_name", " ")
    key = F.col("p_partkey") % 50
    genres = (
        F.when(key == 0, NO_GENRES)
        .when(key == 1, "")
        .otherwise(F.concat_ws("|", F.get(word, F.lit(0)), F.get(word, F.lit(1)), F.col("p_type")))
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("bigint").alias("movieId"),
        F.col("p_name").alias("title"),
        genres.alias("genres"),
    )


def tags_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags of returned lines; some are blank."""
    return (
        _lines_with_orders(spark, sf_dir)
        .filter(F.col("l_returnflag") == "R")
        .select("userId", "movieId", _tag().alias("tag"), "ts")
    )


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tags_raw(spark, sf_dir).filter(F.trim("tag") != "")
