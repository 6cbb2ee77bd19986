"""Recommendation lists in their three forms: flat rows, one array per user, text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.functions.codec import decode_list, encode_list


def to_lists(flat: DataFrame) -> DataFrame:
    """One ordered array per user. Lists are top lists, so an array stays short."""
    ranked = F.sort_array(F.collect_list(F.struct("rank", "movieId", "score")))
    items = F.transform(ranked, lambda r: F.struct(r["movieId"].alias("movieId"), r["score"].alias("score")))
    return flat.groupBy("userId").agg(items.alias("recommendations"))


def to_flat(lists: DataFrame) -> DataFrame:
    """One row per list item: ``userId, rank, movieId, score``; empty lists vanish."""
    return lists.select("userId", F.posexplode("recommendations").alias("place", "item")).select(
        "userId", (F.col("place") + 1).alias("rank"), "item.movieId", "item.score"
    )


def serialised(lists: DataFrame) -> DataFrame:
    """Lists as text, scores clamped; users without items are left out."""
    return lists.filter(F.size("recommendations") > 0).select(
        "userId", encode_list(F.col("recommendations")).alias("items")
    )


def parsed(texts: DataFrame) -> DataFrame:
    """Text lists as arrays; only malformed items are lost."""
    return texts.select("userId", decode_list(F.col("items")).alias("recommendations"))


def listed_movies(flat: DataFrame) -> DataFrame:
    """The distinct movies that occur in any list."""
    return flat.select("movieId").distinct()
