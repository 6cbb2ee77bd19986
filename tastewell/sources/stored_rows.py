"""Stored rows of text cells, ``(key string, cells map<string, string>)``, to typed tables.

A wide user row may be kept in several pages with the same key; each page is read on its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastewell.constants import LATEST_RUN, MISSING_DETAIL, NOT_AVAILABLE, UNKNOWN
from tastewell.functions.casting import first_non_empty, to_finite_double, to_long
from tastewell.functions.display import fixed

ITEMS_PER_PAGE = 1000


def _cell(name: str, default: str | None = None) -> Column:
    value = F.try_element_at(F.col("cells"), F.lit(name))
    return F.coalesce(value, F.lit(default))


def _cells_of(family: str) -> Column:
    """The cells of one family as (key, value) entries."""
    prefix = f"{family}:"
    return F.map_entries(F.map_filter("cells", lambda name, _: name.startswith(prefix)))


def ratings_from_wide(stored: DataFrame) -> DataFrame:
    """One row per ``r:{movieId}`` cell, with the time of the matching ``t:`` cell, else 0."""
    entries = stored.select(
        to_long(F.col("key")).alias("userId"), "cells", F.explode(_cells_of("r")).alias("entry")
    )
    movie = F.substring_index("entry.key", ":", -1)
    time = F.try_element_at(F.col("cells"), F.concat(F.lit("t:"), movie))
    return entries.select(
        "userId",
        to_long(movie).alias("movieId"),
        to_finite_double(F.col("entry.value")).alias("rating"),
        F.coalesce(to_long(time), F.lit(0)).cast("bigint").alias("ts"),
    ).dropna(subset=["userId", "movieId", "rating"])


def ratings_to_wide(ratings: DataFrame, items_per_page: int = ITEMS_PER_PAGE) -> DataFrame:
    """Ratings as wide rows, in pages of movie ids, so no row holds a whole long history."""
    movie = F.col("movieId").cast("string")
    cells = F.array(
        F.struct(F.concat(F.lit("r:"), movie).alias("key"), F.col("rating").cast("string")),
        F.struct(F.concat(F.lit("t:"), movie).alias("key"), F.col("ts").cast("string")),
    )
    return (
        ratings.groupBy("userId", F.floor(F.col("movieId") / items_per_page).alias("page"))
        .agg(F.map_from_entries(F.flatten(F.collect_list(cells))).alias("cells"))
        .select(F.col("userId").cast("string").alias("key"), "cells")
    )


def movies_from_cells(stored: DataFrame) -> DataFrame:
    """Movies with defaults for title and genres; rows with a malformed key are left out."""
    return stored.select(
        to_long(F.col("key")).alias("movieId"),
        _cell("info:title", UNKNOWN).alias("title"),
        _cell("info:genres", "").alias("genres"),
    ).dropna(subset=["movieId"])


def tags_from_cells(stored: DataFrame) -> DataFrame:
    """Tags from the three layouts that occur; the first that fits a row is used.

    1. explicit user, movie, tag and time cells, whatever the key looks like;
    2. key ``user_movie`` with a tag cell;
    3. the user as key and one ``tag:{movieId}`` cell per tag, without time.

    Empty tags and malformed ids are left out.
    """
    explicit = _cell("info:userId").isNotNull()
    compound = F.col("key").contains("_")
    key_parts = F.split("key", "_")
    single = F.struct(
        F.when(explicit, _cell("info:userId")).otherwise(key_parts[0]).alias("user"),
        F.when(explicit, _cell("info:movieId", "0")).otherwise(F.get(key_parts, F.lit(1))).alias("movie"),
        _cell("info:tag").alias("tag"),
        _cell("info:timestamp", "0").alias("time"),
    )
    wide = F.transform(
        _cells_of("tag"),
        lambda entry: F.struct(
            F.col("key").alias("user"),
            F.get(F.split(entry["key"], ":"), F.lit(1)).alias("movie"),
            entry["value"].alias("tag"),
            F.lit("0").alias("time"),
        ),
    )
    rows = F.when(explicit | compound, F.array(single)).otherwise(wide)
    return (
        stored.select(F.explode(rows).alias("row"))
        .select(
            to_long(F.col("row.user")).alias("userId"),
            to_long(F.col("row.movie")).alias("movieId"),
            F.nullif(F.col("row.tag"), F.lit("")).alias("tag"),
            F.coalesce(to_long(F.col("row.time")), F.lit(0)).cast("bigint").alias("ts"),
        )
        .dropna(subset=["userId", "movieId", "tag"])
    )


def metrics_from_cells(stored: DataFrame) -> DataFrame:
    """Model metrics from text cells: the ``info`` cell, else the ``b`` cell, else a default.

    Rows whose errors are not numbers are left out.
    """

    def cell(name: str, default: str) -> Column:
        present = F.coalesce(_cell(f"info:{name}"), _cell(f"b:{name}"))
        return F.coalesce(F.nullif(present, F.lit("")), F.lit(default))

    time = cell("updated_at", MISSING_DETAIL)
    time = F.when(time == MISSING_DETAIL, cell("timestamp", MISSING_DETAIL)).otherwise(time)
    return stored.select(
        F.col("key").alias("model"),
        cell("rmse", "0").try_cast("double").alias("rmse"),
        cell("mae", "0").try_cast("double").alias("mae"),
        time.alias("updated_at"),
    ).filter(F.col("rmse").isNotNull() & F.col("mae").isNotNull())


def latest_run_from_cells(stored: DataFrame) -> DataFrame:
    """The run summary row: the ``b`` cell, or the ``info`` cell where that is missing or empty."""

    def cell(name: str) -> Column:
        value = first_non_empty(_cell(f"b:{name}"), _cell(f"info:{name}"))
        return F.coalesce(value, F.lit(NOT_AVAILABLE))

    rmse = cell("rmse")
    return stored.filter(F.col("key") == LATEST_RUN).select(
        F.upper(cell("winner_model")).alias("winner_model"),
        F.coalesce(fixed(rmse.try_cast("double"), 4), rmse).alias("rmse"),
        cell("timestamp").alias("timestamp"),
    )
