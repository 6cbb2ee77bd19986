"""The ``|``-separated genre list."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def genre_array(genres: Column) -> Column:
    return F.split(genres, r"\|")


def genre_text(genres: Column) -> Column:
    """Genres as words of a text."""
    return F.concat_ws(" ", genre_array(genres))
