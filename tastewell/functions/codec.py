"""The text form of a recommendation list: ``movieId:score,movieId:score``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastewell.functions.casting import to_finite_double, to_long
from tastewell.functions.display import fixed
from tastewell.functions.scores import clamp


def encode_list(items: Column) -> Column:
    """An ordered array of (movieId, score) as text, scores clamped, two decimals."""
    return F.array_join(
        F.transform(
            items,
            lambda item: F.concat(
                item["movieId"].cast("string"), F.lit(":"), fixed(clamp(item["score"]), 2)
            ),
        ),
        ",",
    )


def decode_list(text: Column) -> Column:
    """Text to an ordered array of (movieId, score); malformed items are left out."""

    def parsed(item: Column) -> Column:
        parts = F.split(item, ":")
        return F.when(
            F.size(parts) == 2,
            F.struct(
                to_long(parts[0]).alias("movieId"),
                to_finite_double(parts[1]).alias("score"),
            ),
        )

    items = F.transform(F.split(text, ","), parsed)
    return F.filter(items, lambda item: item["movieId"].isNotNull() & item["score"].isNotNull())
