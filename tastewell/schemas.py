"""Fixed schemas of the input and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """``name type, name type``; usable before a session exists."""
    pairs = (column.split() for column in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


MOVIES = _schema("movieId bigint, title string, genres string")
RATINGS = _schema("userId bigint, movieId bigint, rating double, ts bigint")
TAGS = _schema("userId bigint, movieId bigint, tag string, ts bigint")
MOVIES_ENRICHED = _schema(
    "movieId bigint, title string, genres string, avg_rating double, rating_count bigint"
)
RECOMMENDATIONS = _schema(
    "model string, userId bigint, rank int, movieId bigint, score double, is_winner boolean"
)
GENRE_STATS = _schema("genre string, count bigint")
RATING_STATS = _schema("rating double, count bigint")
RATING_COUNTS = _schema("movieId bigint, rating double, n bigint")
USER_BITS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("bits", T.BinaryType())])
SYSTEM_STATS = _schema("user_count bigint, movie_count bigint, rating_count bigint")
MODEL_METRICS = _schema(
    "run_id string, model string, rmse double, mae double, updated_at timestamp, is_winner boolean"
)

TABLES = {
    "movies": MOVIES_ENRICHED,
    "ratings": RATINGS,
    "tags": TAGS,
    "recommendations": RECOMMENDATIONS,
    "catalogue": MOVIES,
    "rating_counts": RATING_COUNTS,
    "user_bits": USER_BITS,
    "genre_stats": GENRE_STATS,
    "rating_stats": RATING_STATS,
    "system_stats": SYSTEM_STATS,
    "model_metrics": MODEL_METRICS,
}


class SchemaMismatch(ValueError):
    """A table lacks a column, or holds it in another type."""


def conform(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """The schema's columns in order; raises on a missing or differently typed column."""
    present = {field.name: field.dataType for field in df.schema}
    problems = [
        f"{field.name}: expected {field.dataType.simpleString()}, found "
        + (present[field.name].simpleString() if field.name in present else "nothing")
        for field in schema
        if present.get(field.name) != field.dataType
    ]
    if problems:
        raise SchemaMismatch(f"table {name!r}: " + "; ".join(problems))
    return df.select(*[F.col(field.name) for field in schema])
