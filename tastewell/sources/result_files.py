"""Text result files of batch jobs: ``key<TAB>value`` lines, comma as fallback separator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tastewell.functions.casting import to_long


def parse_pairs(lines: DataFrame) -> DataFrame:
    """``value`` lines to trimmed (key, value) text; lines without separator are left out."""
    line = F.trim(F.col("value"), F.lit(" \t\r"))
    parts = F.when(line.contains("\t"), F.split(line, "\t")).otherwise(F.split(line, ","))
    return (
        lines.select(parts.alias("parts"))
        .filter(F.size("parts") >= 2)
        .select(
            F.trim(F.col("parts")[0]).alias("key"),
            F.trim(F.col("parts")[1]).alias("value"),
        )
    )


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """All ``part-*`` files of a result folder."""
    return parse_pairs(spark.read.text(path, pathGlobFilter="part-*"))


def movie_statistic(pairs: DataFrame, name: str, kind: str | DataType) -> DataFrame:
    """Pairs as one typed statistic per movie; malformed pairs are left out."""
    return pairs.select(
        to_long(F.col("key")).alias("movieId"), F.col("value").try_cast(kind).alias(name)
    ).dropna()


def genre_statistic(pairs: DataFrame) -> DataFrame:
    return pairs.select(
        F.col("key").alias("genre"), F.col("value").try_cast("bigint").alias("count")
    ).dropna()


def write_pairs(df: DataFrame, path: str) -> None:
    """A two-column frame as ``key<TAB>value`` lines."""
    key, value = df.columns
    line = F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string"))
    df.select(line.alias("value")).write.text(path)
