"""Statistics kept up to date from the changes of a load instead of being counted anew.

Ratings are counted by movie and value. Whole numbers can be taken back exactly: a replaced rating is a change of
minus one, the new one of plus one. Counts, means and the histogram follow from them. Users are known by bits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rating_changes(changes: DataFrame) -> DataFrame:
    """``movieId, rating, n``: by how much the counts change, from the changes that a merge reports."""
    sides = F.array(
        F.struct(F.col("old.rating").alias("rating"), F.lit(-1).cast("bigint").alias("n")),
        F.struct(F.col("new.rating").alias("rating"), F.lit(1).cast("bigint").alias("n")),
    )
    moved = changes.select("movieId", F.explode(sides).alias("side")).select("movieId", "side.*")
    return moved.filter("rating IS NOT NULL").groupBy("movieId", "rating").agg(F.sum("n").alias("n")).filter("n <> 0")


def value_counts(ratings: DataFrame) -> DataFrame:
    """``movieId, rating, n`` of all ratings."""
    return ratings.filter("rating IS NOT NULL").groupBy("movieId", "rating").agg(F.count("*").alias("n"))


def statistics_of(counts: DataFrame) -> DataFrame:
    """Mean and count per movie from the counts by value."""
    total = F.sum("n")
    return counts.groupBy("movieId").agg((F.sum(F.col("rating") * F.col("n")) / total).alias("avg_rating"), total.alias("rating_count"))


def histogram_of(counts: DataFrame) -> DataFrame:
    """Count per rating value from the counts by movie and value."""
    return counts.groupBy("rating").agg(F.sum("n").alias("count"))


def id_bits(df: DataFrame, column: str) -> DataFrame:
    """``bucket, bits``: the distinct ids as bitmaps of fixed size, so the shuffle grows with ranges of ids, not with rows."""
    known = df.filter(F.col(column).isNotNull())
    cut = known.select(F.bitmap_bucket_number(column).alias("bucket"), F.bitmap_bit_position(column).alias("bit"))
    return cut.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits"))


def united_bits(*tables: DataFrame) -> DataFrame:
    """The ids that any of the tables holds."""
    every = tables[0]
    for other in tables[1:]:
        every = every.unionByName(other)
    return every.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bit_count(bits: DataFrame) -> DataFrame:
    """One row, ``n``: the number of distinct ids."""
    return bits.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("n"))
