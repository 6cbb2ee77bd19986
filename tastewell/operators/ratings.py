"""Rating keys and the train/test split."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastewell.constants import SPLIT_SEED, TRAIN_FRACTION

# Sides of the reproducible split are told apart to this share of the keys.
SPLIT_BUCKETS = 10_000

# Ratings are told apart to this fraction when they are equally late.
RATING_STEPS = 10_000


def latest_ratings(ratings: DataFrame) -> DataFrame:
    """One rating per user and movie: the latest, and of equally late ones the highest.

    Time and rating are ordered by one number. All state of the aggregation then is of fixed
    width: it hashes instead of sorting, and repeats of a key are combined before the shuffle.
    A missing time counts as 0, as for stored ratings without one.
    """
    at = F.coalesce(F.col("ts"), F.lit(0)).cast("bigint")
    step = (F.col("rating") * RATING_STEPS).try_cast("decimal(15,0)")
    order = at.cast("decimal(19,0)") * F.lit(Decimal(10**15)) + F.coalesce(step, F.lit(0))
    return ratings.groupBy("userId", "movieId").agg(
        F.max_by("rating", order).alias("rating"), F.max(at).alias("ts")
    )


def in_train_set(train_fraction: float = TRAIN_FRACTION) -> Column:
    """Whether the rule on the key puts a row into the train set: the key's digest decides, so a side holds no pattern of ids."""
    share = round(train_fraction * SPLIT_BUCKETS)
    if abs(share - train_fraction * SPLIT_BUCKETS) > 1e-6 or not 0 < share < SPLIT_BUCKETS:
        raise ValueError(f"a train fraction of {train_fraction} is no multiple of 1/{SPLIT_BUCKETS} between 0 and 1")
    digest = F.md5(F.concat_ws("-", F.col("userId").cast("string"), F.col("movieId").cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.pmod(number, F.lit(SPLIT_BUCKETS)) < share


def split_by_key(ratings: DataFrame, train_fraction: float = TRAIN_FRACTION) -> tuple[DataFrame, DataFrame]:
    """Train and test set by a rule on the key.

    The same rows land on the same side whatever the partitioning, order or number of retries.
    """
    in_train = in_train_set(train_fraction)
    return ratings.filter(in_train), ratings.filter(~in_train)


def split_at_random(
    ratings: DataFrame, train_fraction: float = TRAIN_FRACTION, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split; depends on partitioning and row order, unlike ``split_by_key``."""
    train, test = ratings.randomSplit([train_fraction, 1 - train_fraction], seed=seed)
    return train, test
