"""Score arithmetic of the three models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastewell.constants import (
    ALS_WEIGHT,
    CBF_WEIGHT,
    DEFAULT_RATING,
    MAX_SCORE,
    MIN_SCORE,
)


def clamp(score: Column) -> Column:
    """Limit a score to the rating scale; null stays null."""
    held = F.greatest(F.lit(MIN_SCORE), F.least(F.lit(MAX_SCORE), score))
    return F.when(score.isNotNull(), held)


def sparse_dot(left_idx: Column, left_val: Column, right_idx: Column, right_val: Column) -> Column:
    """Dot product of two sparse vectors held as parallel index and value arrays."""
    products = F.zip_with(
        left_idx,
        left_val,
        lambda i, v: v
        * F.coalesce(F.get(right_val, (F.array_position(right_idx, i) - 1).cast("int")), F.lit(0.0)),
    )
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(values: Column) -> Column:
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x))


def similarity_rating(cosine: Column) -> Column:
    """Cosine mapped to the rating scale; the default rating where there is none."""
    return F.coalesce(F.lit(1.0) + F.lit(4.0) * cosine, F.lit(DEFAULT_RATING))


def blended(als: Column, cbf: Column, default: float | None = None) -> Column:
    """Weighted mean where both models have a value, else the one present, else the default."""
    both = als * F.lit(ALS_WEIGHT) + cbf * F.lit(CBF_WEIGHT)
    return F.coalesce(both, als, cbf, F.lit(default).cast("double"))
