"""The hybrid model: blended lists and blended predictions of the two other models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.constants import DEFAULT_RATING, HYBRID_MIN_VOTES, LIST_SIZE, MAX_SCORE
from tastewell.functions.ranking import top_per_key
from tastewell.functions.scores import blended
from tastewell.operators.statistics import movies_with_votes


def blend_lists(als: DataFrame, cbf: DataFrame, scale: str = "reference") -> DataFrame:
    """Both lists as one, ``userId, movieId, score``: a full outer join on user and movie.

    Every list holds a movie once, so the join is written as a grouped union: one shuffle, and
    the result stays partitioned by user and movie for the history filter that follows.

    ``scale="reference"`` blends the scores as they are, though content scores end at 1 and
    factor scores at 5; ``scale="rating"`` first brings content scores to the rating scale.
    """
    if scale not in ("reference", "rating"):
        raise ValueError(f"unknown scale {scale!r}")
    factor = MAX_SCORE if scale == "rating" else 1.0
    none = F.lit(None).cast("double")
    both = als.select(
        "userId", "movieId", F.col("score").alias("score_als"), none.alias("score_cbf")
    ).unionByName(
        cbf.select(
            "userId", "movieId", none.alias("score_als"), (F.col("score") * factor).alias("score_cbf")
        )
    )
    return (
        both.groupBy("userId", "movieId")
        .agg(F.max("score_als").alias("score_als"), F.max("score_cbf").alias("score_cbf"))
        .select("userId", "movieId", blended(F.col("score_als"), F.col("score_cbf")).alias("score"))
    )


def without_rated(scored: DataFrame, history: DataFrame) -> DataFrame:
    """Drop what the user has rated, whatever the rating."""
    return scored.join(history.select("userId", "movieId"), ["userId", "movieId"], "left_anti")


def with_enough_votes(scored: DataFrame, ratings: DataFrame, min_votes: int = HYBRID_MIN_VOTES) -> DataFrame:
    """Keep movies with at least so many ratings."""
    return scored.join(movies_with_votes(ratings, min_votes), "movieId", "left_semi")


def hybrid_top_k(
    als: DataFrame | None,
    cbf: DataFrame | None,
    history: DataFrame,
    k: int = LIST_SIZE,
    min_votes: int = HYBRID_MIN_VOTES,
    scale: str = "reference",
) -> DataFrame:
    """The ``k`` best blended movies of every user: unrated, with enough votes.

    With one model missing the other's list is passed through as it is.
    """
    if als is None or cbf is None:
        only = cbf if als is None else als
        if only is None:
            raise ValueError("the hybrid model needs at least one list")
        return only
    fresh = without_rated(blend_lists(als, cbf, scale), history)
    fit = with_enough_votes(fresh, history, min_votes)
    order = [F.desc("score"), F.asc("movieId")]
    return top_per_key(fit, ["userId"], order, k).select("userId", "rank", "movieId", "score")


def hybrid_predictions(predicted: DataFrame, missing_als: float | None = None) -> DataFrame:
    """Rows holding ``pred_als`` and ``pred_cbf`` with ``pred_hybrid`` beside them.

    A missing factor prediction leaves the content prediction alone, or counts as ``missing_als``.
    """
    als = F.coalesce("pred_als", F.lit(missing_als).cast("double"))
    value = blended(als, F.col("pred_cbf"), default=DEFAULT_RATING)
    return predicted.withColumn("pred_hybrid", value)
