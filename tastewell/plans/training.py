"""The training job: split, fit, evaluate, choose the winner, store metrics and lists."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell import schemas
from tastewell.constants import (
    HYBRID_MIN_VOTES,
    LIST_SIZE,
    MODELS,
    QUALITY_MIN_AVERAGE,
    QUALITY_MIN_VOTES,
    SPLIT_SEED,
    TRAIN_FRACTION,
)
from tastewell.operators.content import (
    content_predictions,
    content_rows,
    content_top_k,
    item_features,
    item_vectors,
    liked_movies,
    quality_candidates,
    user_profiles,
)
from tastewell.operators.evaluation import (
    compared_models,
    evaluation_sample,
    winners,
    with_winner_flag,
)
from tastewell.operators.factorisation import Factors, als_predictions, als_top_k, fit_als
from tastewell.operators.hybrid import hybrid_predictions, hybrid_top_k
from tastewell.operators.ratings import in_train_set, split_at_random
from tastewell.operators.statistics import movie_statistics, movies_with_votes
from tastewell.session import written
from tastewell.sources.tables import load_dataset, read_table, table_exists, write_table


@dataclass
class TrainingConfig:
    """Thresholds and sizes of a run."""

    models: Sequence[str] = field(default_factory=lambda: list(MODELS))
    k: int = LIST_SIZE
    content_pool: int = LIST_SIZE
    likes_per_user: int | None = None
    min_average: float = QUALITY_MIN_AVERAGE
    min_votes: int = QUALITY_MIN_VOTES
    max_candidates: int | None = None
    hybrid_min_votes: int = HYBRID_MIN_VOTES
    hybrid_scale: str = "reference"
    eval_fraction: float = 1.0
    als_ranks: Sequence[int] = (10,)
    als_regularisations: Sequence[float] = (0.1,)
    als_blocks: int | None = None
    split: str = "key"
    train_fraction: float = TRAIN_FRACTION
    split_seed: int = SPLIT_SEED
    updated_at: datetime | None = None


@dataclass
class ContentModel:
    """Written results of the content steps; lists, predictions and the hybrid share them."""

    vectors: DataFrame
    profiles: DataFrame
    candidates: DataFrame


def chosen_models(name: str) -> list[str]:
    """``all``, or one model by name."""
    if name == "all":
        return list(MODELS)
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}")
    return [name]


def fit_content(
    train: DataFrame, movies: DataFrame, tags: DataFrame | None, config: TrainingConfig
) -> ContentModel:
    vectors = written(item_vectors(content_rows(movies, tags)), "vectors")
    likes = liked_movies(train, per_user=config.likes_per_user)
    candidates = quality_candidates(
        item_features(vectors, movie_statistics(train)),
        config.min_average,
        config.min_votes,
        config.max_candidates,
    )
    return ContentModel(
        vectors,
        written(user_profiles(likes, vectors), "profiles"),
        written(candidates, "candidates"),
    )


def predictions(
    test: DataFrame, als: Factors | None, content: ContentModel | None, models: Sequence[str]
) -> DataFrame:
    """Test rows with a prediction column for every model, added one beside the other."""
    predicted = als_predictions(test, als)
    if content is not None:
        predicted = content_predictions(predicted, content.profiles, content.vectors)
    if "hybrid" in models:
        predicted = hybrid_predictions(predicted)
    return predicted


def recommendation_lists(
    als: Factors | None, content: ContentModel | None, train: DataFrame, config: TrainingConfig
) -> DataFrame:
    """The lists of all chosen models in one table, ``model, userId, rank, movieId, score``."""
    lists: dict[str, DataFrame] = {}
    if "als" in config.models:
        lists["als"] = als_top_k(als, config.k)
    if "cbf" in config.models:
        lists["cbf"] = content_top_k(content.profiles, content.candidates, config.k)
    if "hybrid" in config.models:
        # The pools hold what the hybrid may show: movies with enough votes that the user has not rated.
        voted = written(movies_with_votes(train, config.hybrid_min_votes), "voted")
        candidates = written(content.candidates.join(voted, "movieId", "left_semi"), "voted-candidates")
        lists["hybrid"] = hybrid_top_k(
            als_top_k(als, 2 * config.k, movies=voted, history=train),
            content_top_k(content.profiles, candidates, config.content_pool, history=train),
            train,
            config.k,
            config.hybrid_min_votes,
            config.hybrid_scale,
        )
    columns = ["userId", "rank", "movieId", "score"]
    return reduce(
        DataFrame.unionByName,
        [lists[m].select(F.lit(m).alias("model"), *columns) for m in config.models],
    )


def split_ratings(ratings: DataFrame, config: TrainingConfig) -> tuple[DataFrame, DataFrame]:
    """Train and test set by the rule on the key, or at random with the run's seed."""
    if config.split == "key":
        # Many steps read the train set: the digests of the keys are computed once.
        sides = written(ratings.withColumn("_in_train", in_train_set(config.train_fraction)), "sides")
        return sides.filter("_in_train").drop("_in_train"), sides.filter("NOT _in_train").drop("_in_train")
    if config.split != "random":
        raise ValueError(f"unknown split {config.split!r}")
    # Written, so that both sides come from one draw.
    train, test = split_at_random(ratings, config.train_fraction, config.split_seed)
    return written(train, "train"), written(test, "test")


def run_training(
    spark: SparkSession, root: str, run_id: str, config: TrainingConfig | None = None
) -> DataFrame:
    """Train on the stored tables, store lists and metrics, return the metrics of the run.

    The split is a rule on the key and written once beside the ratings, so train and test set are scans with a filter:
    nothing has to stay in memory, and a lost executor costs a rescan. A run can be repeated: its lists
    replace those of its models, its metrics those of its run id. The metrics come last; they name
    the winner, so an unfinished run has none.
    """
    config = config or TrainingConfig()
    updated_at = config.updated_at or datetime.now(timezone.utc)
    ratings, movies, tags = load_dataset(spark, root)
    train, test = split_ratings(ratings, config)
    needs_als = "als" in config.models or "hybrid" in config.models
    needs_content = "cbf" in config.models or "hybrid" in config.models
    als = fit_als(train, config.als_ranks, config.als_regularisations, blocks=config.als_blocks) if needs_als else None
    content = fit_content(train, movies, tags, config) if needs_content else None

    scored = predictions(evaluation_sample(test, config.eval_fraction), als, content, config.models)
    errors = compared_models(scored, models=config.models).select(
        F.lit(run_id).alias("run_id"), "model", "rmse", "mae", F.lit(updated_at).cast("timestamp").alias("updated_at")
    )
    metrics = written(with_winner_flag(written(errors, "errors")), "metrics")

    winner = winners(metrics).select("winner_model").scalar()
    lists = recommendation_lists(als, content, train, config).withColumn(
        "is_winner", F.coalesce(F.col("model") == winner, F.lit(False))
    )
    rows = written(lists.select(*schemas.RECOMMENDATIONS.fieldNames()), "lists")
    # A model whose lists are empty now has no partition that would replace its earlier lists.
    listed = {r["model"] for r in rows.select("model").distinct().collect()}
    write_table(rows, root, "recommendations", emptied=tuple(m for m in config.models if m not in listed))
    kept = metrics
    if table_exists(spark, root, "model_metrics"):
        others = read_table(spark, root, "model_metrics").filter(F.col("run_id") != run_id)
        kept = written(others.unionByName(metrics), "all-metrics")
    write_table(kept, root, "model_metrics", mode="overwrite")
    return metrics
