"""Errors of predictions, the winner of a run, and the change between runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tastewell.constants import MODELS, SPLIT_SEED


def evaluation_sample(test: DataFrame, fraction: float = 1.0, seed: int = SPLIT_SEED) -> DataFrame:
    """The test rows to score; all of them unless a fraction is asked for."""
    return test if fraction >= 1.0 else test.sample(False, fraction, seed=seed)


def rating_errors(
    predicted: DataFrame, prediction: str, by: Sequence[str] = (), label: str = "rating"
) -> DataFrame:
    """RMSE and MAE in one pass, with the rows scored and their share of all rows."""
    error = F.col(label) - F.col(prediction)
    return predicted.groupBy(*by).agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.count(error).alias("scored"),
        (F.count(error) / F.count("*")).alias("coverage"),
    )


def compared_models(
    predicted: DataFrame, by: Sequence[str] = (), models: Sequence[str] = MODELS
) -> DataFrame:
    """Errors of every ``pred_{model}`` column as rows ``model, rmse, mae, scored, coverage``.

    The test rows are read once for all models.
    """
    pairs = F.array(
        *[F.struct(F.lit(m).alias("model"), F.col(f"pred_{m}").alias("prediction")) for m in models]
    )
    long = predicted.select(*by, "rating", F.explode(pairs).alias("p")).select(*by, "rating", "p.*")
    return rating_errors(long, "prediction", [*by, "model"])


def _model_order() -> Column:
    return F.coalesce(
        *[F.when(F.col("model") == m, F.lit(i)) for i, m in enumerate(MODELS)], F.lit(len(MODELS))
    )


def winners(metrics: DataFrame) -> DataFrame:
    """The model of each run with the lowest RMSE; ties go to the first in model order.

    A run without any finite RMSE has a null winner.
    """
    usable = F.col("rmse").isNotNull() & ~F.isnan("rmse") & (F.col("rmse") < float("inf"))
    best = F.min(F.when(usable, F.struct("rmse", _model_order(), "model", "mae"))).alias("best")
    return (
        metrics.groupBy("run_id")
        .agg(best, F.max("updated_at").alias("updated_at"))
        .select(
            "run_id",
            F.col("best.model").alias("winner_model"),
            F.col("best.rmse").alias("rmse"),
            F.col("best.mae").alias("mae"),
            "updated_at",
        )
    )


def with_winner_flag(metrics: DataFrame) -> DataFrame:
    """Metrics of runs with ``is_winner`` beside each model."""
    best = winners(metrics).select("run_id", "winner_model")
    return metrics.join(best, "run_id", "left").select(
        *[F.col(c) for c in metrics.columns],
        F.coalesce(F.col("model") == F.col("winner_model"), F.lit(False)).alias("is_winner"),
    )


def rmse_changes(metrics: DataFrame) -> DataFrame:
    """Winner of each run and the change of its RMSE against the run before.

    One row per run is ordered here, not one per rating.
    """
    over_time = Window.orderBy("updated_at", "run_id")
    return winners(metrics).withColumn(
        "rmse_change", F.col("rmse") - F.lag("rmse").over(over_time)
    )
