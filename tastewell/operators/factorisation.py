"""Matrix factorisation by alternating least squares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastewell.constants import ALS_RANK, ALS_REGULARISATION, LIST_SIZE, SPLIT_SEED
from tastewell.operators.scoring import top_by_passes
from tastewell.session import enable_checkpoints, written

MIN_BLOCKS = 8
# A row's factors travel to every block that holds one of its ratings, in every round: more blocks mean more copies of all
# factors. So blocks are as large as a task can hold: 12 bytes a rating, some 400 MB.
RATINGS_PER_BLOCK = 32_000_000
ITEMS_PER_PASS = 500_000  # 10 doubles each: some 40 MB, and half of that in single precision; blocks get closer the more there are
LARGEST_ID = 2**31 - 1  # of the solver's own ids


@dataclass
class Factors:
    """The fitted factors: ``userId, features`` and ``movieId, features``."""

    users: DataFrame
    movies: DataFrame
    rank: int


def block_count(ratings: int) -> int:
    """Blocks for so many ratings; the cluster does not matter, so equal data gives equal factors."""
    return max(MIN_BLOCKS, -(-ratings // RATINGS_PER_BLOCK))


def dense_ids(ids: DataFrame, column: str, dense: str) -> DataFrame:
    """Every distinct id with a number from 0 on without gaps, in the order of the ids.

    Ids are sorted in ranges and numbered inside each; only the sizes of the ranges are summed up in one place.
    """
    ordered = ids.select(column).distinct().dropna().repartitionByRange(column).sortWithinPartitions(column)
    # The upper bits are the range's number, the lower 33 the place in it.
    numbered = written(ordered.withColumn("_place", F.monotonically_increasing_id()), "ids")
    part, place = F.shiftrightunsigned("_place", 33), F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return numbered.join(starts, part == F.col("_part")).select(column, (F.col("_start") + place).alias(dense))


def fit_als(
    train: DataFrame,
    ranks: Sequence[int] = (ALS_RANK,),
    regularisations: Sequence[float] = (ALS_REGULARISATION,),
    folds: int = 2,
    seed: int = SPLIT_SEED,
    blocks: int | None = None,
) -> Factors:
    """Explicit, nonnegative factors.

    More than one grid point is cross-validated on RMSE; a single point leaves nothing to
    choose and is fitted once. Lineage is cut every ten rounds in the shared folder. Ids are of 64 bits;
    those beyond the solver's 32 are numbered for it.
    """
    spark = train.sparkSession
    enable_checkpoints(spark)
    ids = ["userId", "movieId"]
    size = train.agg(F.count("*"), *[f(c) for c in ids for f in (F.min, F.max)]).first()
    blocks = blocks or block_count(size[0])
    ratings = train.select("userId", "movieId", "rating")
    numbers: dict[str, DataFrame] = {}
    for column, least, most in zip(ids, size[1::2], size[2::2], strict=True):
        if least is not None and (least < -LARGEST_ID or most > LARGEST_ID):
            numbers[column] = written(dense_ids(ratings, column, "_dense"), f"dense-{column}")
            ratings = ratings.join(numbers[column], column).drop(column).withColumnRenamed("_dense", column)
    ratings = ratings.select(*[F.col(c).cast("int") for c in ids], "rating")
    als = ALS(
        userCol="userId",
        itemCol="movieId",
        ratingCol="rating",
        nonnegative=True,
        coldStartStrategy="nan",
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=10,
        seed=seed,
    )
    points = (
        ParamGridBuilder()
        .addGrid(als.rank, list(ranks))
        .addGrid(als.regParam, list(regularisations))
        .build()
    )
    if len(points) == 1:
        return _factors(als.fit(ratings, points[0]), numbers)
    search = CrossValidator(
        estimator=als.setColdStartStrategy("drop"),
        estimatorParamMaps=points,
        evaluator=RegressionEvaluator(metricName="rmse", labelCol="rating", predictionCol="prediction"),
        numFolds=folds,
        seed=seed,
    )
    return _factors(search.fit(ratings).bestModel, numbers)


def _factors(model, numbers: dict[str, DataFrame]) -> Factors:
    """The model's factors under the ids of the ratings."""
    sides = []
    for found, column in ((model.userFactors, "userId"), (model.itemFactors, "movieId")):
        if column in numbers:
            found = found.join(numbers[column], F.col("id") == F.col("_dense")).select(column, "features")
        else:
            found = found.select(F.col("id").cast("bigint").alias(column), "features")
        sides.append(written(found.withColumn("features", F.col("features").cast("array<double>")), f"factors-{column}"))
    return Factors(*sides, model.rank)


def als_predictions(test: DataFrame, model: Factors | None) -> DataFrame:
    """Test rows with ``pred_als``, null for users or movies not seen in training.

    Rows are kept, so further predictions are added beside it without another join.
    """
    if model is None:
        return test.withColumn("pred_als", F.lit(None).cast("double"))
    movies = model.movies.withColumnRenamed("features", "_movie")
    people = model.users.withColumnRenamed("features", "_user")
    products = F.zip_with("_user", "_movie", lambda x, y: x * y)
    # Without one of the sides the product is null.
    value = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
    scored = test.join(movies, "movieId", "left").join(people, "userId", "left")
    return scored.select(*[F.col(c) for c in test.columns], value.alias("pred_als"))


def als_top_k(
    model: Factors,
    k: int = LIST_SIZE,
    users: DataFrame | None = None,
    movies: DataFrame | None = None,
    history: DataFrame | None = None,
    skipped=None,
) -> DataFrame:
    """The ``k`` best movies of every user: ``userId, rank, movieId, score``.

    ``users`` and ``movies`` restrict both sides by their ids before anything is multiplied; with a ``history`` a
    user's rated movies are left out, otherwise they are included. ``skipped``, an accumulator, counts the blocks
    of movies that bounds ruled out.
    """
    places = F.transform(F.col("features"), lambda x, i: i)
    vector = [places.alias("idx"), F.col("features").alias("val"), F.lit(1.0).alias("norm")]
    people = model.users.select("userId", *vector)
    items = model.movies.select("movieId", *vector, F.lit(0.0).alias("base"))
    if users is not None:
        people = people.join(users.select("userId"), "userId", "left_semi")
    if movies is not None:
        items = items.join(movies.select("movieId"), "movieId", "left_semi")
    return top_by_passes(people, items, k, model.rank, ITEMS_PER_PASS, 1.0, history, skipped)
