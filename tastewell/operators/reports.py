"""Lookup and report queries over the stored tables.

Lookups work on all users or on a given few: ``users`` becomes a pushed-down filter. No result
is ordered as a whole unless order is what the report is about; positions are columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastewell.constants import (
    LATEST_RUN,
    LIST_SIZE,
    MISSING_DETAIL,
    NOT_AVAILABLE,
    REPORT_GENRES,
    UNKNOWN,
)
from tastewell.functions.casting import to_long
from tastewell.functions.display import epoch_date, fixed, rounded, signed, thousands
from tastewell.functions.ranking import numbered
from tastewell.functions.scores import clamp
from tastewell.operators.evaluation import rmse_changes


def _of_users(df: DataFrame, users: Sequence[int] | None) -> DataFrame:
    return df if users is None else df.filter(F.col("userId").isin(list(users)))


def valid_user_ids(ids: DataFrame) -> DataFrame:
    """Entered ids that consist of digits only, as numbers."""
    entered = F.col("entered")
    return ids.filter(entered.rlike("^[0-9]+$")).select(to_long(entered).alias("userId")).dropna()


def _served(recommendations: DataFrame, model: str | None) -> DataFrame:
    """The lists of one model, or of the winner."""
    if model is None:
        return recommendations.filter("is_winner")
    return recommendations.filter(F.col("model") == model.lower())


def _shown_score(score: Column) -> Column:
    """A list score as stored lists show it."""
    return rounded(clamp(score), 2)


def recommendations_for(
    recommendations: DataFrame,
    movies: DataFrame,
    users: Sequence[int] | None = None,
    model: str | None = None,
) -> DataFrame:
    """List items with title, genres, community mean and predicted rating.

    Items missing from ``movies`` are left out; ``rank`` keeps the order of the list.
    """
    chosen = _of_users(_served(recommendations, model), users)
    return chosen.join(movies, "movieId").select(
        "userId",
        "rank",
        "movieId",
        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
        F.coalesce("genres", F.lit(UNKNOWN)).alias("genres"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        _shown_score(F.col("score")).alias("pred_rating"),
    )


def community_comparison(shown: DataFrame) -> DataFrame:
    """Community mean beside predicted rating for each recommended movie."""
    return shown.select(
        "userId",
        "movieId",
        "title",
        "avg_rating",
        clamp(F.col("pred_rating")).alias("pred_rating"),
        (clamp(F.col("pred_rating")) - F.col("avg_rating")).alias("difference"),
    )


def movie_details(movies: DataFrame, tags: DataFrame | None = None) -> DataFrame:
    """Movies with defaults for display, and all their different tags, the earliest first."""
    base = movies
    if tags is None:
        base = base.withColumn("tags_text", F.lit(None).cast("string"))
    else:
        # Repeats of a tag are combined before the shuffle; a row holds different tags only.
        first = tags.groupBy("movieId", "tag").agg(F.min("ts").alias("ts"))
        listed = F.sort_array(F.collect_list(F.struct("ts", "tag")))
        text = first.groupBy("movieId").agg(F.concat_ws(" ", F.transform(listed, lambda t: t["tag"])).alias("tags_text"))
        base = base.join(text, "movieId", "left")
    return base.select(
        "movieId",
        F.coalesce("title", F.lit(UNKNOWN)).alias("title"),
        F.coalesce("genres", F.lit(MISSING_DETAIL)).alias("genres"),
        F.coalesce("avg_rating", F.lit(0.0)).alias("avg_rating"),
        F.coalesce("rating_count", F.lit(0)).alias("rating_count"),
        F.coalesce("tags_text", F.lit("")).alias("tags"),
    )


def user_rating_pages(
    ratings: DataFrame, users: Sequence[int] | None = None, items_per_page: int = 1000
) -> DataFrame:
    """Movie-to-rating maps, one per user and page of movie ids, so every map is bounded."""
    page = F.floor(F.col("movieId") / items_per_page).alias("page")
    pairs = F.sort_array(F.collect_list(F.struct("movieId", "rating")))
    return (
        _of_users(ratings, users).groupBy("userId", page).agg(F.map_from_entries(pairs).alias("ratings"))
    )


def user_history(
    ratings: DataFrame,
    movies: DataFrame,
    users: Sequence[int] | None = None,
    places: bool = False,
) -> DataFrame:
    """Ratings with title, genres and date; a movie not in the table shows as ``ID:`` and its id.

    ``places`` adds ``ordinal``, the place in the user's history: newest first, then best
    rated, undated last. Long histories are numbered in parts of one day, rating and range of
    movie ids, before titles are joined.
    """
    dated = _of_users(ratings, users).withColumn("date", epoch_date(F.col("ts")))
    if places:
        day = F.coalesce("date", F.lit("0001-01-01").cast("date"))
        parts = [(day, True), (F.col("rating"), True), (F.floor(F.col("movieId") / 1024), False)]
        dated = numbered(dated, ["userId"], parts, [F.asc("movieId")])
    known = movies.select("movieId", "title", "genres", F.lit(True).alias("known"))
    return dated.join(known, "movieId", "left").select(
        "userId",
        "movieId",
        F.when(F.col("known"), F.coalesce("title", F.lit(UNKNOWN)))
        .otherwise(F.concat(F.lit("ID:"), F.col("movieId").cast("string")))
        .alias("title"),
        F.when(F.col("known"), F.coalesce("genres", F.lit(MISSING_DETAIL)))
        .otherwise(UNKNOWN)
        .alias("genres"),
        "rating",
        "date",
        *(["ordinal"] if places else []),
    )


def genre_listing(genres: DataFrame) -> DataFrame:
    """Genres by count, largest first."""
    return genres.orderBy(F.desc("count"), F.asc("genre"))


def top_movies(movies: DataFrame, limit: int = LIST_SIZE) -> DataFrame:
    """The most rated movies."""
    return (
        movies.filter(F.col("rating_count") > 0)
        .select("movieId", F.coalesce("title", F.lit(UNKNOWN)).alias("title"), "rating_count")
        .orderBy(F.desc("rating_count"), F.asc("movieId"))
        .limit(limit)
    )


def recommendation_listing(
    recommendations: DataFrame, movies: DataFrame, limit: int | None = None
) -> DataFrame:
    """One line per user: number of items and ``Title (4.5★)`` items.

    With a limit, the first users in text order of their id.
    """
    chosen = _served(recommendations, None)
    if limit is not None:
        first = (
            chosen.select("userId").distinct().orderBy(F.col("userId").cast("string")).limit(limit)
        )
        chosen = chosen.join(first, "userId", "left_semi")
    known = movies.select("movieId", F.coalesce("title", F.lit(UNKNOWN)).alias("title"))
    title = F.coalesce("title", F.concat(F.lit("ID:"), F.col("movieId").cast("string")))
    shown = F.concat(title, F.lit(" ("), fixed(_shown_score(F.col("score")), 1), F.lit("★)"))
    lines = F.sort_array(F.collect_list(F.struct("rank", shown.alias("shown"))))
    return (
        chosen.join(known, "movieId", "left")
        .groupBy("userId")
        .agg(
            F.count("*").alias("total"),
            F.array_join(F.transform(lines, lambda line: line["shown"]), " | ").alias("details"),
        )
    )


def search_listing(listing: DataFrame, query: str, literal: bool = False) -> DataFrame:
    """Lines whose user id or details contain the query, whatever the case.

    The query is a regular expression; one that is not valid leaves the listing unfiltered.
    ``literal`` looks for the text itself.
    """
    user, details = F.col("userId").cast("string"), F.col("details")
    if not query:
        return listing
    if literal:
        text = query.lower()
        return listing.filter(F.lower(user).contains(text) | F.lower(details).contains(text))
    if not valid_pattern(listing, query):
        return listing
    pattern = f"(?i){query}"
    return listing.filter(user.rlike(pattern) | details.rlike(pattern))


def valid_pattern(df: DataFrame, query: str) -> bool:
    """Whether the engine that will run the expression accepts it."""
    jvm = df.sparkSession.sparkContext._jvm
    try:
        jvm.java.util.regex.Pattern.compile(query)
    except Exception:  # the gateway wraps the Java syntax error
        return False
    return True


def model_comparison(metrics: DataFrame) -> DataFrame:
    """Errors of each model in its newest run; run summaries do not count as models."""
    newest = F.max(F.struct("updated_at", "run_id", "rmse", "mae")).alias("newest")
    return (
        metrics.filter(F.col("model") != LATEST_RUN)
        .groupBy("model")
        .agg(newest)
        .select("model", "newest.rmse", "newest.mae", "newest.updated_at")
    )


def latest_run(metrics: DataFrame) -> DataFrame:
    """The newest run: winner, RMSE, change against the run before, time; one row."""
    return (
        rmse_changes(metrics)
        .orderBy(F.desc("updated_at"), F.desc("run_id"))
        .limit(1)
        .select(
            F.coalesce(F.upper("winner_model"), F.lit(NOT_AVAILABLE)).alias("winner_model"),
            F.coalesce(fixed(F.col("rmse"), 4), F.lit(NOT_AVAILABLE)).alias("rmse"),
            signed(F.col("rmse_change")).alias("rmse_delta"),
            F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
        )
    )


def overview_report(counts: DataFrame, metrics: DataFrame) -> DataFrame:
    """One row of display texts: the three counts, RMSE of the newest run and its change."""
    run = latest_run(metrics)
    return counts.select(
        *[thousands(F.col(c)).alias(c) for c in ("user_count", "movie_count", "rating_count")],
        F.coalesce(run.select("rmse").scalar(), F.lit(NOT_AVAILABLE)).alias("rmse_score"),
        run.select("rmse_delta").scalar().alias("rmse_delta"),
    )


def report_rows(
    counts: DataFrame, metrics: DataFrame, genres: DataFrame, top: int = REPORT_GENRES
) -> DataFrame:
    """The content of the summary report as ``section, label, value`` rows."""
    scale = counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(label).alias("label"), thousands(F.col(name)).alias("value"))
                    for label, name in (
                        ("ratings", "rating_count"),
                        ("movies", "movie_count"),
                        ("users", "user_count"),
                    )
                ]
            )
        ).alias("row")
    ).select(F.lit("scale").alias("section"), "row.label", "row.value")
    models = model_comparison(metrics).select(
        F.lit("models").alias("section"),
        F.upper("model").alias("label"),
        F.concat(
            F.lit("RMSE = "), fixed(F.col("rmse"), 4), F.lit(" | MAE = "), fixed(F.col("mae"), 4)
        ).alias("value"),
    )
    largest = (
        genre_listing(genres)
        .limit(top)
        .select(
            F.lit("genres").alias("section"),
            F.col("genre").alias("label"),
            F.col("count").cast("string").alias("value"),
        )
    )
    return scale.unionByName(models).unionByName(largest)
