"""The registered queries: every operator over the whole driver tables.

Each takes a session and a table folder and returns a frame. ``oracle.py`` holds the SQL twins.
Thresholds differ from the defaults where the defaults select nothing on these tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell import fixtures as fx
from tastewell.constants import HYBRID_MIN_VOTES, LATEST_RUN, LISTING_USERS
from tastewell.functions.display import fixed
from tastewell.functions.scores import clamp
from tastewell.operators import content as cb
from tastewell.operators import evaluation as ev
from tastewell.operators import factorisation as fa
from tastewell.operators import hybrid as hy
from tastewell.operators import lists as li
from tastewell.operators import maintained as mt
from tastewell.operators import reports as rp
from tastewell.operators import statistics as st
from tastewell.operators.ratings import latest_ratings, split_by_key
from tastewell.operators.search_index import search_stored, store_listing
from tastewell.plans.statistics_job import merge_ratings, write_statistics
from tastewell.plans.training import TrainingConfig, run_training
from tastewell.session import scratch_path, written
from tastewell.sources import csv_files, result_files, stored_rows
from tastewell.sources.tables import merge_statistics, merge_table, read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Values that bite on the driver tables.
LIKES = 10
MIN_AVERAGE = 2.8
MIN_VOTES = 30
LIST_MIN_VOTES = 25
DECIMALS = 6
SMALL_UNIT = 20_000  # rows: several units at every size
SMALL_PAGE = 500


def _rounded(df: DataFrame, *names: str, places: int = DECIMALS) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name in names})


# --- Shared inputs ----------------------------------------------------------------------


def enriched(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    stats = st.movie_statistics(fx.ratings_raw(spark, sf) if lines is None else lines)
    return merge_statistics(fx.movies(spark, sf), stats)


def content(spark: SparkSession, sf: str) -> DataFrame:
    return cb.movie_content(fx.movies(spark, sf), fx.tags(spark, sf))


def pieces(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return cb.content_rows(fx.movies(spark, sf), fx.tags(spark, sf) if lines is None else fx.tags_of(lines))


def vectors(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    return written(cb.item_vectors(pieces(spark, sf, lines)), "vectors")


def profiles(ratings: DataFrame, items: DataFrame) -> DataFrame:
    return cb.user_profiles(cb.liked_movies(ratings), items)


def _best_rated(rated: DataFrame, means: DataFrame, k: int, score: Column) -> DataFrame:
    """Each user's ``k`` movies among the rated ones with the best means."""
    scored = rated.join(means, "movieId").select("userId", "movieId", score.alias("score"))
    order = [F.desc("score"), F.asc("movieId")]
    return cb.top_per_key(scored, ["userId"], order, k).select("userId", "rank", "movieId", "score")


def _als_of(ratings: DataFrame, means: DataFrame) -> DataFrame:
    return _best_rated(ratings, means, 20, F.col("avg_rating"))


def _cbf_of(tags: DataFrame, means: DataFrame) -> DataFrame:
    return _best_rated(tags.select("userId", "movieId").distinct(), means, 10, F.col("avg_rating") / 5.0)


def surrogate_als(spark: SparkSession, sf: str) -> DataFrame:
    """Lists with a known answer: each user's 20 rated movies with the best means."""
    ratings = written(fx.ratings(spark, sf), "ratings")
    return _als_of(ratings, st.movie_statistics(ratings))


def surrogate_cbf(spark: SparkSession, sf: str) -> DataFrame:
    """Lists with a known answer: each user's 10 tagged movies with the best means, on 0..1."""
    return _cbf_of(fx.tags(spark, sf), st.movie_statistics(fx.ratings(spark, sf)))


def rated_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with their orders, joined once and written: ratings, tags and means all come from them."""
    return written(fx.rated_lines(spark, sf), "lines")


def surrogate_pair(lines: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``surrogate_als``, ``surrogate_cbf`` and the training ratings from lines that are joined already."""
    ratings = written(latest_ratings(lines), "ratings")
    means = written(st.movie_statistics(ratings), "means")
    # The digests of the keys are computed once; votes and history both read the train set.
    train = written(split_by_key(ratings)[0], "train")
    return _als_of(ratings, means), _cbf_of(fx.tags_of(lines), means), train


def surrogate_lists(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """The stored list table made of the surrogates, the hybrid as winner."""
    als, cbf, train = surrogate_pair(rated_lines(spark, sf) if lines is None else lines)
    als, cbf = written(als, "als"), written(cbf, "cbf")
    hybrid = hy.hybrid_top_k(als, cbf, train, min_votes=LIST_MIN_VOTES)
    parts = {"als": als.filter("rank <= 10"), "cbf": cbf, "hybrid": hybrid}
    tables = [
        df.select(F.lit(m).alias("model"), "userId", "rank", "movieId", "score", F.lit(m == "hybrid").alias("is_winner"))
        for m, df in parts.items()
    ]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def _lists_and_movies(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The list table and the movies with their means, from one join of the lines."""
    lines = rated_lines(spark, sf)
    return surrogate_lists(spark, sf, lines), enriched(spark, sf, lines)


def surrogate_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows with the movie's and the user's training mean as two models' predictions."""
    train, test = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    by_movie = train.groupBy("movieId").agg(F.avg("rating").alias("pred_als"))
    by_user = train.groupBy("userId").agg(F.avg("rating").alias("pred_cbf"))
    both = test.join(by_movie, "movieId", "left").join(by_user, "userId", "left")
    return hy.hybrid_predictions(both)


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """A run history: the ratings of one calendar year are one run's test set."""
    year = F.year(rp.epoch_date(F.col("ts"))).cast("string")
    predicted = surrogate_predictions(spark, sf).withColumn("run_id", year)
    ends = F.timestamp_seconds(F.unix_date(F.make_date(F.col("run_id").cast("int"), F.lit(12), F.lit(31))).cast("bigint") * 86400)
    errors = ev.compared_models(predicted, by=["run_id"]).select(
        "run_id", "model", "rmse", "mae", ends.alias("updated_at")
    )
    return written(errors, "runs")


# --- Sources and sinks ------------------------------------------------------------------


def ratings_latest(spark, sf):
    return fx.ratings(spark, sf)


def tags_clean(spark, sf):
    return fx.tags(spark, sf)


def ingest_movies(spark, sf):
    """Quotes, commas and line breaks in titles survive the CSV reader."""
    title = F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"\n'), F.col("p_type"))
    rows = fx.table(spark, sf, "part").select(
        F.col("p_partkey").alias("movieId"), title.alias("title"), F.col("p_type").alias("genres")
    )
    path = scratch_path(spark, "movies-csv")
    rows.write.csv(path, header=True, quoteAll=True, escape='"')
    good, _ = csv_files.read_movies(spark, path)
    return csv_files.last_written(good, ["movieId"])


def _movies_csv(spark, sf) -> str:
    """Movie lines; some short, some long, some with an open quote, some quoted with commas."""
    key = F.col("p_partkey")
    line = (
        F.when(key % 7 == 0, F.concat(key, F.lit(","), F.col("p_name")))
        .when(key % 7 == 1, F.concat(key, F.lit(","), F.col("p_name"), F.lit(","), F.col("p_type"), F.lit(",extra")))
        .when(key % 7 == 2, F.concat(key, F.lit(',"'), F.col("p_name"), F.lit(","), F.col("p_type")))
        .otherwise(F.concat(key, F.lit(',"'), F.col("p_name"), F.lit(', ""'), F.col("p_brand"), F.lit('""",'), F.col("p_type")))
    )
    path = scratch_path(spark, "movie-lines")
    # One raw column: a separator and a quote that no line holds leave the lines as they are.
    lines = fx.table(spark, sf, "part").select(line.alias("movieId,title,genres"))
    lines.write.csv(path, header=True, sep="\x01", quote="\x00", escape="\x00")
    return path


def ingest_movies_split(spark, sf):
    """Good rows of split files, whatever columns are asked for."""
    return _split_movies(spark, sf)[0].drop("_position")


def _split_movies(spark, sf):
    return csv_files.read_movies(spark, _movies_csv(spark, sf), multi_line=False)


def ingest_overview(spark, sf):
    """Counts from split files: good rows, and rejects by reason."""
    good, rejects = _split_movies(spark, sf)
    accepted = good.agg(F.lit("accepted").alias("reason"), F.count("*").alias("rows"))
    return accepted.unionByName(rejects.groupBy("reason").agg(F.count("*").alias("rows")))


def movie_line_count(spark, sf):
    """Lines per movie in the ratings files, malformed ratings included."""
    path = scratch_path(spark, "rating-lines")
    lines = fx._lines_with_orders(spark, sf)
    rating = F.when(F.col("l_linenumber") == 7, "n/a").otherwise("4.0")
    lines.select("userId", "movieId", rating.alias("rating"), F.col("ts").alias("timestamp")).write.csv(path, header=True)
    return csv_files.line_counts(spark, path)


def _ratings_csv(spark, sf) -> str:
    """Rating lines in time order, so the last in the files is the latest; some malformed."""
    bad = F.col("l_linenumber") == 7
    rows = fx._lines_with_orders(spark, sf).select(
        "userId",
        "movieId",
        F.when(bad, "n/a")
        .otherwise((F.ceil(F.col("l_quantity") / 5.0).cast("double") / 2).cast("string"))
        .alias("rating"),
        F.col("ts").alias("timestamp"),
    )
    path = scratch_path(spark, "ratings-csv")
    rows.orderBy("timestamp", "rating").write.csv(path, header=True)
    return path


def ingest_ratings(spark, sf):
    good, _ = csv_files.read_ratings(spark, _ratings_csv(spark, sf))
    return csv_files.last_written(good, ["userId", "movieId"])


def wide_ids(spark, sf):
    """Ids beyond 32 bits, through the CSV reader and the latest of each key."""
    far = F.lit(3_000_000_000)
    rows = fx.ratings(spark, sf).select(
        (F.col("userId") + far).alias("userId"), (F.col("movieId") + far).alias("movieId"), "rating", F.col("ts").alias("timestamp")
    )
    path = scratch_path(spark, "wide-csv")
    rows.write.csv(path, header=True)
    good, _ = csv_files.read_ratings(spark, path)
    return csv_files.last_written(good, ["userId", "movieId"])


def loaded_twice(spark, sf):
    """Two loads into one store: the second brings new keys and other ratings of every fourth user."""
    root = scratch_path(spark, "twice")
    ratings = written(fx.ratings(spark, sf), "ratings")
    again = F.col("userId") % 4 == 0
    merge_table(ratings.filter("movieId % 3 <> 0"), root, "ratings", rows_per_unit=SMALL_UNIT)
    second = ratings.filter((F.col("movieId") % 3 == 0) | again)
    second = second.withColumns({"rating": F.when(again, 5.5 - F.col("rating")).otherwise(F.col("rating")), "ts": F.col("ts") + 1})
    merge_table(second, root, "ratings", rows_per_unit=SMALL_UNIT)
    return read_table(spark, root, "ratings")


def _after_deltas(spark, sf) -> str:
    """A store after five loads, each with a fifth of the movies and other ratings of a seventh of the users."""
    root = scratch_path(spark, "deltas")
    ratings = written(fx.ratings(spark, sf), "ratings")
    for delta in range(5):
        again = (F.col("userId") % 7 == delta) & (F.col("movieId") % 5 < delta)
        rows = ratings.filter((F.col("movieId") % 5 == delta) | again)
        merge_ratings(rows.withColumn("rating", F.when(again, 5.5 - F.col("rating")).otherwise(F.col("rating"))), root, SMALL_UNIT)
    return root


def statistics_after_deltas(spark, sf):
    """Mean and count per movie, moved along with five loads."""
    return mt.statistics_of(read_table(spark, _after_deltas(spark, sf), "rating_counts"))


def overview_after_deltas(spark, sf):
    """Distinct users by their bits, ratings and the most frequent value after five loads."""
    root = _after_deltas(spark, sf)
    counts = read_table(spark, root, "rating_counts")
    users = mt.bit_count(read_table(spark, root, "user_bits")).select("n").scalar()
    top = mt.histogram_of(counts).agg(F.max_by("rating", F.struct("count", "rating")).alias("top_rating"), F.sum("count").alias("rating_count"))
    return top.select(users.alias("user_count"), "rating_count", "top_rating")


def _tags_csv(spark, sf) -> str:
    path = scratch_path(spark, "tags-csv")
    rows = fx.tags_raw(spark, sf).withColumnRenamed("ts", "timestamp")
    rows.write.csv(
        path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    return path


def ingest_tags(spark, sf):
    return csv_files.read_tags(spark, _tags_csv(spark, sf))[0]


def ingest_rejects(spark, sf):
    _, ratings = csv_files.read_ratings(spark, _ratings_csv(spark, sf))
    _, tags = csv_files.read_tags(spark, _tags_csv(spark, sf))
    return ratings.unionByName(tags).groupBy("source", "reason").agg(F.count("*").alias("rows"))


def wide_ratings(spark, sf):
    """Ratings to wide stored rows and back."""
    return stored_rows.ratings_from_wide(stored_rows.ratings_to_wide(fx.ratings(spark, sf)))


def stored_movies(spark, sf):
    """Movies from text cells; empty genres are stored as a missing cell."""
    movies = fx.movies(spark, sf)
    cells = F.map_from_arrays(
        F.array(F.lit("info:title"), F.lit("info:genres")), F.array("title", "genres")
    )
    present = F.map_filter(cells, lambda _, value: value != "")
    return stored_rows.movies_from_cells(
        movies.select(F.col("movieId").cast("string").alias("key"), present.alias("cells"))
    )


def tag_layouts(spark, sf):
    """Every tag stored in one of the three layouts, by its word, and read back."""
    tags = fx.tags_raw(spark, sf)
    user, movie = F.col("userId").cast("string"), F.col("movieId").cast("string")
    time = F.col("ts").cast("string")
    explicit = F.create_map(
        F.lit("info:userId"), user, F.lit("info:movieId"), movie,
        F.lit("info:tag"), F.col("tag"), F.lit("info:timestamp"), time,
    )
    compound = F.create_map(F.lit("info:tag"), F.col("tag"), F.lit("info:timestamp"), time)
    wide = F.create_map(F.concat(F.lit("tag:"), movie), F.trim("tag"))
    urgent, low = F.col("tag") == "urgent", F.col("tag") == "low"
    stored = tags.select(
        F.when(urgent, F.lit("0000000001"))
        .when(low, F.concat_ws("_", user, movie))
        .otherwise(user)
        .alias("key"),
        F.when(urgent, explicit).when(low, compound).otherwise(wide).alias("cells"),
    )
    return stored_rows.tags_from_cells(stored)


def result_files_merged(spark, sf):
    """Counts and shown means through text result files, merged into the movies."""
    ratings = fx.ratings_raw(spark, sf)
    counts, means = scratch_path(spark, "counts"), scratch_path(spark, "means")
    result_files.write_pairs(st.rating_counts(ratings), counts)
    shown = st.average_ratings(ratings).select("movieId", fixed(F.col("avg_rating"), 2).alias("m"))
    result_files.write_pairs(shown, means)
    count = result_files.movie_statistic(result_files.read_pairs(spark, counts), "rating_count", "bigint")
    mean = result_files.movie_statistic(result_files.read_pairs(spark, means), "avg_rating", "double")
    return merge_statistics(fx.movies(spark, sf), mean.join(count, "movieId", "full_outer"))


def genre_result_files(spark, sf):
    path = scratch_path(spark, "genres")
    result_files.write_pairs(st.genre_counts(fx.movies(spark, sf)), path)
    return result_files.genre_statistic(result_files.read_pairs(spark, path))


def stored_statistics(spark, sf):
    """The statistics tables written and read back through the schema check."""
    root = scratch_path(spark, "store")
    movies = fx.movies(spark, sf)
    write_statistics(written(fx.ratings_raw(spark, sf), "raw"), movies, movies, root)
    movies_back = read_table(spark, root, "movies")
    checks = [
        movies_back.agg(F.count("*").alias("rows"), F.sum("rating_count").alias("total")),
        read_table(spark, root, "genre_stats").agg(F.count("*").alias("rows"), F.sum("count").alias("total")),
        read_table(spark, root, "rating_stats").agg(F.count("*").alias("rows"), F.sum("count").alias("total")),
        read_table(spark, root, "system_stats").agg(F.count("*").alias("rows"), F.sum("rating_count").alias("total")),
    ]
    names = ["movies", "genre_stats", "rating_stats", "system_stats"]
    named = [df.withColumn("table_name", F.lit(n)) for n, df in zip(names, checks)]
    return named[0].unionByName(named[1]).unionByName(named[2]).unionByName(named[3])


def stored_recommendations(spark, sf):
    """The list table written by model and read back for the winner."""
    root = scratch_path(spark, "store")
    write_table(surrogate_lists(spark, sf), root, "recommendations")
    stored = read_table(spark, root, "recommendations").filter("is_winner")
    return stored.select("model", "userId", "rank", "movieId", "score")


# --- Statistics -------------------------------------------------------------------------


def movie_rating_count(spark, sf):
    return st.rating_counts(fx.ratings_raw(spark, sf))


def movie_avg_rating(spark, sf):
    return st.average_ratings(fx.ratings_raw(spark, sf))


def genre_count(spark, sf):
    return rp.genre_listing(st.genre_counts(fx.movies(spark, sf)))


def genre_summary(spark, sf):
    return st.genre_totals(st.genre_counts(fx.movies(spark, sf)))


def genre_chart(spark, sf):
    return st.genre_chart(st.genre_counts(fx.movies(spark, sf)))


def rating_distribution(spark, sf):
    return st.rating_histogram(fx.ratings_raw(spark, sf))


def rating_bins(spark, sf):
    return st.binned_histogram(st.rating_histogram(fx.ratings_raw(spark, sf)))


def rating_bins_wide(spark, sf):
    return st.wide_histogram(st.rating_histogram(fx.ratings_raw(spark, sf)))


def system_overview(spark, sf):
    return st.system_overview(fx.ratings_raw(spark, sf), fx.movies(spark, sf))


def movie_enriched(spark, sf):
    return enriched(spark, sf)


def movie_details(spark, sf):
    return rp.movie_details(enriched(spark, sf), fx.tags(spark, sf))


def top_movies(spark, sf):
    return rp.top_movies(enriched(spark, sf))


def _history(spark, sf):
    return rp.user_history(fx.ratings(spark, sf), fx.movies(spark, sf))


def user_history(spark, sf):
    return _history(spark, sf).withColumn("date", F.col("date").cast("string"))


def user_history_numbered(spark, sf):
    placed = rp.user_history(fx.ratings(spark, sf), fx.movies(spark, sf), places=True)
    return placed.select(
        "userId", "ordinal", "movieId", "title", "rating", F.col("date").cast("string").alias("date")
    )


def user_history_summary(spark, sf):
    return st.user_summary(fx.ratings(spark, sf))


def user_genre_profile(spark, sf):
    ratings = written(fx.ratings(spark, sf), "ratings")
    return st.user_genre_profile(rp.user_history(ratings, fx.movies(spark, sf)), ratings.count())


def user_top_genre(spark, sf):
    return st.user_top_genre(user_genre_profile(spark, sf))


def user_ratings_map(spark, sf):
    pages = rp.user_rating_pages(fx.ratings(spark, sf))
    return pages.select("userId", F.explode("ratings").alias("movieId", "rating"))


# --- Content model ----------------------------------------------------------------------


def movie_tags_text(spark, sf):
    return cb.movie_tags_text(fx.tags(spark, sf))


def movie_content(spark, sf):
    return content(spark, sf)


def tfidf_terms(spark, sf):
    return _rounded(cb.term_weights(written(pieces(spark, sf), "content")), "weight")


def tfidf_hashed(spark, sf):
    total = F.aggregate("val", F.lit(0.0), lambda a, x: a + x)
    items = cb.item_vectors(pieces(spark, sf))
    return _rounded(items.select("movieId", total.alias("total"), "norm"), "total", "norm")


def liked_movies(spark, sf):
    return cb.liked_movies(fx.ratings(spark, sf), per_user=LIKES)


def user_profile(spark, sf):
    people = profiles(fx.ratings(spark, sf), vectors(spark, sf))
    total = F.aggregate("val", F.lit(0.0), lambda a, x: a + x)
    return _rounded(people.select("userId", total.alias("total"), "norm"), "total", "norm")


def item_features(spark, sf):
    features = cb.item_features(vectors(spark, sf), st.movie_statistics(fx.ratings(spark, sf)))
    return _rounded(features.select("movieId", "norm", "avg_rating", "rating_count"), "norm")


def quality_candidates(spark, sf):
    stats = st.movie_statistics(fx.ratings(spark, sf))
    features = cb.item_features(vectors(spark, sf), stats)
    chosen = cb.quality_candidates(features, MIN_AVERAGE, MIN_VOTES)
    return chosen.select("movieId", "avg_rating", "rating_count")


def quality_limit(spark, sf):
    """The most voted of the well rated movies, up to a limit."""
    features = cb.item_features(vectors(spark, sf), st.movie_statistics(fx.ratings(spark, sf)))
    return cb.quality_candidates(features, MIN_AVERAGE, MIN_VOTES, limit=40).select("movieId", "avg_rating", "rating_count")


def _content_model(ratings: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Profiles and candidates of one set of ratings, written."""
    features = cb.item_features(items, st.movie_statistics(ratings))
    candidates = cb.quality_candidates(features, MIN_AVERAGE, MIN_VOTES)
    return written(profiles(ratings, items), "profiles"), written(candidates, "candidates")


def cbf_topk(spark, sf):
    lines = rated_lines(spark, sf)
    ratings = written(latest_ratings(lines), "ratings")
    return cb.content_top_k(*_content_model(ratings, vectors(spark, sf, lines)))


def _content_predictions(spark, sf) -> DataFrame:
    train, test = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    items = vectors(spark, sf)
    return cb.content_predictions(test, profiles(train, items), items)


def cbf_predictions(spark, sf):
    return _rounded(_content_predictions(spark, sf), "pred_cbf")


def cbf_eval(spark, sf):
    errors = ev.rating_errors(_content_predictions(spark, sf), "pred_cbf")
    return _rounded(errors, "rmse", "mae", "coverage")


# --- Lists and hybrid -------------------------------------------------------------------


def split_counts(spark, sf):
    train, test = split_by_key(fx.ratings(spark, sf))
    sides = train.select(F.lit("train").alias("side"), "rating").unionByName(
        test.select(F.lit("test").alias("side"), "rating")
    )
    return sides.groupBy("side").agg(F.count("*").alias("rows"), F.sum("rating").alias("total"))


def split_by_user(spark, sf):
    """Test rows of each user."""
    _, test = split_by_key(fx.ratings(spark, sf))
    return test.groupBy("userId").agg(F.count("*").alias("rows"), F.sum("movieId").alias("movies"))


def _with_nulls(spark, sf) -> DataFrame:
    """Ratings some of which lack the rating, some the time."""
    return fx.ratings(spark, sf).select(
        "userId",
        "movieId",
        F.when(F.col("movieId") % 10 != 3, F.col("rating")).alias("rating"),
        F.when(F.col("movieId") % 10 != 4, F.col("ts")).alias("ts"),
    )


def ratings_latest_nulls(spark, sf):
    """Latest ratings where times and ratings are missing."""
    return latest_ratings(_with_nulls(spark, sf).unionByName(fx.ratings(spark, sf).filter("movieId % 10 = 4").withColumn("ts", F.lit(-1).cast("bigint"))))


def user_history_numbered_nulls(spark, sf):
    """Every row keeps its place, also without a rating or a date."""
    placed = rp.user_history(_with_nulls(spark, sf), fx.movies(spark, sf), places=True)
    return placed.select("userId", "ordinal", "movieId", "rating", F.col("date").cast("string").alias("date"))


def recs_flat(spark, sf):
    """Lists gathered per user and taken apart again."""
    return li.to_flat(li.to_lists(surrogate_als(spark, sf)))


def recs_serialized(spark, sf):
    return li.serialised(li.to_lists(surrogate_als(spark, sf)))


def recs_parsed(spark, sf):
    texts = li.serialised(li.to_lists(surrogate_als(spark, sf)))
    return li.to_flat(li.parsed(texts))


def recs_movies(spark, sf):
    return li.listed_movies(surrogate_als(spark, sf))


def scores_clamped(spark, sf):
    """Scores outside the scale are brought to its ends."""
    scored = fx.ratings_raw(spark, sf).select(
        "userId", "movieId", "ts", clamp(F.col("rating") * 2 - 3).alias("score")
    )
    return scored.groupBy("score").agg(F.count("*").alias("rows"))


def history_filter(spark, sf):
    train, _ = split_by_key(fx.ratings(spark, sf))
    return hy.without_rated(surrogate_als(spark, sf), train)


def min_votes_filter(spark, sf):
    ratings = written(fx.ratings(spark, sf), "ratings")
    return hy.with_enough_votes(surrogate_als(spark, sf), ratings, LIST_MIN_VOTES)


def hybrid_blend(spark, sf):
    return hy.blend_lists(surrogate_als(spark, sf), surrogate_cbf(spark, sf))


def hybrid_blend_rating_scale(spark, sf):
    blended = hy.blend_lists(surrogate_als(spark, sf), surrogate_cbf(spark, sf), "rating")
    return blended


def hybrid_lists(spark, sf):
    als, cbf, train = surrogate_pair(rated_lines(spark, sf))
    return hy.hybrid_top_k(als, cbf, train, min_votes=LIST_MIN_VOTES)


def hybrid_eval(spark, sf):
    """Movie mean and content similarity blended, all three compared on the test rows."""
    train, test = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    items = vectors(spark, sf)
    by_movie = train.groupBy("movieId").agg(F.avg("rating").alias("pred_als"))
    predicted = cb.content_predictions(
        test.join(by_movie, "movieId", "left"), profiles(train, items), items
    )
    errors = ev.compared_models(hy.hybrid_predictions(predicted))
    return _rounded(errors, "rmse", "mae", "coverage")


# --- Reports ----------------------------------------------------------------------------


def recs_for_user(spark, sf):
    shown = rp.recommendations_for(*_lists_and_movies(spark, sf))
    return shown


def recs_for_user_by_model(spark, sf):
    return rp.recommendations_for(*_lists_and_movies(spark, sf), model="ALS")


def community_vs_predicted(spark, sf):
    shown = rp.recommendations_for(*_lists_and_movies(spark, sf))
    return rp.community_comparison(shown)


def recs_listing(spark, sf):
    return rp.recommendation_listing(*_lists_and_movies(spark, sf), LISTING_USERS)


def recs_search(spark, sf):
    listing = rp.recommendation_listing(*_lists_and_movies(spark, sf))
    return rp.search_listing(listing, "RED (bolt|ring)")


def recs_search_indexed(spark, sf):
    """The same search over a stored listing, through its index."""
    root = scratch_path(spark, "listing")
    store_listing(written(rp.recommendation_listing(*_lists_and_movies(spark, sf)), "listing"), root, SMALL_PAGE)
    return search_stored(spark, root, "RED (bolt|ring)")


def model_metrics(spark, sf):
    return _rounded(
        ev.with_winner_flag(run_metrics(spark, sf)).select("run_id", "model", "rmse", "mae", "is_winner"),
        "rmse",
        "mae",
    )


def metrics_from_cells(spark, sf):
    """Metrics as stored text cells in two families, read with fallback."""
    runs = run_metrics(spark, sf)
    family = F.when(F.col("model") == "cbf", "b:").otherwise("info:")
    cells = F.create_map(
        F.concat(family, F.lit("rmse")), F.col("rmse").cast("string"),
        F.concat(family, F.lit("mae")), F.col("mae").cast("string"),
    )
    stored = runs.select(F.concat_ws("-", "run_id", "model").alias("key"), cells.alias("cells"))
    return _rounded(stored_rows.metrics_from_cells(stored), "rmse", "mae")


def winner(spark, sf):
    return _rounded(ev.winners(run_metrics(spark, sf)).drop("updated_at"), "rmse", "mae")


def rmse_delta(spark, sf):
    changes = ev.rmse_changes(run_metrics(spark, sf)).drop("updated_at", "mae")
    return _rounded(changes, "rmse", "rmse_change")


def latest_run(spark, sf):
    return rp.latest_run(run_metrics(spark, sf)).drop("updated_at")


def model_comparison(spark, sf):
    return _rounded(rp.model_comparison(run_metrics(spark, sf)).drop("updated_at"), "rmse", "mae")


def comparison_with_summary(spark, sf):
    """Rows that sum up a run stand among the metrics and are no model."""
    runs = run_metrics(spark, sf)
    summary = runs.withColumns({"model": F.lit(LATEST_RUN), "rmse": F.lit(0.0)})
    return _rounded(rp.model_comparison(runs.unionByName(summary)).drop("updated_at"), "rmse", "mae")


def entered_ids(spark, sf):
    """Which texts are ids: of digits only, and within 64 bits."""
    comment = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey").cast("string")).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("-"), F.col("o_custkey")))
    entered = F.coalesce(comment, F.concat(F.col("o_orderkey"), F.lit("99999999999999999999")))
    return rp.valid_user_ids(fx.table(spark, sf, "orders").select(entered.alias("entered")))


def evaluation_share(spark, sf):
    """A tenth of the test rows, drawn with a seed: none twice, all of them test rows, about a tenth."""
    _, test = split_by_key(fx.ratings(spark, sf))
    test = written(test, "test")
    drawn = written(ev.evaluation_sample(test, 0.1), "drawn")
    again = ev.evaluation_sample(test, 0.1)
    keys = ["userId", "movieId"]
    share = drawn.count() / max(1, test.count())
    counts = {
        "foreign_rows": drawn.join(test, keys, "left_anti").count(),
        "repeated": drawn.count() - drawn.select(*keys).distinct().count(),
        "other_when_drawn_again": drawn.exceptAll(again).count(),
    }
    row = [F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
    return spark.range(1).select(*row, F.lit(0.08 < share < 0.12).alias("about_a_tenth"))


def overview_report(spark, sf):
    return rp.overview_report(system_overview(spark, sf), run_metrics(spark, sf))


def report_rows(spark, sf):
    genres = st.genre_counts(fx.movies(spark, sf))
    return rp.report_rows(system_overview(spark, sf), run_metrics(spark, sf), genres)


# --- Factorisation and the training job: iterative, so twins hold for their shape only ----


def als_topk(spark, sf):
    train, _ = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    return fa.als_top_k(fa.fit_als(train))


def als_eval(spark, sf):
    train, test = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    return ev.rating_errors(fa.als_predictions(test, fa.fit_als(train)), "pred_als")


def hybrid_topk(spark, sf):
    """Both models fitted to the same training ratings; only unrated movies with enough votes."""
    lines = rated_lines(spark, sf)
    train, _ = split_by_key(latest_ratings(lines))
    return _hybrid_lists(spark, sf, written(train, "train"), lines)


def _hybrid_lists(spark, sf, train: DataFrame, lines: DataFrame) -> DataFrame:
    voted = written(st.movies_with_votes(train, HYBRID_MIN_VOTES), "voted")
    people, candidates = _content_model(train, vectors(spark, sf, lines))
    fit = written(candidates.join(voted, "movieId", "left_semi"), "voted-candidates")
    model = fa.fit_als(train)
    als = fa.als_top_k(model, 20, movies=voted, history=train)
    cbf = cb.content_top_k(people, fit, 10, history=train)
    return hy.hybrid_top_k(als, cbf, train)


def _small_thresholds() -> TrainingConfig:
    return TrainingConfig(min_average=MIN_AVERAGE, min_votes=20)


def training_run(spark, sf):
    """All three models trained, compared and stored; the metrics of the run."""
    root = scratch_path(spark, "store")
    lines = rated_lines(spark, sf)
    movies = fx.movies(spark, sf)
    write_statistics(lines.drop("tag"), movies, movies, root)
    write_table(latest_ratings(lines), root, "ratings")
    write_table(fx.tags_of(lines), root, "tags")
    metrics = run_training(spark, root, "first", _small_thresholds())
    stored = read_table(spark, root, "recommendations").groupBy("model").agg(
        F.count_distinct("userId").alias("users"), F.count("*").alias("items")
    )
    return metrics.join(stored, "model", "left").drop("updated_at")


def als_list_shape(spark, sf):
    """What must hold for factor lists whatever the factors: one row of counts."""
    train, _ = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    model = fa.fit_als(train)
    lists = written(fa.als_top_k(model), "lists")
    shape = _list_shape(lists)
    known = lists.join(train.select("movieId").distinct(), "movieId", "left_anti").agg(F.count("*").alias("unknown_movies"))
    return shape.crossJoin(F.broadcast(known))


def _list_shape(lists: DataFrame) -> DataFrame:
    """One row: users, rows, lists that are not ranked 1 to their length, that repeat a movie or whose scores rise."""
    by_user = lists.groupBy("userId").agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("entries"), F.count_distinct("movieId").alias("movies")
    )
    steps = F.transform("entries", lambda x, i: F.when(x.rank != i + 1, 1).otherwise(0))
    rises = F.transform("entries", lambda x, i: F.when((i > 0) & (x.score > F.get("entries", i - 1).score), 1).otherwise(0))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    return by_user.agg(
        F.count("*").alias("users"), F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.coalesce(F.sum(total(steps).cast("bigint")), F.lit(0)).alias("wrong_ranks"),
        F.coalesce(F.sum(total(rises).cast("bigint")), F.lit(0)).alias("rising_scores"), F.coalesce(F.sum(F.col("n") - F.col("movies")), F.lit(0)).alias("repeated_movies"),
    )


def als_rmse_bound(spark, sf):
    """Test rows with a prediction, and whether the error stays in reach of ratings that are noise."""
    train, test = split_by_key(written(fx.ratings(spark, sf), "ratings"))
    errors = ev.rating_errors(fa.als_predictions(test, fa.fit_als(train)), "pred_als")
    return errors.select("scored", (F.col("rmse") < 2.0).alias("bounded"))


def hybrid_invariants(spark, sf):
    """What must hold for hybrid lists of real models: nothing rated, enough votes, ranks and scores in order."""
    lines = rated_lines(spark, sf)
    train = written(split_by_key(latest_ratings(lines))[0], "train")
    lists = written(_hybrid_lists(spark, sf, train, lines), "lists")
    rated = lists.join(train, ["userId", "movieId"], "left_semi").agg(F.count("*").alias("rated"))
    voted = st.movies_with_votes(train, HYBRID_MIN_VOTES)
    few = lists.join(voted, "movieId", "left_anti").agg(F.count("*").alias("few_votes"))
    return _list_shape(lists).crossJoin(F.broadcast(rated)).crossJoin(F.broadcast(few)).drop("items")


def training_run_cbf(spark, sf):
    """The training job for the content model alone: its stored metrics."""
    root = scratch_path(spark, "store")
    movies = fx.movies(spark, sf)
    lines = rated_lines(spark, sf)
    write_statistics(lines.drop("tag"), movies, movies, root)
    write_table(latest_ratings(lines), root, "ratings")
    write_table(fx.tags_of(lines), root, "tags")
    config = TrainingConfig(models=["cbf"], min_average=MIN_AVERAGE, min_votes=20)
    run_training(spark, root, "only", config)
    stored = read_table(spark, root, "model_metrics")
    return _rounded(stored.select("run_id", "model", "rmse", "mae", "is_winner"), "rmse", "mae")


REGISTERED: list[Query] = [
    ratings_latest,
    tags_clean,
    ingest_movies,
    ingest_movies_split,
    ingest_overview,
    movie_line_count,
    ingest_ratings,
    ingest_tags,
    ingest_rejects,
    wide_ratings,
    stored_movies,
    tag_layouts,
    result_files_merged,
    genre_result_files,
    stored_statistics,
    stored_recommendations,
    movie_rating_count,
    movie_avg_rating,
    genre_count,
    genre_summary,
    genre_chart,
    rating_distribution,
    rating_bins,
    rating_bins_wide,
    system_overview,
    movie_enriched,
    movie_details,
    top_movies,
    user_history,
    user_history_numbered,
    user_history_summary,
    user_genre_profile,
    user_top_genre,
    user_ratings_map,
    movie_tags_text,
    movie_content,
    tfidf_terms,
    tfidf_hashed,
    liked_movies,
    user_profile,
    item_features,
    quality_candidates,
    cbf_topk,
    cbf_predictions,
    cbf_eval,
    split_counts,
    split_by_user,
    ratings_latest_nulls,
    user_history_numbered_nulls,
    recs_flat,
    recs_serialized,
    recs_parsed,
    recs_movies,
    scores_clamped,
    history_filter,
    min_votes_filter,
    hybrid_blend,
    hybrid_blend_rating_scale,
    hybrid_lists,
    hybrid_eval,
    recs_for_user,
    recs_for_user_by_model,
    community_vs_predicted,
    recs_listing,
    recs_search,
    model_metrics,
    metrics_from_cells,
    winner,
    rmse_delta,
    latest_run,
    model_comparison,
    overview_report,
    report_rows,
    als_topk,
    als_eval,
    hybrid_topk,
    training_run,
    recs_search_indexed,
    wide_ids,
    loaded_twice,
    statistics_after_deltas,
    overview_after_deltas,
    quality_limit,
    comparison_with_summary,
    entered_ids,
    evaluation_share,
    als_list_shape,
    als_rmse_bound,
    hybrid_invariants,
    training_run_cbf,
]


def registered() -> dict[str, Query]:
    return {query.__name__: query for query in REGISTERED}
