from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tastewell.operators import lists as li
from tastewell.operators import reports as rp
from tastewell.operators import statistics as st

MOVIE = "movieId long, title string, genres string, avg_rating double, rating_count long"
RECS = "model string, userId long, rank int, movieId long, score double, is_winner boolean"


@pytest.fixture(scope="module")
def movies(spark):
    return spark.createDataFrame(
        [(1, "One", "Action|Drama", 3.5, 4), (2, None, None, 2.0, 9), (3, "Three", "", None, None), (4, "Four", "Drama", 4.0, 9)],
        MOVIE,
    )


@pytest.fixture(scope="module")
def recs(spark):
    return spark.createDataFrame(
        [
            ("als", 2, 1, 1, 6.0, False),
            ("hybrid", 10, 1, 4, 3.125, True),
            ("hybrid", 10, 2, 77, 2.0, True),
            ("hybrid", 2, 1, 2, -1.0, True),
            ("hybrid", 2, 2, 1, 2.25, True),
        ],
        RECS,
    )


def test_recommendations_drop_unknown_movies_and_keep_order(recs, movies, rows):
    got = rows(rp.recommendations_for(recs, movies).select("userId", "rank", "movieId", "title", "genres", "avg_rating", "pred_rating"))
    assert got == [
        (10, 1, 4, "Four", "Drama", 4.0, 3.12),
        (2, 1, 2, "Unknown", "Unknown", 2.0, 0.0),
        (2, 2, 1, "One", "Action|Drama", 3.5, 2.25),
    ]
    one = rp.recommendations_for(recs, movies, users=[2], model="ALS").collect()
    assert [(r.movieId, r.pred_rating) for r in one] == [(1, 5.0)]
    assert rp.recommendations_for(recs, movies, users=[99]).count() == 0


def test_user_filter_reaches_the_scan(spark, recs, movies, tmp_path):
    recs.write.partitionBy("model").parquet(f"{tmp_path}/r")
    stored = spark.read.parquet(f"{tmp_path}/r")
    plan = rp.recommendations_for(stored, movies, users=[2], model="als")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model" in plan and "EqualTo(userId,2)" in plan


def test_listing_and_search(recs, movies):
    listing = rp.recommendation_listing(recs, movies)
    got = {r.userId: (r.total, r.details) for r in listing.collect()}
    assert got == {10: (2, "Four (3.1★) | ID:77 (2.0★)"), 2: (2, "Unknown (0.0★) | One (2.2★)")}
    first = rp.recommendation_listing(recs, movies, limit=1).collect()
    assert [r.userId for r in first] == [10]
    found = lambda q, **kw: sorted(r.userId for r in rp.search_listing(listing, q, **kw).collect())
    assert found("FOUR|one") == [2, 10]
    assert found("^1") == [10]
    assert found("[") == [2, 10]
    assert found("[", literal=True) == []
    assert found("(2.2", literal=True) == [2]
    assert found("") == [2, 10]


def test_details_defaults(spark, movies):
    tags = spark.createDataFrame([(1, 1, "fun", 1)], "userId long, movieId long, tag string, ts long")
    got = {r.movieId: (r.title, r.genres, r.avg_rating, r.rating_count, r.tags) for r in rp.movie_details(movies, tags).collect()}
    assert got[1][-1] == "fun"
    assert got[2][:2] == ("Unknown", "--")
    assert got[3] == ("Three", "", 0.0, 0, "")


def test_history_views(spark, movies, rows):
    day = 86400
    ratings = spark.createDataFrame(
        [(1, 1, 4.0, 5 * day), (1, 2, 5.0, 5 * day), (1, 9, 3.0, 0), (1, 4, 1.0, 9 * day)],
        "userId long, movieId long, rating double, ts long",
    )
    history = rp.user_history(ratings, movies)
    numbered = rp.user_history(ratings, movies, places=True).orderBy("ordinal").collect()
    assert [(r.movieId, r.title, r.genres, str(r.date)) for r in numbered] == [
        (4, "Four", "Drama", "1970-01-10"),
        (2, "Unknown", "--", "1970-01-06"),
        (1, "One", "Action|Drama", "1970-01-06"),
        (9, "ID:9", "Unknown", "None"),
    ]
    profile = st.user_genre_profile(history)
    assert rows(profile) == [(1, "--", 5.0, 1), (1, "Action", 4.0, 1), (1, "Drama", 2.5, 2), (1, "Unknown", 3.0, 1)]
    assert rows(st.user_top_genre(profile)) == [(1, "Drama", 2)]
    assert rows(st.user_summary(ratings)) == [(1, 4, 3.25)]


def test_genres_skip_markers_and_blanks(spark, rows):
    movies = spark.createDataFrame(
        [(1, "a", "Drama|War"), (2, "b", "Drama||"), (3, "c", "(no genres listed)"), (4, "d", "")],
        "movieId long, title string, genres string",
    )
    genres = st.genre_counts(movies)
    assert rows(genres) == [("Drama", 2), ("War", 1)]
    assert rows(st.genre_totals(genres)) == [(3, "Drama", 2, 1.5)]
    assert rows(st.genre_chart(genres, 0.4)) == [("Drama", 2, "2", 1), ("War", 1, "", 2)]


def test_bins_zero_filled(spark):
    ratings = spark.createDataFrame([(1, 4.0), (2, 4.0), (3, 3.3), (4, None)], "userId long, rating double")
    histogram = st.rating_histogram(ratings)
    bins = {r.rating: r["count"] for r in st.binned_histogram(histogram).collect()}
    assert len(bins) == 10 and bins[4.0] == 2 and sum(bins.values()) == 2
    empty = st.binned_histogram(st.rating_histogram(ratings.limit(0)))
    assert empty.select(F.sum("count")).first()[0] == 0 and empty.count() == 10
    assert st.wide_histogram(histogram).first().r_4_0 == 2


def test_top_movies_ties_and_zero(movies):
    assert [(r.movieId, r.title) for r in rp.top_movies(movies).collect()] == [(2, "Unknown"), (4, "Four"), (1, "One")]


def test_run_reports(spark, movies):
    runs = [("a", "als", 1.5, 1.0, 1), ("a", "cbf", 2.0, 1.5, 1), ("b", "als", 1.25, 0.75, 2)]
    metrics = spark.createDataFrame(
        [(r, m, x, y, datetime(2024, 1, d)) for r, m, x, y, d in runs] + [("b", "LATEST_RUN", 9.0, 9.0, datetime(2024, 1, 1))],
        "run_id string, model string, rmse double, mae double, updated_at timestamp",
    )
    only = metrics.filter("model <> 'LATEST_RUN'")
    latest = rp.latest_run(only).first()
    assert (latest.winner_model, latest.rmse, latest.rmse_delta) == ("ALS", "1.2500", "-0.2500")
    compared = {r.model: r.rmse for r in rp.model_comparison(metrics).collect()}
    assert compared == {"als": 1.25, "cbf": 2.0}
    counts = spark.createDataFrame([(1500, 2, 3)], "user_count long, movie_count long, rating_count long")
    shown = rp.overview_report(counts, only).first()
    assert (shown.user_count, shown.rmse_score, shown.rmse_delta) == ("1,500", "1.2500", "-0.2500")
    none = rp.overview_report(counts, only.limit(0)).first()
    assert (none.rmse_score, none.rmse_delta) == ("N/A", None)
    genres = st.genre_counts(movies)
    report = {(r.section, r.label): r.value for r in rp.report_rows(counts, only, genres).collect()}
    assert report[("scale", "users")] == "1,500"
    assert report[("models", "ALS")] == "RMSE = 1.2500 | MAE = 0.7500"
    assert report[("genres", "Drama")] == "2"


def test_list_forms(recs, rows):
    flat = recs.filter("is_winner").select("userId", "rank", "movieId", "score")
    assert rows(li.to_flat(li.to_lists(flat))) == rows(flat)
    texts = li.serialised(li.to_lists(flat))
    assert rows(texts) == [(10, "4:3.12,77:2.00"), (2, "2:0.00,1:2.25")]
    assert li.to_flat(li.parsed(texts)).count() == 4
    assert rows(li.listed_movies(flat)) == [(1,), (2,), (4,), (77,)]


def test_rating_pages(spark):
    ratings = spark.createDataFrame([(1, m, 3.0) for m in range(2500)], "userId long, movieId long, rating double")
    pages = rp.user_rating_pages(ratings)
    assert sorted(len(r.ratings) for r in pages.collect()) == [500, 1000, 1000]


def test_entered_ids(spark, rows):
    ids = spark.createDataFrame([("12",), ("x1",), ("",), ("-3",)], "entered string")
    assert rows(rp.valid_user_ids(ids)) == [(12,)]


def test_genre_tasks_follow_the_length_of_the_history(spark):
    history = spark.createDataFrame([(u, 1.0 + u % 5, "Drama|War") for u in range(20)], "userId long, rating double, genres string")
    profile = st.user_top_genre(st.user_genre_profile(history, 20_000_000))
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and ", 40), REPARTITION_BY_NUM" in plan
    assert profile.count() == 20
