import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastewell.operators import content as cb
from tastewell.operators import evaluation as ev
from tastewell.operators import factorisation as fa
from tastewell.operators import hybrid as hy
from tastewell.operators.ratings import latest_ratings, split_at_random, split_by_key
from tastewell.operators.statistics import movie_statistics
from tastewell.plans.training import TrainingConfig, chosen_models, run_training
from tastewell.sources.tables import read_table, write_table

RATING = "userId long, movieId long, rating double, ts long"


def test_latest_rating_ties(spark, rows):
    raw = spark.createDataFrame(
        [(1, 1, 2.0, 5), (1, 1, 4.5, 5), (1, 1, 5.0, 4), (2, 1, 0.5, 0), (1, 2, 3.0, -7)], RATING
    )
    assert rows(latest_ratings(raw)) == [(1, 1, 4.5, 5), (1, 2, 3.0, -7), (2, 1, 0.5, 0)]


def test_latest_rating_combines_before_the_shuffle(spark):
    raw = spark.createDataFrame([(1, 1, 2.0, 5)], RATING)
    plan = latest_ratings(raw)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "SortAggregate" not in plan


def test_key_split_is_stable(spark, rows):
    df = spark.createDataFrame([(u, m, 3.0, 0) for u in range(30) for m in range(30)], RATING)
    train, test = split_by_key(df)
    again, _ = split_by_key(df.repartition(13))
    assert rows(train) == rows(again)
    assert train.count() + test.count() == 900
    assert train.join(test, ["userId", "movieId"]).count() == 0
    part, rest = split_at_random(df)
    assert part.count() + rest.count() == 900


def test_likes_cap_and_ties(spark, rows):
    df = spark.createDataFrame(
        [(1, 5, 4.0, 9), (1, 6, 5.0, 1), (1, 7, 4.0, 9), (1, 8, 4.0, 8), (1, 9, 3.5, 99)], RATING
    )
    assert rows(cb.liked_movies(df, per_user=2)) == [(1, 5, 4.0), (1, 6, 5.0)]


def test_tags_first_hundred_in_time_order(spark):
    tags = spark.createDataFrame([(1, 1, f"t{i}", 1000 - i) for i in range(150)], "userId long, movieId long, tag string, ts long")
    words = cb.movie_tags_text(tags).first().tags_text.split()
    assert words == [f"t{i}" for i in range(149, 49, -1)]


def _catalogue(spark):
    movies = spark.createDataFrame(
        [(1, "a", "Action|War"), (2, "b", "Drama"), (3, "c", ""), (4, "d", "Action"), (5, "e", "(no genres listed)")],
        "movieId long, title string, genres string",
    )
    tags = spark.createDataFrame(
        [(1, 1, "loud", 1), (1, 2, "The slow one", 2), (2, 4, "loud", 3)],
        "userId long, movieId long, tag string, ts long",
    )
    return movies, tags


def test_content_text(spark, rows):
    movies, tags = _catalogue(spark)
    assert dict(rows(cb.movie_content(movies, tags))) == {
        1: "Action War loud",
        2: "Drama The slow one",
        3: " ",
        4: "Action loud",
        5: "(no genres listed) ",
    }
    assert dict(rows(cb.movie_content(movies, without_genres_as_text=False)))[5] == ""


def _dense(row):
    vector = np.zeros(512)
    vector[row.idx] = row.val
    return vector


def test_profiles_and_lists_against_numpy(spark):
    movies, tags = _catalogue(spark)
    ratings = spark.createDataFrame(
        [(1, 1, 5.0, 1), (1, 2, 4.0, 1), (2, 4, 4.5, 1), (3, 3, 5.0, 1), (4, 1, 1.0, 1), (5, 99, 5.0, 1)], RATING
    )
    items = cb.item_vectors(cb.movie_content(movies, tags))
    people = cb.user_profiles(cb.liked_movies(ratings), items)
    vector = {r.movieId: _dense(r) for r in items.collect()}
    profile = {r.userId: _dense(r) for r in people.collect()}
    # User 3 likes a movie without words, user 4 likes nothing, user 5 an unknown movie.
    assert set(profile) == {1, 2, 3} and not profile[3].any()
    np.testing.assert_allclose(profile[1], (5 * vector[1] + 4 * vector[2]) / 9)

    features = cb.item_features(items, movie_statistics(ratings))
    candidates = cb.quality_candidates(features, 0.0, 0)
    averages = {r.movieId: r.avg_rating for r in candidates.collect()}
    for per_pass in (5000, 2):
        got = cb.content_top_k(people, candidates, k=3, per_pass=per_pass).collect()
        for user in (1, 2):
            scored = []
            for movie, average in averages.items():
                lengths = np.linalg.norm(vector[movie]) * np.linalg.norm(profile[user])
                cosine = vector[movie] @ profile[user] / lengths if lengths else 0.0
                scored.append((-round(0.6 * cosine + 0.4 * average / 5, 9), movie))
            expected = [(p, m, -s) for p, (s, m) in enumerate(sorted(scored)[:3], 1)]
            listed = sorted((r.rank, r.movieId, r.score) for r in got if r.userId == user)
            assert [x[:2] for x in listed] == [x[:2] for x in expected]
            np.testing.assert_allclose([x[2] for x in listed], [x[2] for x in expected])
        assert {r.userId for r in got} == {1, 2}


def test_no_candidates_gives_a_typed_empty_list(spark):
    movies, tags = _catalogue(spark)
    ratings = spark.createDataFrame([(1, 1, 5.0, 1)], RATING)
    items = cb.item_vectors(cb.movie_content(movies, tags))
    features = cb.item_features(items, movie_statistics(ratings))
    people = cb.user_profiles(cb.liked_movies(ratings), items)
    empty = cb.content_top_k(people, cb.quality_candidates(features))
    assert empty.count() == 0 and empty.columns == ["userId", "rank", "movieId", "score"]


def test_content_predictions_defaults(spark):
    movies, tags = _catalogue(spark)
    ratings = spark.createDataFrame([(1, 1, 5.0, 1), (3, 3, 5.0, 1)], RATING)
    items = cb.item_vectors(cb.movie_content(movies, tags))
    people = cb.user_profiles(cb.liked_movies(ratings), items)
    test = spark.createDataFrame([(1, 1, 5.0, 1), (1, 3, 1.0, 1), (3, 1, 1.0, 1), (9, 1, 1.0, 1), (1, 77, 1.0, 1)], RATING)
    got = {(r.userId, r.movieId): r.pred_cbf for r in cb.content_predictions(test, people, items).collect()}
    assert got.pop((1, 1)) == pytest.approx(5.0)
    assert set(got.values()) == {3.0} and len(got) == 4


FLAT = "userId long, rank int, movieId long, score double"


def test_hybrid_blend_against_pandas(spark):
    rng = np.random.default_rng(1)
    frames = []
    for scale in (5.0, 1.0):
        pairs = {(int(u), int(m)) for u, m in zip(rng.integers(0, 9, 80), rng.integers(0, 20, 80))}
        frames.append(pd.DataFrame([(u, 1, m, float(rng.random() * scale)) for u, m in pairs], columns=["userId", "rank", "movieId", "score"]))
    als, cbf = (spark.createDataFrame(f, FLAT) for f in frames)
    history = spark.createDataFrame([(u, m, 3.0, 0) for u in range(12) for m in range(u, 20, 3)], RATING)
    got = hy.hybrid_top_k(als, cbf, history, k=4, min_votes=4).toPandas()
    merged = frames[0].merge(frames[1], on=["userId", "movieId"], how="outer", suffixes=("_a", "_c"))
    merged["score"] = (0.7 * merged.score_a + 0.3 * merged.score_c).fillna(merged.score_a).fillna(merged.score_c)
    seen = {(u, m) for u in range(12) for m in range(u, 20, 3)}
    votes = pd.Series([m for _, m in seen]).value_counts()
    keep = [(u, m) not in seen and votes.get(m, 0) >= 4 for u, m in zip(merged.userId, merged.movieId)]
    merged = merged[keep].sort_values(["userId", "score", "movieId"], ascending=[True, False, True])
    expected = merged.groupby("userId").head(4)
    got = got.sort_values(["userId", "rank"])
    assert list(got.movieId) == list(expected.movieId) and len(got)
    np.testing.assert_allclose(got.score, expected.score)


def test_hybrid_passes_a_single_list_through(spark):
    only = spark.createDataFrame([(1, 1, 5, 2.0)], FLAT)
    history = spark.createDataFrame([(1, 5, 3.0, 0)], RATING)
    assert hy.hybrid_top_k(None, only, history) is only
    assert hy.hybrid_top_k(only, None, history) is only


def test_hybrid_prediction_cases(spark):
    df = spark.createDataFrame([(4.0, 2.0), (4.0, None), (None, 2.0), (None, None)], "pred_als double, pred_cbf double")
    assert [r[0] for r in hy.hybrid_predictions(df).select("pred_hybrid").collect()] == pytest.approx([3.4, 4.0, 2.0, 3.0])


METRIC = "run_id string, model string, rmse double, mae double, updated_at timestamp_ntz"


def test_winner_ties_nan_and_changes(spark):
    nan = float("nan")
    from datetime import datetime as at

    data = [
        ("a", "hybrid", 1.0, 0.5), ("a", "cbf", 1.0, 0.6), ("a", "als", nan, nan),
        ("b", "als", nan, nan), ("b", "cbf", float("inf"), 1.0),
        ("c", "als", 0.75, 0.5),
    ]
    days = {"a": 1, "b": 2, "c": 3}
    df = spark.createDataFrame([(*d, at(2024, 1, days[d[0]])) for d in data], METRIC)
    df = df.withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    best = {r.run_id: r.winner_model for r in ev.winners(df).collect()}
    assert best == {"a": "cbf", "b": None, "c": "als"}
    change = {r.run_id: r.rmse_change for r in ev.rmse_changes(df).collect()}
    assert change == {"a": None, "b": None, "c": None}
    only = df.filter("run_id <> 'b'")
    assert {r.run_id: r.rmse_change for r in ev.rmse_changes(only).collect()} == {"a": None, "c": -0.25}
    flags = ev.with_winner_flag(df).filter("is_winner").collect()
    assert sorted((r.run_id, r.model) for r in flags) == [("a", "cbf"), ("c", "als")]


def test_errors_report_coverage(spark):
    df = spark.createDataFrame([(3.0, 4.0), (1.0, 3.0), (2.0, None)], "rating double, p double")
    row = ev.rating_errors(df, "p").first()
    assert (row.mae, row.scored) == (1.5, 2)
    assert row.rmse == pytest.approx(2.5**0.5) and row.coverage == pytest.approx(2 / 3)


@pytest.fixture(scope="module")
def planted(spark):
    """Two groups with opposite tastes over two halves of a catalogue, some pairs held out."""
    rng = np.random.default_rng(7)
    data = []
    for user in range(60):
        for movie in range(40):
            if rng.random() < 0.7:
                likes = (user % 2) == (movie % 2)
                data.append((user, movie, float(rng.choice([4.5, 5.0] if likes else [0.5, 1.0, 1.5])), int(movie)))
    ratings = spark.createDataFrame(data, RATING)
    movies = spark.createDataFrame(
        [(m, f"m{m}", "Drama" if m % 2 else "Action") for m in range(40)], "movieId long, title string, genres string"
    )
    tags = spark.createDataFrame([(0, m, "calm" if m % 2 else "loud", 1) for m in range(40)], "userId long, movieId long, tag string, ts long")
    return ratings, movies, tags


def test_als_learns_planted_tastes(planted):
    train, test = split_by_key(planted[0])
    model = fa.fit_als(train)
    predicted = fa.als_predictions(test, model)
    row = ev.rating_errors(predicted, "pred_als").first()
    spread = test.select(F.stddev_pop("rating")).first()[0]
    assert row.rmse < 0.6 * spread
    lists = fa.als_top_k(model, 5)
    assert lists.groupBy("userId").count().filter("count <> 5").count() == 0
    assert lists.filter((F.col("userId") % 2) != (F.col("movieId") % 2)).count() == 0


def test_als_grid_search(planted):
    train, test = split_by_key(planted[0])
    model = fa.fit_als(train, ranks=(2, 4), regularisations=(0.1,))
    assert model.rank in (2, 4)
    unknown = test.limit(1).withColumn("userId", F.lit(999))
    assert fa.als_predictions(unknown, model).first().pred_als is None


def test_training_job(spark, planted, tmp_path):
    ratings, movies, tags = planted
    root = str(tmp_path)
    stats = movie_statistics(ratings)
    write_table(movies.join(stats, "movieId", "left").select("movieId", "title", "genres", "avg_rating", "rating_count"), root, "movies")
    write_table(ratings, root, "ratings")
    write_table(tags, root, "tags")
    config = TrainingConfig(min_average=0.0, min_votes=1, k=5, content_pool=10)
    metrics = run_training(spark, root, "one", config)
    assert metrics.filter("is_winner").count() == 1
    lists = read_table(spark, root, "recommendations")
    assert {r.model for r in lists.select("model").distinct().collect()} == {"als", "cbf", "hybrid"}
    assert lists.filter("rank > 5").count() == 0
    train, _ = split_by_key(read_table(spark, root, "ratings"))
    hybrid = lists.filter("model = 'hybrid'")
    listed = hybrid.count()
    assert listed > 0
    assert hybrid.join(train, ["userId", "movieId"], "left_semi").count() == 0
    increasing = lists.alias("a").join(lists.alias("b"), ["model", "userId"]).filter(
        "a.rank < b.rank and a.score < b.score"
    )
    assert increasing.count() == 0
    # A run of one model replaces its lists only, and its model is the only winner then.
    run_training(spark, root, "two", TrainingConfig(models=chosen_models("als"), k=3))
    lists = read_table(spark, root, "recommendations")
    assert {r.model for r in lists.filter("is_winner").select("model").distinct().collect()} == {"als"}
    assert lists.filter("model = 'hybrid'").count() == listed
    assert read_table(spark, root, "model_metrics").count() == 4


def test_unknown_model_name():
    with pytest.raises(ValueError):
        chosen_models("svd")


def test_split_fractions_hold(spark):
    df = spark.createDataFrame([(u, m, 3.0, 0) for u in range(60) for m in range(60)], RATING)
    for fraction in (0.85, 0.04):
        train, test = split_by_key(df, fraction)
        assert abs(train.count() / 3600 - fraction) < 0.02
        assert train.count() + test.count() == 3600
    for fraction in (0.0, 1.0, 0.00005):
        with pytest.raises(ValueError, match="fraction"):
            split_by_key(df, fraction)


def test_latest_rating_keeps_rows_without_a_time(spark, rows):
    raw = spark.createDataFrame([(1, 1, 4.0, None), (1, 2, 200000.0, 3), (1, 2, 1.0, 3), (1, 3, None, 2)], RATING)
    assert rows(latest_ratings(raw)) == [(1, 1, 4.0, 0), (1, 2, 200000.0, 3), (1, 3, None, 2)]


def test_pieces_give_the_vectors_of_the_joined_text(spark):
    movies, tags = _catalogue(spark)
    joined = {r.movieId: (r.idx, r.val) for r in cb.item_vectors(cb.movie_content(movies, tags)).collect()}
    pieces = {r.movieId: (r.idx, r.val) for r in cb.item_vectors(cb.content_rows(movies, tags)).collect()}
    assert pieces == joined


def test_vectors_equal_the_library_with_collisions(spark):
    from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer

    movies, tags = _catalogue(spark)
    content = cb.movie_content(movies, tags)
    words = StopWordsRemover(inputCol="w", outputCol="t").transform(Tokenizer(inputCol="content", outputCol="w").transform(content))
    counts = HashingTF(inputCol="t", outputCol="c", numFeatures=4).transform(words)
    expected = {r.movieId: r.v.toArray() for r in IDF(inputCol="c", outputCol="v").fit(counts).transform(counts).collect()}
    for r in cb.item_vectors(content, 4).collect():
        dense = np.zeros(4)
        dense[r.idx] = r.val
        np.testing.assert_allclose(dense, expected[r.movieId])


def test_thinned_candidates_lose_nothing(spark):
    rng = np.random.default_rng(4)
    kinds = [([0], [1.0]), ([1], [2.0]), ([0, 2], [1.0, 1.0]), ([], [])]
    data = []
    for movie in range(400):
        idx, val = kinds[rng.integers(4)]
        data.append((movie, idx, val, float(np.linalg.norm(val)), float(rng.integers(1, 6)) + float(rng.integers(0, 3)) * 1e-10))
    items = spark.createDataFrame(data, "movieId long, idx array<int>, val array<double>, norm double, avg_rating double")
    people = spark.createDataFrame([(u, [0, 1, 2], rng.random(3).tolist(), 1.0) for u in range(8)], "userId long, idx array<int>, val array<double>, norm double")
    assert cb.competitive_candidates(items, 3).count() < 200
    got = {(r.userId, r.rank): r.movieId for r in cb.content_top_k(people, items, 3, dimensions=3, per_pass=50).collect()}
    vectors = np.zeros((400, 3))
    for movie, idx, val, norm, _ in data:
        vectors[movie, idx] = np.array(val) / (norm or 1)
    base = np.array([d[4] for d in data]) / 5 * 0.4
    for r in people.collect():
        scores = np.round(0.6 * (vectors @ np.array(r.val)) + base, 9)
        best = sorted(range(400), key=lambda m: (-scores[m], m))[:3]
        assert [got[r.userId, i] for i in (1, 2, 3)] == best


def _planted_factors(spark, users, items, rank, seed=1):
    rng = np.random.default_rng(seed)
    # Few movies have long vectors, as popular ones do.
    people, movies = rng.random((users, rank)), rng.random((items, rank)) * (rng.random((items, 1)) ** 4 + 0.02)
    frames = [
        spark.createDataFrame(list(enumerate(v.tolist())), f"{name} long, features array<double>")
        for name, v in (("userId", people), ("movieId", movies))
    ]
    return fa.Factors(*frames, rank), people, movies


@pytest.mark.parametrize("per_pass", [50_000, 300])
def test_factor_lists_equal_the_full_product(spark, monkeypatch, per_pass):
    from tastewell.operators import scoring

    monkeypatch.setattr(fa, "ITEMS_PER_PASS", per_pass)
    monkeypatch.setattr(scoring, "ITEMS_PER_BLOCK", 64)
    monkeypatch.setattr(scoring.Candidates.__init__, "__defaults__", (64,))
    model, people, movies = _planted_factors(spark, 200, 1500, 6)
    rng = np.random.default_rng(9)
    seen = {u: set(rng.choice(1500, 1400 if u == 7 else 1500 if u == 8 else rng.integers(0, 40), replace=False).tolist()) for u in range(200)}
    history = spark.createDataFrame([(u, m, 1.0, 0) for u, ms in seen.items() for m in ms] + [(3, 10**12, 1.0, 0)], RATING)
    skipped = spark.sparkContext.accumulator(0)
    scores = np.round(people @ movies.T, 9)
    for lists, left_out in ((fa.als_top_k(model, 10, skipped=skipped), {}), (fa.als_top_k(model, 10, history=history), seen)):
        got = {}
        for r in lists.orderBy("userId", "rank").collect():
            got.setdefault(r.userId, []).append(r.movieId)
        for u in range(200):
            best = sorted(set(range(1500)) - left_out.get(u, set()), key=lambda m: (-scores[u, m], m))[:10]
            assert got.get(u, []) == best
    assert skipped.value > 0


def test_a_tile_is_small_whatever_the_number_of_movies():
    import tracemalloc

    from tastewell.operators import scoring

    rng = np.random.default_rng(2)
    n = 200_000
    block = pd.DataFrame({"movieId": np.arange(n), "idx": [np.arange(10)] * n, "val": list(rng.random((n, 10))), "norm": 1.0, "base": 0.0})
    candidates, users = scoring.Candidates(block, 10, 1.0), rng.random((scoring.USERS_PER_TILE, 10))
    tracemalloc.start()
    scoring.best_of(users, None, candidates, 10)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


def test_ids_beyond_32_bits_train(spark, planted):
    shift = 3_000_000_000
    train, test = split_by_key(planted[0])
    far = [df.withColumns({"userId": F.col("userId") + shift, "movieId": F.col("movieId") + shift}) for df in (train, test)]
    model = fa.fit_als(far[0])
    users = {r.userId for r in model.users.collect()}
    assert users == {r.userId for r in far[0].select("userId").distinct().collect()}
    scored = fa.als_predictions(far[1], model)
    assert scored.filter("pred_als is null").count() < 20
    assert ev.rating_errors(scored, "pred_als").first().rmse < 1.0


def test_dense_ids(spark):
    ids = spark.createDataFrame([(i * 10**9,) for i in range(100)] + [(0,), (None,)], "userId long").repartition(7)
    got = {r.userId: r.n for r in fa.dense_ids(ids, "userId", "n").collect()}
    assert got == {i * 10**9: i for i in range(100)}


def test_a_repeated_run_replaces_itself(spark, planted, tmp_path):
    ratings, movies, tags = planted
    root = str(tmp_path)
    stats = movie_statistics(ratings)
    write_table(movies.join(stats, "movieId", "left").select("movieId", "title", "genres", "avg_rating", "rating_count"), root, "movies")
    write_table(ratings, root, "ratings")
    write_table(tags, root, "tags")
    from datetime import datetime, timezone

    config = TrainingConfig(models=["cbf"], min_average=0.0, min_votes=1, k=5, updated_at=datetime(2024, 6, 1, tzinfo=timezone.utc))
    run_training(spark, root, "one", config)
    tables = [sorted(map(str, read_table(spark, root, t).collect())) for t in ("model_metrics", "recommendations")]
    run_training(spark, root, "one", config)
    assert [sorted(map(str, read_table(spark, root, t).collect())) for t in ("model_metrics", "recommendations")] == tables
    run_training(spark, root, "two", TrainingConfig(models=["cbf"], min_average=0.0, min_votes=1, split="random", train_fraction=0.7))
    assert read_table(spark, root, "model_metrics").count() == 2


def test_candidates_of_few_dimensions_go_in_one_pass(spark, monkeypatch):
    from tastewell.operators import scoring

    sizes = []
    one_pass = scoring.score_pass
    monkeypatch.setattr(scoring, "score_pass", lambda users, block, *rest: sizes.append(len(block)) or one_pass(users, block, *rest))
    rng = np.random.default_rng(11)
    vectors, averages = rng.integers(0, 3, (300, 2)) + 1.0, rng.random(300) * 5
    data = [(m, [7, 400], vectors[m].tolist(), float(np.linalg.norm(vectors[m])), float(averages[m])) for m in range(300)]
    items = spark.createDataFrame(data, "movieId long, idx array<int>, val array<double>, norm double, avg_rating double")
    people = spark.createDataFrame([(u, [7, 9, 400], [u + 1.0, 5.0, 2.0], 9.0) for u in range(6)], "userId long, idx array<int>, val array<double>, norm double")
    history = spark.createDataFrame([(2, m, 1.0, 0) for m in range(0, 300, 2)], RATING)
    got = {(r.userId, r.rank): r.movieId for r in cb.content_top_k(people, items, 4, per_pass=20, history=history).collect()}
    assert sizes == [300]  # two of 512 dimensions are used
    for u in range(6):
        cosines = vectors @ [u + 1.0, 2.0] / 9.0 / np.linalg.norm(vectors, axis=1)
        scores = np.round(0.6 * cosines + averages / 5 * 0.4, 9)
        best = sorted((m for m in range(300) if u != 2 or m % 2), key=lambda m: (-scores[m], m))[:4]
        assert [got[u, i] for i in (1, 2, 3, 4)] == best


def test_blocks_do_not_multiply_the_copies_of_factors():
    # A row's factors are sent to every block it has ratings in, in every round.
    assert [fa.block_count(n) for n in (0, 1000, 29_000_000, 170_000_000, 640_000_000)] == [8, 8, 8, 8, 20]


def test_lines_meet_their_orders_once(spark, monkeypatch, tmp_path):
    from tastewell import fixtures as fx
    from tastewell.plans import queries

    joins, join = [], fx._lines_with_orders
    monkeypatch.setattr(fx, "_lines_with_orders", lambda *a: joins.append(a) or join(*a))
    queries.cbf_topk(spark, "/root/testdata/sf0.001")
    assert len(joins) == 1


def test_a_text_is_taken_apart_once(spark, monkeypatch):
    seen, terms = [], cb._terms
    monkeypatch.setattr(cb, "_terms", lambda df: seen.append(df.count()) or terms(df))
    content = spark.createDataFrame([(m, t) for m in range(40) for t in ("dark dark plot", "funny", "funny", " ")], "movieId long, content string")
    items = cb.item_vectors(content, 64)
    assert seen == [3]
    other = cb.item_vectors(spark.createDataFrame([(m, "dark dark plot funny funny") for m in range(40)], "movieId long, content string"), 64)
    assert [tuple(r) for r in items.orderBy("movieId").collect()] == [tuple(r) for r in other.orderBy("movieId").collect()]


def test_passes_are_no_more_than_the_volume_needs(spark):
    from tastewell.operators.scoring import _in_passes

    movies = spark.range(1200).withColumnRenamed("id", "movieId")
    sizes = [r["count"] for r in _in_passes(movies, 500).groupBy("pass").count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 1200 and max(sizes) <= 500
    tight = [r["count"] for r in _in_passes(movies, 20).groupBy("pass").count().collect()]
    assert sum(tight) == 1200 and max(tight) <= 20


def test_users_whose_list_is_settled_take_no_part_in_later_passes(spark, monkeypatch):
    from tastewell.operators import scoring

    sizes, people_left = [], []
    one_pass = scoring.score_pass
    monkeypatch.setattr(scoring, "score_pass", lambda users, block, *rest: sizes.append(len(block)) or people_left.append(users.count()) or one_pass(users, block, *rest))
    monkeypatch.setattr(fa, "ITEMS_PER_PASS", 300)
    model, people, movies = _planted_factors(spark, 60, 1500, 6)
    # One user has rated all but the shortest vectors and so needs every pass.
    reach = np.argsort(-np.linalg.norm(movies, axis=1))
    history = spark.createDataFrame([(7, int(m), 1.0, 0) for m in reach[:1490]] + [(3, int(reach[0]), 1.0, 0)], RATING)
    got = {}
    for r in fa.als_top_k(model, 10, history=history).orderBy("userId", "rank").collect():
        got.setdefault(r.userId, []).append((r.rank, r.movieId))
    assert sum(sizes) == 1500 and max(sizes) <= 300 and people_left[0] == 60 and people_left[2:] == [1] * (len(sizes) - 2)
    scores = np.round(people @ movies.T, 9)
    seen = {7: set(reach[:1490].tolist()), 3: {int(reach[0])}}
    for u in range(60):
        best = sorted(set(range(1500)) - seen.get(u, set()), key=lambda m: (-scores[u, m], m))[:10]
        assert got[u] == list(enumerate(best, 1))
    sizes.clear()
    assert fa.als_top_k(model, 10).count() == 600 and len(sizes) <= 2


def test_passes_hold_no_more_than_their_volume_where_all_reach_equally_far(spark):
    from tastewell.operators.scoring import _by_reach

    movies = spark.range(1200).select(F.col("id").alias("movieId"), F.lit(1.0).alias("length"), F.lit(0.5).alias("base"))
    sizes = [r["count"] for r in _by_reach(movies, 500).groupBy("pass").count().collect()]
    assert sum(sizes) == 1200 and max(sizes) <= 500
    apart = movies.withColumn("base", F.col("movieId") / 1200)
    ranges = _by_reach(apart, 500).groupBy("pass").agg(F.min("base"), F.max("base")).orderBy("pass").collect()
    assert len(ranges) == 3 and all(a[1] > b[2] for a, b in zip(ranges, ranges[1:]))


def test_thinned_candidates_are_enough_for_users_who_have_rated_some(spark, monkeypatch):
    monkeypatch.setattr(cb, "CANDIDATES_PER_PASS", 100)
    rng = np.random.default_rng(14)
    kinds = [([0], [1.0]), ([1], [2.0]), ([0, 2], [1.0, 1.0]), ([], [])]
    data = []
    for movie in range(600):
        idx, val = kinds[movie % 4]
        data.append((movie, idx, val, float(np.linalg.norm(val)), float(rng.integers(1, 40)) / 8))
    items = spark.createDataFrame(data, "movieId long, idx array<int>, val array<double>, norm double, avg_rating double")
    people = spark.createDataFrame([(u, [0, 1, 2], rng.random(3).tolist(), 1.0) for u in range(9)], "userId long, idx array<int>, val array<double>, norm double")
    vectors = np.zeros((600, 3))
    for movie, idx, val, norm, _ in data:
        vectors[movie, idx] = np.array(val) / (norm or 1)
    base = np.array([d[4] for d in data]) / 5 * 0.4
    scores = {r.userId: np.round(0.6 * (vectors @ np.array(r.val)) + base, 9) for r in people.collect()}
    # The best of each user, some twice in the history; one has rated nothing, one nearly everything.
    many = {u: 25 for u in range(8)} | {0: 0}
    seen = {u: sorted(range(600), key=lambda m: (-scores[u][m], m))[:n] for u, n in many.items()}
    rows = [(u, m) for u, ms in seen.items() for m in ms] + [(5, m) for m in seen[5]] + [(None, 1), (2, 10**6)]
    history = spark.createDataFrame(rows, "userId long, movieId long")
    assert cb.competitive_candidates(items, 3, history).count() < 400
    for rows in (rows, rows + [(8, m) for m in range(5, 600)]):
        history = spark.createDataFrame(rows, "userId long, movieId long")
        got = {(r.userId, r.rank): r.movieId for r in cb.content_top_k(people, items, 3, dimensions=3, history=history).collect()}
        for u in range(9):
            left = {m for v, m in rows if v == u}
            best = sorted(set(range(600)) - left, key=lambda m: (-scores[u][m], m))[:3]
            assert [got[u, i] for i in (1, 2, 3)] == best


def test_a_run_computes_the_digests_of_the_keys_once(spark, rows):
    from tastewell.plans.training import split_ratings

    ratings = spark.createDataFrame([(u, m, 3.0, 0) for u in range(20) for m in range(20)] + [(None, 1, 2.0, 0), (1, None, 2.0, 0)], RATING)
    sides = split_ratings(ratings, TrainingConfig())
    for got, expected in zip(sides, split_by_key(ratings), strict=True):
        assert got.columns == ratings.columns and rows(got) == rows(expected)
        assert "md5" not in got._jdf.queryExecution().optimizedPlan().toString()
