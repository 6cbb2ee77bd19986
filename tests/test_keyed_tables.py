"""Merging loads: last write over all of them, untouched files, versions, and statistics that move along."""

import random

import pytest
from pyspark.sql import functions as F

from tastewell import schemas
from tastewell.operators import maintained as mt
from tastewell.operators import statistics as st
from tastewell.plans.statistics_job import load_store, merge_into_store, merge_ratings
from tastewell.sources import keyed_tables as kt
from tastewell.sources.tables import merge_table, read_table, table_exists, write_table

RATING = "userId long, movieId long, rating double, ts long"


def _frame(spark, held):
    return spark.createDataFrame([(*k, *v) for k, v in held.items()], RATING)


def _stored(spark, root):
    return {(r.userId, r.movieId): (r.rating, r.ts) for r in read_table(spark, root, "ratings").collect()}


def test_loads_equal_last_write(spark, tmp_path):
    rng = random.Random(3)
    root, held = str(tmp_path), {}
    for load in range(5):
        low = rng.choice([-5, 0, 40])
        rows = {(rng.randint(low, low + 60), 2**40 + rng.randint(0, 30)): (rng.randint(1, 10) / 2, load) for _ in range(300)}
        changes = merge_table(_frame(spark, rows), root, "ratings", rows_per_unit=70)
        got = {(r.userId, r.movieId): (r.old and tuple(r.old), tuple(r.new)) for r in changes.collect()}
        assert got == {k: (held.get(k), v) for k, v in rows.items()}
        held |= rows
        assert _stored(spark, root) == held
    path = f"{root}/ratings"
    found = kt.units(spark, path)
    assert len(found) > 5 and sum(u.rows for u in found) == len(held)
    lows = [u.low for u in found]
    assert lows == sorted(lows) and max(u.rows for u in found) < 300
    for unit, after in zip(found, [*lows[1:], [2**62, 0]], strict=True):
        inside = [[r.userId, r.movieId] for r in spark.read.parquet(f"{path}/{unit.path}").collect()]
        assert all(unit.low <= key < after for key in inside)


def test_untouched_units_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    merge_table(_frame(spark, {(u, m): (1.0, 0) for u in range(100) for m in range(5)}), root, "ratings", rows_per_unit=50)
    path = f"{root}/ratings"
    before = kt.units(spark, path)
    merge_table(_frame(spark, {(before[3].low[0], before[3].low[1]): (5.0, 1), (10**6, 1): (2.0, 1)}), root, "ratings", rows_per_unit=50)
    after = kt.units(spark, path)
    kept = {u.path for u in before} & {u.path for u in after}
    assert {u.path for u in before} - kept == {before[3].path, before[-1].path}
    # Readers of the earlier version still find it; a vacuum ends that.
    assert kt.read_keyed(spark, path, schemas.RATINGS, 1).filter("rating = 5.0").count() == 0
    assert kt.vacuum(spark, path) == 2
    assert read_table(spark, root, "ratings").count() == 501
    assert kt.vacuum(spark, path) == 0


def test_a_load_of_nothing_and_a_lost_race(spark, tmp_path):
    root = str(tmp_path)
    empty = _frame(spark, {})
    assert merge_table(empty, root, "ratings").count() == 0
    assert not table_exists(spark, root, "ratings")
    merge_table(_frame(spark, {(1, 1): (1.0, 0)}), root, "ratings")
    merge_table(empty, root, "ratings")
    path = f"{root}/ratings"
    assert kt.version(spark, path) == 1
    with pytest.raises(kt.ChangedMeanwhile):
        kt._switch(spark, path, 1, [])
    assert _stored(spark, root) == {(1, 1): (1.0, 0)}


def test_a_whole_table_is_taken_over(spark, tmp_path):
    root = str(tmp_path)
    write_table(_frame(spark, {(u, 1): (1.0, 0) for u in range(30)}), root, "ratings")
    merge_ratings(_frame(spark, {(3, 1): (4.0, 1), (99, 1): (2.0, 1)}), root, rows_per_unit=10)
    assert len(_stored(spark, root)) == 31
    counts = {r.rating: r.n for r in read_table(spark, root, "rating_counts").collect()}
    assert counts == {1.0: 29, 4.0: 1, 2.0: 1}
    merge_ratings(_frame(spark, {(4, 1): (4.0, 2)}), root, rows_per_unit=10)
    assert {r.rating: r.n for r in read_table(spark, root, "rating_counts").collect()} == {1.0: 28, 4.0: 2, 2.0: 1}


def test_statistics_after_loads_equal_a_recount(spark, rows, tmp_path):
    rng = random.Random(8)
    root = str(tmp_path)
    for load in range(4):
        merge_ratings(_frame(spark, {(rng.randint(-40, 40), rng.randint(0, 9)): (rng.randint(1, 10) / 2, load) for _ in range(120)}), root, 50)
    ratings, counts = read_table(spark, root, "ratings"), read_table(spark, root, "rating_counts")
    assert rows(mt.statistics_of(counts)) == rows(st.movie_statistics(ratings))
    assert rows(mt.histogram_of(counts)) == rows(st.rating_histogram(ratings))
    assert counts.filter("n <= 0").count() == 0
    assert mt.bit_count(read_table(spark, root, "user_bits")).first().n == ratings.select("userId").distinct().count()


def test_bits_of_any_ids(spark):
    ids = [0, 1, -1, 32768, 32769, -32768, 2**62, -(2**62), 5, 5, None]
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    assert mt.bit_count(mt.id_bits(df, "id")).first().n == len(set(ids)) - 1
    assert mt.bit_count(mt.id_bits(df.limit(0), "id")).first().n == 0


def _files(folder, name, movies, ratings, tags):
    paths = []
    for kind, head, lines in (("movies", "movieId,title,genres", movies), ("ratings", "userId,movieId,rating,timestamp", ratings), ("tags", "userId,movieId,tag,timestamp", tags)):
        path = folder / f"{name}-{kind}.csv"
        path.write_text("\n".join([head, *lines]) + "\n")
        paths.append(str(path))
    return paths


@pytest.mark.parametrize("first", [load_store, merge_into_store])
def test_files_are_merged_into_a_store(spark, rows, tmp_path, first):
    root = str(tmp_path / "store")
    first(spark, *_files(tmp_path, "a", ["1,One,Drama", "2,Two,War|Drama"], ["1,1,4.0,10", "2,1,3.0,11", "3000000000,2,5.0,12"], ["1,1,fun,5"]), root)
    rejects = merge_into_store(spark, *_files(tmp_path, "b", ["2,Two again,War", "3,Three,Comedy"], ["1,1,2.0,20", "4,3,1.0,21", "x,1,1,1"], ["2,1,dull,6"]), root)
    assert rejects.count() == 1
    assert rows(read_table(spark, root, "ratings").select("userId", "movieId", "rating")) == sorted(
        [(1, 1, 2.0), (2, 1, 3.0), (3000000000, 2, 5.0), (4, 3, 1.0)], key=repr
    )
    movies = {r.movieId: (r.title, r.avg_rating, r.rating_count) for r in read_table(spark, root, "movies").collect()}
    assert movies == {1: ("One", 2.5, 2), 2: ("Two again", 5.0, 1), 3: ("Three", 1.0, 1)}
    assert read_table(spark, root, "tags").count() == 2
    assert rows(read_table(spark, root, "system_stats")) == [(4, 3, 4)]
    assert {r.genre: r["count"] for r in read_table(spark, root, "genre_stats").collect()} == {"Drama": 1, "War": 1, "Comedy": 1}


def test_small_units_need_few_tasks(spark, tmp_path):
    rows = spark.range(5000).selectExpr("id div 50 AS userId", "id % 50 AS movieId", "1.0D AS rating", "id AS ts")
    found = kt._written_units(rows, f"{tmp_path}/t", ["userId", "movieId"], 5000, 100, [])
    assert [(low, n) for _, low, n, _ in found] == [([u, 0], 100) for u in range(0, 100, 2)]
    # All fifty were written by one task.
    assert {int(path.rpartition("=")[2]) >> 33 for *_, path in found} == {0}
