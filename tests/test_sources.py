import random

import pytest
from pyspark.sql import functions as F

from tastewell import schemas
from tastewell.plans.statistics_job import load_store
from tastewell.sources import csv_files, result_files, stored_rows
from tastewell.sources.tables import load_dataset, read_table, write_table

MOVIES_CSV = (
    "movieId,title,genres\n"
    '1,"Toys, again",Animation|Comedy\n'
    '2,"The ""Best"" one",Drama,extra\n'
    '3,"Two\nlines",\n'
    "4,short row\n"
    "x,No number,Drama\n"
    "5,,Drama\n"
    '6,"a, b",,extra\n'
    "1,Later title,Drama\n"
)
RATINGS_CSV = (
    "movieId,userId,timestamp,rating\n"
    "10,1,100,4.0\n"
    "10,1,50,2.5\n"
    "11,1,7,bad\n"
    "11,1,7.5,3\n"
    "12,2\n"
    "12,2,9, 3.5\n"
    "13,2,9,nan\n"
    "\n"
)
TAGS_CSV = (
    "userId,movieId,tag,timestamp\n"
    "1,10, spaced ,5\n"
    "1,10,   ,5\n"
    "1,10,fun\n"
    '2,11,"dark, slow",x\n'
    "2,z,odd,1\n"
)


@pytest.fixture
def csvs(tmp_path):
    for name, text in (("movies", MOVIES_CSV), ("ratings", RATINGS_CSV), ("tags", TAGS_CSV)):
        (tmp_path / f"{name}.csv").write_text(text)
    return tmp_path


def test_movies_keep_quotes_and_line_breaks(spark, csvs, rows):
    good, rejects = csv_files.read_movies(spark, f"{csvs}/movies.csv")
    assert rows(good.drop("_position")) == [
        (1, "Later title", "Drama"),
        (1, "Toys, again", "Animation|Comedy"),
        (2, 'The "Best" one', "Drama"),
        (3, "Two\nlines", ""),
        (5, "", "Drama"),
        (6, "a, b", ""),
    ]
    assert rows(rejects.select("reason", "raw")) == [
        ("movieId is not a whole number", "x,No number,Drama"),
        ("too few fields", "4,short row"),
    ]
    last = csv_files.last_written(good, ["movieId"]).filter("movieId = 1")
    assert rows(last) == [(1, "Later title", "Drama")]


def test_ratings_by_header_name_later_line_wins(spark, csvs, rows):
    good, rejects = csv_files.read_ratings(spark, f"{csvs}/ratings.csv")
    latest = csv_files.last_written(good, ["userId", "movieId"])
    assert rows(latest) == [(1, 10, 2.5, 50), (2, 12, 3.5, 9)]
    assert rejects.count() == 4


def test_ratings_without_a_column_fail(spark, tmp_path):
    (tmp_path / "r.csv").write_text("userId,movieId,rating\n1,2,3\n")
    with pytest.raises(ValueError, match="timestamp"):
        csv_files.read_ratings(spark, f"{tmp_path}/r.csv")


def test_ratings_files_with_different_headers_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("userId,movieId,rating,timestamp\n1,2,3,4\n")
    (tmp_path / "b.csv").write_text("movieId,userId,rating,timestamp\n1,2,3,4\n")
    good, _ = csv_files.read_ratings(spark, str(tmp_path))
    with pytest.raises(Exception, match="header"):
        good.collect()


def test_tags_keep_text_and_reject_blanks(spark, csvs, rows):
    good, rejects = csv_files.read_tags(spark, f"{csvs}/tags.csv")
    assert rows(good) == [(1, 10, " spaced ", 5), (2, 11, "dark, slow", 0)]
    assert sorted(r.reason for r in rejects.collect()) == [
        "blank tag",
        "movieId is not a number",
        "too few fields",
    ]


def test_position_orders_many_splits_of_one_file(spark, tmp_path, rows):
    lines = "".join(f"{i % 7},{i % 3},{i % 10 / 2},{i}\n" for i in range(5000))
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        good, _ = csv_files.read_ratings(spark, f"{tmp_path}/r.csv")
        assert good.rdd.getNumPartitions() > 4
        got = rows(csv_files.last_written(good, ["userId", "movieId"]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {(i % 7, i % 3): (i % 10 / 2, i) for i in range(5000)}
    assert got == sorted(((*key, *value) for key, value in expected.items()), key=repr)


def test_wide_ratings_default_time(spark, rows):
    stored = spark.createDataFrame(
        [("1", {"r:5": "4.0", "t:5": "9", "r:6": "2.5", "t:7": "1"}), ("x", {"r:5": "1.0"})],
        "key string, cells map<string,string>",
    )
    assert rows(stored_rows.ratings_from_wide(stored)) == [(1, 5, 4.0, 9), (1, 6, 2.5, 0)]


def test_wide_pages_bound_a_row(spark):
    history = spark.range(2500).select(
        F.lit(1).alias("userId"), F.col("id").cast("int").alias("movieId"),
        F.lit(3.0).alias("rating"), F.lit(1).cast("long").alias("ts"),
    )
    pages = stored_rows.ratings_to_wide(history)
    assert pages.count() == 3
    assert pages.select(F.max(F.size("cells"))).first()[0] == 2000
    assert stored_rows.ratings_from_wide(pages).count() == 2500


def test_tag_layouts(spark, rows):
    stored = spark.createDataFrame(
        [
            ("0000000001", {"info:userId": "1", "info:movieId": "2", "info:tag": "a", "info:timestamp": "3"}),
            ("7_8", {"info:userId": "1", "info:tag": "explicit wins"}),
            ("4_5", {"info:tag": "b"}),
            ("6", {"tag:7": "c", "tag:8": "", "other:9": "no"}),
            ("bad_key", {"info:tag": "d"}),
            ("9", {"info:tag": "no layout"}),
            ("0000000002", {"info:userId": "1", "info:movieId": "2", "info:tag": ""}),
        ],
        "key string, cells map<string,string>",
    )
    assert rows(stored_rows.tags_from_cells(stored)) == [
        (1, 0, "explicit wins", 0),
        (1, 2, "a", 3),
        (4, 5, "b", 0),
        (6, 7, "c", 0),
    ]


def test_movies_defaults(spark, rows):
    stored = spark.createDataFrame(
        [("1", {"info:title": "T"}), ("2", {"stats:avg_rating": "3"}), ("x", {"info:title": "bad"})],
        "key string, cells map<string,string>",
    )
    assert rows(stored_rows.movies_from_cells(stored)) == [(1, "T", ""), (2, "Unknown", "")]


def test_metric_cells_fallback(spark, rows):
    stored = spark.createDataFrame(
        [
            ("als", {"info:rmse": "0.9", "info:mae": "0.7", "info:updated_at": "t1"}),
            ("LATEST_RUN", {"b:rmse": "0.81234", "b:timestamp": "t2", "b:winner_model": "als"}),
            ("bad", {"info:rmse": "oops"}),
            ("empty", {"info:rmse": "", "b:rmse": "5"}),
        ],
        "key string, cells map<string,string>",
    )
    assert rows(stored_rows.metrics_from_cells(stored)) == [
        ("LATEST_RUN", 0.81234, 0.0, "t2"),
        ("als", 0.9, 0.7, "t1"),
        ("empty", 0.0, 0.0, "--"),
    ]
    assert rows(stored_rows.latest_run_from_cells(stored)) == [("ALS", "0.8123", "t2")]


def test_result_files(spark, tmp_path, rows):
    (tmp_path / "part-00000").write_text("1\t4.5\n 2 , 3.0 \nshort\n\nx\t1.0\n3\tbad\n")
    (tmp_path / "_SUCCESS").write_text("ignored\t1\n")
    pairs = result_files.read_pairs(spark, str(tmp_path))
    assert rows(pairs) == [("1", "4.5"), ("2", "3.0"), ("3", "bad"), ("x", "1.0")]
    assert rows(result_files.movie_statistic(pairs, "avg_rating", "double")) == [(1, 4.5), (2, 3.0)]


def test_schema_mismatch_fails(spark, tmp_path):
    wrong = spark.createDataFrame([(1, "a")], "genre int, count string")
    with pytest.raises(schemas.SchemaMismatch, match="genre"):
        write_table(wrong, str(tmp_path), "genre_stats")


def test_store_round_trip_from_csv(spark, csvs, tmp_path, rows):
    root = str(tmp_path / "store")
    rejects = load_store(spark, *[f"{csvs}/{n}.csv" for n in ("movies", "ratings", "tags")], root)
    assert rejects.count() == 9
    ratings, movies, tags = load_dataset(spark, root)
    assert rows(ratings) == [(1, 10, 2.5, 50), (2, 12, 3.5, 9)]
    # Movies 10 and 12 are known from ratings only: stored, but not in the training catalogue.
    assert [r[0] for r in rows(movies)] == [1, 2, 3, 5, 6]
    assert read_table(spark, root, "movies").count() == 7
    assert rows(read_table(spark, root, "system_stats")) == [(2, 6, 3)]
    assert tags.count() == 2


def test_split_reads_agree_whatever_is_selected(spark, tmp_path, rows):
    (tmp_path / "m.csv").write_text('movieId,title,genres\n1,a,Drama\n2,short\n3,long,Drama,x\n4,"two\nlines",Drama\n5,"q, ""r""",\n')
    good, rejects = csv_files.read_movies(spark, f"{tmp_path}/m.csv", multi_line=False)
    assert rows(good.drop("_position")) == [(1, "a", "Drama"), (3, "long", "Drama"), (5, 'q, "r"', "")]
    assert good.count() == 3
    for column in ("movieId", "title", "genres"):
        assert len(good.select(column).collect()) == 3
    assert rows(rejects.select("reason")) == [("too few fields",), ("unbalanced quote",), ("unbalanced quote",)]
    assert rejects.count() == 3 == sum(r["count"] for r in rejects.groupBy("reason").count().collect())
    (tmp_path / "t.csv").write_text('userId,movieId,tag,timestamp\n1,2,a,3\n1,2,\t,3\n1,2\n1,2,"x,3\n')
    good, rejects = csv_files.read_tags(spark, f"{tmp_path}/t.csv", multi_line=False)
    assert good.count() == len(good.collect()) == len(good.select("tag").collect()) == 1
    assert rows(rejects.select("reason")) == [("blank tag",), ("too few fields",), ("unbalanced quote",)]


def test_numbers_and_order_of_files(spark, tmp_path, rows):
    head = "userId,movieId,rating,timestamp\n"
    (tmp_path / "a.csv").write_text(head + "1,1,1.0,5\n1,2,4.5d,5\n1,3,0x1p3,5\n1,4,5e-1,5\n")
    (tmp_path / "b.csv").write_text(head + "1,1,2.0,5\n")
    for order, expected in ((["a.csv", "b.csv"], 2.0), (["b.csv", "a.csv"], 1.0)):
        good, rejects = csv_files.read_ratings(spark, [f"{tmp_path}/{f}" for f in order])
        last = {r.movieId: r.rating for r in csv_files.last_written(good, ["userId", "movieId"]).collect()}
        assert last == {1: expected, 4: 0.5} and rejects.count() == 2


def test_line_counts(spark, tmp_path, rows):
    (tmp_path / "r.csv").write_text("userId,movieId,rating,timestamp\n1,7,4.0,1\n1,7,bad,1\n2,8\n\nshort\n")
    assert rows(csv_files.line_counts(spark, f"{tmp_path}/r.csv")) == [("7", 2), ("8", 1)]


def test_a_cluster_needs_a_shared_folder(spark):
    from types import SimpleNamespace

    from tastewell import session

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="checkpoint"):
        session.shared_folder(far)
    assert session.is_local("local[4]") and not session.is_local("local-cluster[2,1,1024]")


@pytest.mark.parametrize("size", ["128m", "700"])
def test_split_files_with_line_breaks_equal_whole_ones(spark, rows, tmp_path, size):
    rng = random.Random(2)

    def field():
        text = "".join(rng.choice('ab, é\n"') for _ in range(rng.randint(0, 14)))
        if rng.random() < 0.6:
            return '"' + text.replace('"', '""') + '"'
        return "".join(rng.choice("ab é") for _ in range(rng.randint(0, 9))) + ("" if rng.random() < 0.9 else '5" x')

    for f in range(3):
        lines = ["movieId,title,genres"]
        for i in range(400):
            parts = [str(f * 10000 + i) if rng.random() < 0.9 else rng.choice(["x", "", "4.0", "3000000000"]), field(), field()]
            lines.append(",".join(parts[:2] if rng.random() < 0.05 else [*parts, "extra"] if rng.random() < 0.05 else parts))
        (tmp_path / f"{f}.csv").write_bytes(("\n".join(lines) + ("\n" if f else "")).encode())
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        whole, whole_rejects = csv_files.read_movies(spark, str(tmp_path), multi_line=True)
        split, split_rejects = csv_files.read_movies(spark, str(tmp_path))
        columns = ["movieId", "title", "genres"]
        assert rows(split.select(*columns)) == rows(whole.select(*columns))
        assert rows(split_rejects) == rows(whole_rejects)
        assert rows(csv_files.last_written(split, ["movieId"])) == rows(csv_files.last_written(whole, ["movieId"]))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_a_quote_state_of_lines():
    from tastewell.sources.quoted_lines import INSIDE, OUTSIDE, state_after

    cases = [('1,"a', OUTSIDE, INSIDE), ('b",c', INSIDE, OUTSIDE), ('b"",c', INSIDE, INSIDE), ('1,5" x,y', OUTSIDE, OUTSIDE), ('"a","b', OUTSIDE, INSIDE), ('a",""', INSIDE, OUTSIDE), ("", INSIDE, INSIDE)]
    for line, before, after in cases:
        assert state_after(line, before) == after, line


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "m.csv").write_text("movieId,title,genres\n")
    (tmp_path / "n.csv").write_text("")
    good, rejects = csv_files.read_movies(spark, str(tmp_path))
    assert good.count() == rejects.count() == 0
