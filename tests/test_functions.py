import random

from hypothesis import given, settings
from hypothesis import strategies as some
from pyspark.sql import functions as F

import numpy as np
import pandas as pd

from tastewell.functions.codec import decode_list, encode_list
from tastewell.functions.display import epoch_date, fixed, rounded, signed, thousands
from tastewell.functions.ranking import numbered, top_per_key
from tastewell.operators.scoring import Candidates, _ordered, best_of


def test_rounding_matches_format_strings(spark):
    values = [i / 1000 for i in range(-300, 5001)] + [i / 8 for i in range(41)]
    df = spark.createDataFrame([(v, f"{v:.2f}", f"{v:+.4f}") for v in values], "v double, two string, four string")
    wrong = df.filter(
        (fixed(F.col("v"), 2) != F.col("two"))
        | (signed(F.col("v"), 4) != F.col("four"))
        | (rounded(F.col("v"), 2) != F.col("two").cast("double"))
    )
    assert wrong.count() == 0


def test_display_edges(spark):
    df = spark.createDataFrame([(1234567, 86400), (None, 0), (0, None)], "n long, ts long")
    got = df.select(thousands(F.col("n")), epoch_date(F.col("ts")).cast("string")).collect()
    assert [tuple(r) for r in got] == [("1,234,567", "1970-01-02"), ("N/A", None), ("0", None)]


def test_codec_clamps_and_skips_malformed(spark):
    df = spark.createDataFrame([([(1, 7.0), (2, -1.0), (3, 3.125)],)], "items array<struct<movieId:bigint,score:double>>")
    text = df.select(encode_list(F.col("items")).alias("t"))
    assert text.first().t == "1:5.00,2:0.00,3:3.12"
    odd = spark.createDataFrame([("1:2.5,2,3:4:5,x:1.0,4:abc,5:1.00",), ("",)], "t string")
    got = [[tuple(i) for i in r[0]] for r in odd.select(decode_list(F.col("t"))).collect()]
    assert got == [[(1, 2.5), (5, 1.0)], []]


def _random_rows(n, seed=3):
    rng = random.Random(seed)
    # One key holds about a third of the rows.
    return [(0 if rng.random() < 0.33 else rng.randrange(1, 40), rng.randrange(50), i) for i in range(n)]


def test_top_per_key_salted_equals_plain(spark, rows):
    df = spark.createDataFrame(_random_rows(4000), "k int, v int, i int").repartition(7)
    order = [F.desc("v"), F.asc("i")]
    plain = rows(top_per_key(df, ["k"], order, 5))
    assert plain == rows(top_per_key(df, ["k"], order, 5, salts=4))
    expected = []
    data = _random_rows(4000)
    for key in {r[0] for r in data}:
        best = sorted((r for r in data if r[0] == key), key=lambda r: (-r[1], r[2]))[:5]
        expected += [(*r, place) for place, r in enumerate(best, 1)]
    assert plain == sorted(expected, key=repr)


def test_top_per_key_trims_before_the_shuffle(spark):
    df = spark.createDataFrame(_random_rows(50), "k int, v int, i int")
    plan = top_per_key(df, ["k"], [F.desc("v"), F.asc("i")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 5, Partial" in plan


def test_numbered_equals_row_number(spark, rows):
    data = _random_rows(3000)
    df = spark.createDataFrame(data, "k int, v int, i int")
    got = rows(numbered(df, ["k"], [(F.col("v"), True), (F.floor(F.col("i") / 100), False)], [F.asc("i")]))
    expected = []
    for key in {r[0] for r in data}:
        ordered = sorted((r for r in data if r[0] == key), key=lambda r: (-r[1], r[2]))
        expected += [(*r, place) for place, r in enumerate(ordered, 1)]
    assert got == sorted(expected, key=repr)


@settings(max_examples=80, deadline=None)
@given(
    some.integers(1, 6), some.integers(1, 40), some.integers(1, 12), some.integers(1, 7), some.integers(0, 2**31), some.booleans()
)
def test_best_of_against_sorting(users, items, k, size, seed, masked):
    rng = np.random.default_rng(seed)
    block = pd.DataFrame(
        {
            "movieId": rng.permutation(2**40 + np.arange(items)), "idx": [[0, 1, 2]] * items, "val": list(rng.integers(-2, 3, (items, 3)).astype(float)),
            "norm": np.ones(items), "base": rng.integers(0, 3, items).astype(float),
        }
    )
    vectors = rng.integers(-2, 3, (users, 3)).astype(float)
    rated = [rng.choice(block["movieId"], rng.integers(0, items + 1), replace=False) for _ in range(users)] if masked else None
    (rows, ids, scores, place), _ = best_of(vectors, rated, Candidates(block, 3, 0.5, size), k)
    expected = []
    for u in range(users):
        left = [i for i in range(items) if rated is None or block["movieId"][i] not in set(rated[u])]
        value = {i: round(0.5 * float(vectors[u] @ block["val"][i]) + block["base"][i], 9) for i in left}
        best = sorted(left, key=lambda i: (-value[i], block["movieId"][i]))[:k]
        expected += [(u, block["movieId"][i], value[i], p) for p, i in enumerate(best)]
    assert list(zip(rows, ids, scores, place)) == expected


def test_bounds_leave_blocks_out():
    rng = np.random.default_rng(1)
    values = rng.random((5000, 4)) * (rng.random((5000, 1)) ** 6 + 0.01)
    block = pd.DataFrame({"movieId": np.arange(5000), "idx": [[0, 1, 2, 3]] * 5000, "val": list(values), "norm": 1.0, "base": 0.0})
    users = rng.random((50, 4))
    (rows, ids, _, _), skipped = best_of(users, None, Candidates(block, 4, 1.0, 100), 10)
    assert skipped >= 25
    scores = np.round(users @ values.T, 9)
    for u in range(50):
        assert list(ids[rows == u]) == sorted(range(5000), key=lambda i: (-scores[u, i], i))[:10]


def test_short_vectors_are_ruled_out_by_their_length():
    rng = np.random.default_rng(12)
    values = np.maximum(rng.normal(0.5, 0.5, (20_000, 10)), 0)
    block = pd.DataFrame({"movieId": np.arange(20_000), "idx": [np.arange(10)] * 20_000, "val": list(values), "norm": 1.0, "base": 0.0})
    users = np.maximum(rng.normal(0.5, 0.5, (2000, 10)), 0)
    candidates = Candidates(block, 10, 1.0)
    (rows, ids, _, _), skipped = best_of(users, None, candidates, 10)
    assert skipped > len(candidates.starts) / 4
    scores = np.round(users[:40] @ values.T, 9)
    for u in range(40):
        assert list(ids[rows == u]) == sorted(range(20_000), key=lambda i: (-scores[u, i], i))[:10]


def test_a_floor_leaves_out_only_what_is_below():
    rng = np.random.default_rng(13)
    values, users = rng.random((3000, 5)), rng.random((30, 5))
    block = pd.DataFrame({"movieId": np.arange(3000), "idx": [np.arange(5)] * 3000, "val": list(values), "norm": 1.0, "base": 0.0})
    scores = np.round(users @ values.T, 9)
    floor = np.where(np.arange(30) % 3 == 0, -np.inf, np.sort(scores, axis=1)[:, -4])
    (rows, ids, found, _), _ = best_of(users, None, Candidates(block, 5, 1.0), 10, floor)
    for u in range(30):
        best = sorted(range(3000), key=lambda i: (-scores[u, i], i))[:10]
        assert list(ids[(rows == u) & (found >= floor[u])]) == [i for i in best if scores[u, i] >= floor[u]]


def test_blocks_use_few_columns_of_sparse_vectors():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 16, 4000)
    block = pd.DataFrame({"movieId": np.arange(4000), "idx": [[w, 16] for w in words], "val": list(rng.random((4000, 2)) + 0.1), "norm": 1.0, "base": rng.random(4000)})
    candidates = Candidates(block, 17, 1.0)
    used = [(candidates.items[s:e] != 0).any(0).sum() for s, e in zip(candidates.starts, candidates.ends)]
    assert np.mean(used[1:]) < 6
    users = rng.random((300, 17))
    (rows, ids, _, _), _ = best_of(users, None, candidates, 10)
    dense = np.zeros((4000, 17))
    np.put_along_axis(dense, np.array(block["idx"].tolist()), np.array(block["val"].tolist()), 1)
    scores = np.round(users @ dense.T + block["base"].to_numpy(), 9)
    for u in range(300):
        assert list(ids[rows == u]) == sorted(range(4000), key=lambda i: (-scores[u, i], i))[:10]


@settings(max_examples=60, deadline=None)
@given(some.integers(0, 2**31), some.sampled_from([1, 40, 2**62]), some.sampled_from([1.0, 1e6]))
def test_order_of_pairs(seed, farthest, largest):
    rng = np.random.default_rng(seed)
    rows, ids = rng.integers(0, 5, 60), rng.integers(-farthest, farthest, 60)
    scores = np.round(rng.choice(rng.normal(size=8) * largest, 60), 9)
    got = _ordered(rows, ids, scores)
    expected = np.lexsort((ids, -scores, rows))
    assert all((x[got] == x[expected]).all() for x in (rows, ids, scores))


def test_written_frames_live_in_the_named_folder(spark, rows):
    from tastewell.session import shared_folder, written

    df = spark.createDataFrame([(1, [1.5]), (2, [])], "a int, b array<double>")
    copy = written(df, "copy")
    assert rows(copy) == rows(df) and copy.schema.simpleString() == df.schema.simpleString()
    assert shared_folder(spark) in copy.inputFiles()[0]
