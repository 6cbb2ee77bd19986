"""Hard negatives against all pairs, with ties, repeats, odd rows and blocks of every size."""

import random

import pytest
from pyspark.sql import functions as F

from tastewell.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, anchor long, score long"


def _whole(vector, scale=256):
    import math

    if vector is None or any(x is None or not math.isfinite(x) for x in vector):
        return None
    return [math.floor(scale * x) for x in vector]


def _brute(rows, positives=5, negatives=3):
    usable = [(i, _whole(v), y) for i, v, y in rows if i is not None and y is not None and _whole(v) is not None]
    out = []
    for i, v, y in sorted({(i, tuple(v), y) for i, v, y in usable if i % 50 == 0}):
        def best(candidates):
            scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j) for j, w, _ in candidates if j != i]
            return sorted(scored, key=lambda s: (-s[0], s[1]))

        others = best(r for r in usable if r[2] != y)
        for p, j in best(r for r in usable if r[2] == y)[:positives]:
            fit = [(s, k) for s, k in others if 50 * p <= 100 * s <= 95 * p][:negatives]
            out += [(i, j, rank + 1, k, p, s) for rank, (s, k) in enumerate(fit)]
    return sorted(out)


def _rows(seed, n=400):
    rng = random.Random(seed)
    # Few different values: many ties; one label holds a third of the rows.
    return [(i, [rng.choice([-0.5, -0.1, 0.0, 0.3, 0.5, 0.7]) + 0.5 for _ in range(6)], rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6])) for i in range(n)]


@pytest.mark.parametrize("block_bytes", [1 << 20, 2000])
def test_against_all_pairs(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(hn, "TILE_CELLS", 1 << 8)
    rows = _rows(1)
    nan, far = float("nan"), float("inf")
    rows += [(None, [1.0] * 6, 0), (1001, None, 0), (1002, [1.0, None, 1.0, 1.0, 1.0, 1.0], 0), (1050, [nan] * 6, 1), (1100, [far] * 6, 1), (1150, [1.0] * 6, None)]
    rows += rows[:3] + [rows[50]] + [(1200, [0.25] * 4, 2), (1250, [-1.0] * 6, 3), (1300, [], 4)]
    df = spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA).repartition(5)
    found = hn.hard_negatives(df, F.col("vec_id") % 50 == 0, block_bytes=block_bytes)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got, want = sorted(tuple(r) for r in found.collect()), _brute(rows)
    # Rows repeated with one id share their places: any of them may be the one that is numbered first.
    assert got == want
    assert len(got) > 50


def test_nothing_to_do(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert hn.hard_negatives(df, F.col("vec_id") % 50 == 0).collect() == []
    alone = spark.createDataFrame([(0, [1.0], 1, 0, 0), (7, [1.0], 2, 0, 0)], SCHEMA)
    assert hn.hard_negatives(alone, F.col("vec_id") % 50 == 0).collect() == []


def test_large_numbers_stay_exact(spark):
    big = float(2**21)
    rows = [(0, [big, 1.0], 0), (1, [big, 0.5], 0), (2, [1_900_000.0, 0.5], 1), (3, [1e30, 0.0], 1)]
    found = hn.hard_negatives(spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA), F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == _brute(rows[:3])
    assert found.count() == 1


def test_windows_and_widths(spark):
    rows = _rows(5, 150)
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], SCHEMA)
    got = hn.hard_negatives(df, F.col("vec_id") % 50 == 0, positives=2, negatives=1)
    assert sorted(tuple(r) for r in got.collect()) == _brute(rows, 2, 1)
