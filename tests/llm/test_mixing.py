"""Targets by hand, shares near them, equal reruns."""

import pytest
from pyspark.sql import functions as F

from tastewell.llm import mixing


def _targets(sizes, weights, repeats):
    """Sharing the excess by weight until no target is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    limit = {s: repeats * sizes[s] for s in names}
    target, total = {}, sum(sizes.values())
    open_ = set(names)
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        full = {s for s in open_ if share[s] >= limit[s]}
        if not full:
            return target | share
        target |= {s: float(limit[s]) for s in full}
        open_ -= full
    return target


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 10, "b": 1000, "c": 1000, "d": 5, None: 3},
        {"a": 1, "b": 1, "c": 1, "d": 5000},
        {"a": 0, "b": 0, None: 7},
        {"only": 12},
        {"a": 0},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    expected = _targets(sizes, mixing.WEIGHTS, mixing.REPEATS)
    assert got == pytest.approx(expected)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


ROWS = [(i, "w " * (1 + i % 7), "abc"[i % 3] if i % 11 else None) for i in range(300)]
ROWS += [(500, None, "a"), (501, "", "b"), (502, " \n\t", None), (503, "w " * 400, "c"), (7, "w " * (1 + 7 % 7), "b"), (None, "one two", "a"), (None, "one two", "a"), (None, None, None)]


def test_shares_come_near_their_targets(spark):
    docs = spark.createDataFrame([(*r, 1, "k") for r in ROWS], "doc_id long, text string, source string, size int, mark string")
    one, queue = mixing.mix(docs.repartition(5))
    rows = one.collect()
    assert len(rows) == len(ROWS)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").split()) for _, t, _ in ROWS)
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    for rows_of in by_source.values():
        assert rows_of[0]["source_size"] == sum(r["size"] for r in rows_of)
        assert abs(sum(r["taken"] for r in rows_of) - rows_of[0]["target"]) <= max(r["size"] for r in rows_of) * 2 + 1
    assert sum(r["taken"] for r in rows) == sum(r["size"] for r in rows)
    finish = [r["finish"] for r in queue.orderBy("finish").collect()]
    assert finish == sorted(finish) and len(finish) > 100
    again, _ = mixing.mix(docs.repartition(2))
    assert sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_mixed_repeats_documents(spark):
    docs = spark.createDataFrame([(*r, "x") for r in ROWS], "doc_id long, text string, source string, finish string")
    counts = {}
    for r in mixing.mixed(docs).collect():
        counts[r["doc_id"], r["text"]] = counts.get((r["doc_id"], r["text"]), 0) + 1
    one, _ = mixing.mix(docs)
    expected = {}
    for r in one.filter("taken > 0").join(docs.select(F.col("doc_id").alias("id"), "text").distinct(), "id").collect():
        expected[r["id"], r["text"]] = expected.get((r["id"], r["text"]), 0) + -(-r["taken"] // r["size"])
    expected = {k: v for k, v in expected.items() if len(k[1].split())}
    known = {k: v for k, v in counts.items() if k[0] not in (None, 7)}
    assert known == {k: v for k, v in expected.items() if k[0] not in (None, 7)}
    assert mixing.mixed(docs.limit(0)).collect() == []


def test_running_sums(spark):
    rows = [("a" if i % 3 else None, i % 4, i, 1) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, part int, o int, v long")
    got = {r["o"]: r["s"] for r in mixing.running(df, ["k"], "part", ["o"], {"v": "s"}).collect()}
    for key in ("a", None):
        ordered = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2]))
        assert [got[r[2]] for r in ordered] == list(range(1, len(ordered) + 1))
