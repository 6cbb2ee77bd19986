"""Search against all products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastewell.llm import maxscore


def _expected(rows, k, is_query):
    valid = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, qv in {(i, tuple(v)) for i, v in valid if is_query(i)}:
        scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in valid if i != q)
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize(("kind", "shard", "block"), [("dense", 8192, 1 << 20), ("sparse", 40, 300), ("negative", 16, 1 << 20), ("ties", 25, 1 << 20)])
def test_search(spark, monkeypatch, kind, shard, block):
    monkeypatch.setattr(maxscore, "ROWS_PER_SHARD", shard)
    rng = np.random.default_rng(5)
    m = rng.normal(size=(160, 24)).astype(np.float32)
    if kind == "sparse":
        m[rng.random(m.shape) < 0.8] = 0
        m[::9] = 0
    if kind == "negative":
        m = -np.abs(m)
    if kind == "ties":
        m = np.round(m / 2)
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 24), (203, [float("inf")] * 24), (None, [1.0] * 24), (210, []), (220, [0.5] * 10), (3, m[3].tolist())]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, vector int").repartition(3)
    got = maxscore.top_k(df, F.col("vec_id") % 10 == 0, 10, block_bytes=block).collect()
    assert sorted(map(tuple, got)) == sorted(_expected(rows, 10, lambda i: i % 10 == 0))


def test_empty_and_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in maxscore.top_k(df, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert maxscore.top_k(df.limit(0), F.lit(True)).collect() == []
    assert maxscore.top_k(df, F.lit(False)).collect() == []
