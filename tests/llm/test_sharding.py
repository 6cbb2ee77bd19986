"""Shards against the smallest capacity found by trying."""

import random
import zlib

import pytest

from tastewell.llm import sharding


def _needs(sizes, capacity):
    shards, used = 1, 0
    for s in sizes:
        if used + s > capacity:
            shards, used = shards + 1, 0
        used += s
    return shards


@pytest.mark.parametrize(("seed", "cells"), [(0, 1 << 16), (1, 16), (2, 16), (3, 64)])
def test_shards(spark, monkeypatch, seed, cells):
    monkeypatch.setattr(sharding, "CELLS", cells)
    rng = random.Random(seed)
    texts = ["x" * rng.randint(0, 60) + str(rng.randint(0, 40)) for _ in range(150)] + [None, "", None, "ü€"]
    texts += ["copy of a long text " * 3] * (60 if seed == 3 else 5)
    rows = [(i if i % 20 else None, t, "s") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(4)
    got = sharding.shard_rows(docs).collect()
    assert len(got) == len(texts)
    crc = sorted(zlib.crc32((t or "").encode()) for t in texts)
    assert sorted(r["text_crc32"] for r in got) == crc
    shards = {}
    for r in got:
        shards.setdefault(r["shard"], []).append(r)
    for rows_of in shards.values():
        assert sorted(r["slot"] for r in rows_of) == list(range(len(rows_of)))
    homes = {}
    for r in got:
        homes.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    # Groups in the order of the slots give the sizes that were packed.
    order = sorted(got, key=lambda r: (r["shard"], r["slot"]))
    sizes, last = [], None
    for r in order:
        key = (r["text_crc32"], r["size"])
        if key == last:
            sizes[-1] += r["size"]
        else:
            sizes.append(r["size"])
        last = key
    least = next(c for c in range(max(sizes), sum(sizes) + 1) if _needs(sizes, c) <= 8)
    loads = [sum(r["size"] for r in rows_of) for rows_of in shards.values()]
    assert max(loads) == least or max(loads) <= least
    assert set(shards) <= set(range(8))


def test_empty_table(spark):
    assert sharding.shard_rows(spark.createDataFrame([], "doc_id long, text string")).collect() == []
