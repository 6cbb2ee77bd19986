"""Exact top-k search with MaxScore over vectors whose components are scaled to whole numbers.

A component is a term, and a vector's value in it its posting. For every query the terms of a shard are
ordered by the most they can add. Terms whose bounds together stay below the query's k-th best score are
non-essential: what stands in none of the others cannot enter. The postings of the essential terms are
traversed; what can still reach the k-th best is probed in the remaining terms, as long as it can.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 1024
ROWS_PER_SHARD = 8192
QUERY_BLOCK_BYTES = 32 << 20
PROBES = 8  # terms probed between two looks at the bounds
FOUND_SCHEMA = "query_id bigint, vec_id bigint, score bigint"


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component; null for vectors that hold a null or non-finite one."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of the lists, shorter ones filled with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


class Shard:
    """Postings of some vectors, term by term, with the least and largest value of each."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, rows = ids[order], rows[order]
        self.n, self.terms = rows.shape
        self.columns = np.ascontiguousarray(rows.T)
        self.postings = [np.flatnonzero(c) for c in self.columns]
        if self.n:
            self.low, self.high = self.columns.min(1, initial=0, where=self.columns != 0), self.columns.max(1, initial=0, where=self.columns != 0)
            full = np.array([len(p) == self.n for p in self.postings], bool)
            # Without an absent vector the bound is that of the values alone.
            self.low[full], self.high[full] = self.columns[full].min(1), self.columns[full].max(1)

    def search(self, query_id: int, query: np.ndarray, k: int, floor: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all that may be among the k best: at least ``floor``, and the shard's own k best."""
        width = min(len(query), self.terms)
        query = query[:width]
        bound = np.maximum(query * self.low[:width], query * self.high[:width])
        order = np.argsort(-bound, kind="stable")
        order = order[query[order] != 0]
        rest = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0]])
        score = np.zeros(self.n, np.int64)
        own = self.ids == query_id
        if floor is None:
            essential, live = len(order), np.flatnonzero(~own)
        else:
            below = np.flatnonzero(rest < floor)
            essential = int(below[0]) if len(below) else len(order)
            live = None
        touched = np.zeros(self.n, bool)
        for t in order[:essential]:
            where = self.postings[t]
            if len(where) == self.n:
                score += query[t] * self.columns[t]
                touched[:] = True
            else:
                score[where] += query[t] * self.columns[t][where]
                touched[where] = True
        if live is None:
            # With a floor that nothing at all already reaches, vectors without any term count too.
            live = np.flatnonzero((touched | (rest[essential] >= floor)) & ~own & (score + rest[essential] >= floor))
        for start in range(essential, len(order), PROBES):
            for t in order[start : start + PROBES]:
                score[live] += query[t] * self.columns[t][live]
            live = live[score[live] + rest[min(start + PROBES, len(order))] >= floor]
        best = live[np.lexsort((self.ids[live], -score[live]))[:k]]
        return self.ids[best], score[best]


def _search(shared, k: int, rows_per_shard: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shared.value
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(query_ids)

        def take(ids: list, rows: list) -> None:
            width = max(r.shape[1] for r in rows)
            shard = Shard(np.concatenate(ids), np.concatenate([np.pad(r, ((0, 0), (0, width - r.shape[1]))) for r in rows]))
            for i, query_id in enumerate(query_ids):
                held_ids, held = best[i]
                found_ids, found = shard.search(query_id, queries[i], k, int(held[-1]) if len(held) == k else None)
                held_ids, held = np.concatenate([held_ids, found_ids]), np.concatenate([held, found])
                order = np.lexsort((held_ids, -held))[:k]
                best[i] = held_ids[order], held[order]

        ids, rows, size = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, rows_per_shard):
                part = batch.slice(start, rows_per_shard)
                ids.append(part.column(0).to_numpy(zero_copy_only=False))
                rows.append(_matrix(part.column(1)))
                size += part.num_rows
                if size >= rows_per_shard:
                    take(ids, rows)
                    ids, rows, size = [], [], 0
        if size:
            take(ids, rows)
        for i, query_id in enumerate(query_ids):
            if len(best[i][0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(best[i][0]), query_id, np.int64)), pa.array(best[i][0]), pa.array(best[i][1])],
                    names=["query_id", "vec_id", "score"],
                )

    return search


def top_k(
    vectors: DataFrame, queries: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding", block_bytes: int = QUERY_BLOCK_BYTES
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows of highest inner product for every query row.

    ``queries`` marks the query rows; candidates are all rows with another id. Ties go to the smaller id.
    Rows with a null id, a null vector, or one holding null or non-finite components take no part. Shorter
    vectors count as filled with zeros; repeated rows are candidates each, and queries once. Queries are
    sent to the shards in blocks of bounded size; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), scaled(F.col(vector_column)).alias("vector"), queries.alias("asked"))
    rows = written(rows.filter("vec_id IS NOT NULL AND vector IS NOT NULL"), "vectors")
    asked = rows.filter("asked").dropDuplicates(["vec_id", "vector"])
    size = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    blocks = max(1, -(-int(size[0]) * max(1, int(size[1] or 0)) * 8 // block_bytes))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    asked = written(asked.select("vec_id", "vector", block.alias("block")), "queries")
    found = None
    for number in range(blocks):
        # One block of queries, bounded by block_bytes, is held by the driver and every executor at a time.
        held = asked.filter(F.col("block") == number).select("vec_id", "vector").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        lists = held.column(1).chunk(0) if held.column(1).num_chunks else pa.array([], pa.list_(pa.int64()))
        shared = spark.sparkContext.broadcast((held.column(0).to_numpy(), _matrix(lists)))
        hits = written(rows.select("vec_id", "vector").mapInArrow(_search(shared, k, ROWS_PER_SHARD), FOUND_SCHEMA), "hits")
        shared.unpersist()
        found = hits if found is None else found.union(hits)
    if found is None:
        found = spark.createDataFrame([], FOUND_SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
