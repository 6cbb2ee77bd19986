"""Hard negatives: rows of another label whose score lies in a window below that of an anchor's positives.

The upper limits of an anchor's positives, from high to low, cut the scores into disjoint slots: a slot reaches
from one limit down to the next. Whatever the positives, a row belongs to one slot, and no answer needs more than the
``k`` best of a slot. So a task keeps the ``k`` best of each anchor and slot, the tasks' lists are cut once more, and
a positive's window, which begins at its own limit, is answered from the suffix of the slots at and below it,
cut at the window's lower end. The overlapping windows cost one pass together.

Scores are whole numbers, so they are the same in any order of summation. Anchors go to the rows in blocks of
bounded size; rows stay where they are, and a product is made tile by tile.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCALE = 256
LEAST, MOST = 50, 95  # percent of the positive's score
BLOCK_BYTES = 16 << 20  # of anchor vectors
TILE_CELLS = 1 << 21  # scores held at a time
EXACT = 1 << 53  # below it, sums of products are exact as doubles
FOUND_SCHEMA = "anchor bigint, slot int, vec_id bigint, score bigint"
NOTHING = np.iinfo(np.int64).min


def whole_vector(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component; null for vectors with a null or non-finite component.

    Null as well if products of such components could leave 64 bits: with n components, beyond 2^31 / sqrt(n).
    """
    values = F.transform(vector, lambda x: F.lit(float(scale)) * x.cast("double"))
    limit = F.lit(2.0**31) / F.sqrt(F.greatest(F.size(vector), F.lit(1)).cast("double"))
    fit = F.forall(values, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < limit), F.lit(False)))
    return F.when(fit, F.transform(values, lambda x: F.floor(x).cast("long")))


def _rows(lists: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, shorter ones filled with zeros."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), max(width, int(sizes.max(initial=0)))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products, as doubles where these hold them."""
    width = min(left.shape[1], right.shape[1])
    left, right = left[:, :width], right[:, :width]
    most = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0)) * width
    if most < EXACT:
        return (left.astype(np.float64) @ right.T.astype(np.float64)).astype(np.int64)
    return left @ right.T


class _Best:
    """The ``k`` highest scores of every anchor and slot so far, ties to the smaller id."""

    def __init__(self, anchors: int, slots: int, k: int):
        self.slots, self.k = slots, k
        self.floor = np.full(anchors * slots, NOTHING)
        self.held = [np.zeros(0, np.int64)] * 3

    def add(self, cell: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        """``cell`` is anchor * slots + slot."""
        enough = score >= self.floor[cell]
        if not enough.any():
            return
        cell, ids, score = (np.concatenate([h, x[enough]]) for h, x in zip(self.held, (cell, ids, score), strict=True))
        order = np.lexsort((ids, -score, cell))
        cell, ids, score = cell[order], ids[order], score[order]
        place = np.arange(len(cell)) - np.searchsorted(cell, cell)
        full = place == self.k - 1
        self.floor[cell[full]] = score[full]
        kept = place < self.k
        self.held = [cell[kept], ids[kept], score[kept]]

    def batch(self, anchors: np.ndarray) -> pa.RecordBatch:
        cell, ids, score = self.held
        columns = [pa.array(anchors[cell // self.slots]), pa.array((cell % self.slots).astype(np.int32)), pa.array(ids), pa.array(score)]
        return pa.RecordBatch.from_arrays(columns, names=["anchor", "slot", "vec_id", "score"])


def _tiles(batches: Iterator[pa.RecordBatch], width: int, anchors: int):
    """(ids, labels, vectors) of so many rows that their scores with all anchors are a bounded number."""
    step = max(1, TILE_CELLS // max(1, anchors))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part.column(0).to_numpy(), part.column(1).to_numpy(), _rows(part.column(2), width)


def _positives(shared, k: int):
    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best other rows of each anchor's own label."""
        anchors, ids, labels, vectors = shared.value[:4]
        best = _Best(len(anchors), 1, k)
        kinds = {label: np.flatnonzero(labels == label) for label in np.unique(labels).tolist()}
        for row_ids, row_labels, rows in _tiles(batches, vectors.shape[1], len(anchors)):
            for label in np.unique(row_labels).tolist():
                mine, theirs = kinds.get(label), np.flatnonzero(row_labels == label)
                if mine is None:
                    continue
                score = _scores(vectors[mine], rows[theirs])
                fit = (score >= best.floor[mine][:, None]) & (ids[mine][:, None] != row_ids[theirs][None, :])
                a, r = np.nonzero(fit)
                best.add(mine[a], row_ids[theirs][r], score[a, r])
        yield best.batch(anchors)

    return positives


def _negatives(shared, k: int):
    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The best rows of other labels in every slot of each anchor."""
        anchors, _, labels, vectors, upper, lowest = shared.value
        slots = upper.shape[1]
        best = _Best(len(anchors), slots, k)
        for row_ids, row_labels, rows in _tiles(batches, vectors.shape[1], len(anchors)):
            score = _scores(vectors, rows)
            a, r = np.nonzero((score <= upper[:, :1]) & (score >= lowest[:, None]) & (labels[:, None] != row_labels[None, :]))
            found = score[a, r]
            # The slot is the last limit that the score does not pass; limits descend.
            slot = (found[:, None] <= upper[a]).sum(1) - 1
            best.add(a * slots + slot, row_ids[r], found)
        yield best.batch(anchors)

    return negatives


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    least: int = LEAST,
    most: int = MOST,
    scale: int = SCALE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor row and positive.

    ``anchors`` marks the anchor rows. The score is the inner product of the vectors, each component being
    floor(scale * x). An anchor's positives are its ``positives`` best rows of its label with another id, its
    negatives for a positive the ``negatives`` best rows of other labels whose score lies between ``least`` and ``most``
    percent of the positive's; all, where there are fewer. Ties go to the smaller id. Rows with a null id, label,
    vector or component, a non-finite component or one beyond 64-bit sums take no part. Shorter vectors count
    as filled with zeros. Repeated rows are candidates each and anchors once; other columns are ignored,
    whatever their names. Positives of negative score have no window.
    """
    spark = vectors.sparkSession
    columns = [F.col(f"`{id_column}`").cast("long").alias("vec_id"), F.col(f"`{label_column}`").cast("long").alias("label")]
    rows = vectors.select(*columns, whole_vector(F.col(f"`{vector_column}`"), scale).alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asked"))
    rows = written(rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL"), "vectors")
    asked = rows.filter("asked").select("vec_id", "label", "vector").distinct()
    size = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    # An anchor also has a list of each kind in every task: some 32 bytes an entry.
    per_anchor = max(1, int(size[1] or 0)) * 8 + 32 * positives * (negatives + 1)
    blocks = max(1, -(-int(size[0]) * per_anchor // block_bytes))
    asked = asked.withColumn("anchor", F.monotonically_increasing_id()).withColumn("block", F.pmod(F.xxhash64("vec_id", "label"), F.lit(blocks)))
    asked = written(asked, "anchors")
    searched = rows.select("vec_id", "label", "vector")
    # The window's ends by hundreds and the rest, so that no product leaves 64 bits.
    low = F.expr(f"score div 100 * {least} + (score % 100 * {least} + 99) div 100")
    high = F.expr(f"score div 100 * {most} + score % 100 * {most} div 100")
    above, below = [], []
    for number in range(blocks):
        # One block of anchors, bounded by block_bytes, is held by the driver and every executor at a time.
        held = asked.filter(F.col("block") == number).select("anchor", "vec_id", "label", "vector").toArrow().combine_chunks()
        if not held.num_rows:
            continue
        lists = held.column(3).combine_chunks()
        block = [held.column(i).to_numpy() for i in range(3)] + [_rows(lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists, 1)]
        shared = spark.sparkContext.broadcast(tuple(block))
        best = _top(searched.mapInArrow(_positives(shared, positives), FOUND_SCHEMA), positives).filter("score >= 0")
        best = written(best.select("anchor", "vec_id", "score", "place", low.alias("low"), high.alias("high")), "positives")
        shared.unpersist()
        above.append(best)
        limits = best.select("anchor", "place", "low", "high").toArrow().combine_chunks()  # a few for each anchor of the block
        upper = np.full((len(block[0]), positives), NOTHING)
        lowest = np.full(len(block[0]), np.iinfo(np.int64).max)
        if limits.num_rows:
            order = np.argsort(block[0])
            mine = order[np.searchsorted(block[0], limits.column(0).to_numpy(), sorter=order)]
            upper[mine, limits.column(1).to_numpy() - 1] = limits.column(3).to_numpy()
            np.minimum.at(lowest, mine, limits.column(2).to_numpy())
        shared = spark.sparkContext.broadcast((*block, upper, lowest))
        below.append(written(searched.mapInArrow(_negatives(shared, negatives), FOUND_SCHEMA), "negatives"))
        shared.unpersist()
    if not above:
        out = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
        return spark.createDataFrame([], out)
    ids = asked.select("anchor", F.col("vec_id").alias("anchor_id"))
    pairs = reduce(DataFrame.union, above).select("anchor", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), "low", "high")
    # All slots of an anchor, highest score first: a window is a stretch of this list that begins at its own limit.
    slots = _top(reduce(DataFrame.union, below), negatives)
    kept = slots.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("kept"))
    suffix = F.slice(F.filter("kept", lambda n: -n.minus <= F.col("high")), 1, negatives)
    window = F.filter(suffix, lambda n: -n.minus >= F.col("low"))
    found = pairs.join(kept, "anchor").join(ids, "anchor").select("anchor_id", "positive_id", "positive_score", F.posexplode(window).alias("at", "found"))
    return found.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("found.vec_id").alias("negative_id"),
        "positive_score", (-F.col("found.minus")).alias("negative_score"),
    )
