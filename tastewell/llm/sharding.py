"""Shards of near equal bytes: minimax contiguous partition of ordered groups of equal texts.

Groups stand in the order of their text's digest. The smallest capacity with which a greedy pass needs no
more than the wanted shards is found by search; the shards are then cut at group ends. DataFrame operations
only; the driver searches over a bounded summary of the group ends, which it has cut finer where it matters.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastewell.llm.mixing import running
from tastewell.session import written

SHARDS = 8
SPREAD = 1024  # parts over which the rows of one group are numbered
CELLS = 1 << 16  # of group ends that the driver holds after one look
WINDOWS = 64  # cells that one look cuts finer
REFINED = 3  # uncertain shard ends that are looked at together; the later ones depend on them


class _Ends:
    """The ordered ends ("reach") of the groups, known by cells: the first and last end of each.

    The driver holds at most some ``CELLS`` cells per look; where a question falls inside a cell, the answer
    is known within bounds, and the cells around it are cut finer by one pass over the ends among them.
    """

    def __init__(self, groups: DataFrame, total: int):
        self.groups, self.total = groups, total
        self.first, self.last = self._look([(0, total)])

    def _look(self, windows: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """First and last ends of fine cells inside the windows, which are few."""
        reach, cell = F.col("reach"), F.lit(None).cast("long")
        per = max(2, CELLS // len(windows))
        for number, (low, high) in enumerate(windows):
            width = -(-(high - low + 1) // per)
            inside = reach.between(low, high)
            cell = F.when(inside, number * per + F.floor((reach - low) / width)).otherwise(cell)
        # The table is sorted by reach: the outer bounds leave few row groups to read.
        near = self.groups.filter(reach.between(min(w[0] for w in windows), max(w[1] for w in windows)))
        rows = near.groupBy(cell.alias("cell")).agg(F.min("reach").alias("first"), F.max("reach").alias("last"))
        found = rows.filter("cell IS NOT NULL").select("first", "last").toPandas()
        order = np.argsort(found["first"].to_numpy())
        return found["first"].to_numpy(np.int64)[order], found["last"].to_numpy(np.int64)[order]

    def refine(self, spans: list[tuple[int, int]]) -> None:
        """Cuts the cells that the spans touch finer, each for itself: none gets coarser, so every look helps."""
        touched = np.zeros(len(self.first), bool)
        for low, high in spans:
            touched[max(0, np.searchsorted(self.first, low, "right") - 1) : np.searchsorted(self.first, high, "right")] = True
        touched &= self.first < self.last
        # Many cells at once take several looks, so that the expression of one stays short.
        open_ = np.flatnonzero(touched)
        looks = [self._look([(int(self.first[i]), int(self.last[i])) for i in open_[k : k + WINDOWS]]) for k in range(0, len(open_), WINDOWS)]
        first, last = (np.concatenate([look[i] for look in looks]) for i in range(2))
        first, last = np.concatenate([self.first[~touched], first]), np.concatenate([self.last[~touched], last])
        order = np.argsort(first)
        self.first, self.last = first[order], last[order]

    def before(self, limit: int) -> tuple[int, int]:
        """Bounds of the last end at or before ``limit`` (0 if there is none)."""
        i = int(np.searchsorted(self.first, limit, "right")) - 1
        if i < 0:
            return 0, 0
        if self.last[i] <= limit:
            return int(self.last[i]), int(self.last[i])
        return int(self.first[i]), (limit if self.first[i] < limit else int(self.first[i]))

    def exactly_before(self, limit: int) -> int:
        while len(set(found := self.before(limit))) > 1:
            self.refine([found])
        return found[0]

    def exactly_from(self, limit: int) -> int:
        """The first end at or after ``limit``."""
        before = self.exactly_before(limit)
        if before == limit:
            return before
        return int(self.first[np.searchsorted(self.first, limit, "left")])

    def greedy(self, capacity: int, shards: int) -> list[tuple[int, int]]:
        """Bounds of where each shard of a greedy packing ends."""
        low = high = 0
        out = []
        for _ in range(shards):
            low, high = self.before(low + capacity)[0], self.before(high + capacity)[1]
            out.append((low, high))
        return out


def smallest_capacity(ends: _Ends, widest: int, shards: int) -> int:
    """The least capacity with which greedy packing of the ordered groups needs at most ``shards`` shards."""
    low = max(-(-ends.total // shards), widest)
    high = low + widest  # always enough: every shard but the last is filled to more than low
    while low < high:
        middle = (low + high) // 2
        reached = ends.greedy(middle, shards)[-1]
        if reached[0] == ends.total:
            high = middle
        elif reached[1] < ends.total:
            low = middle + 1
        else:
            # Unknown at this precision: cut finer where the first shards that are not known exactly may end.
            ends.refine([bounds for bounds in ends.greedy(middle, shards) if bounds[0] < bounds[1]][:REFINED])
    return high


def shard_cuts(ends: _Ends, widest: int, shards: int) -> list[int]:
    """Ends at which the shards close, the last left out; no shard exceeds the smallest capacity.

    The greedy pass from the right gives the earliest place of every cut. Among the places that keep the rest
    packable each cut takes the one nearest to an even share, so that no shard is left nearly empty.
    """
    capacity = smallest_capacity(ends, widest, shards)
    earliest = [ends.total]
    for _ in range(shards - 1):
        floor = earliest[0] - capacity
        earliest.insert(0, 0 if floor <= 0 else ends.exactly_from(floor))
    cuts, start = [], 0
    for j in range(shards - 1):
        share = start + (ends.total - start) // (shards - j)
        before, after = ends.exactly_before(share), ends.exactly_from(share)
        nearest = after if after - share < share - before else before
        start = max(earliest[j], start, min(ends.exactly_before(start + capacity), nearest))
        cuts.append(start)
    return cuts


def shard_rows(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; shards have near equal bytes.

    Size is the UTF-8 length plus one. Equal texts stay together; a null text counts as empty. A group larger than an even share fills a shard by itself.
    Slots run from 0 in every shard, by group, then by id (null first); rows alike in both take any order.
    Other columns are ignored; an empty table gives no rows.
    """
    text = F.col(text_column)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        size.alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("key"),
        F.pmod(F.xxhash64(id_column), F.lit(SPREAD)).alias("sub"),
    )
    rows = written(rows, "shard-rows")
    units = written(rows.groupBy("key", "sub").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "shard-units")
    groups = units.groupBy("key").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).withColumn("part", F.substring("key", 1, 3))
    placed = running(groups, [], "part", ["key"], {"bytes": "reach", "n": "rows_reach"})
    groups = written(placed.repartitionByRange("reach").sortWithinPartitions("reach"), "shard-groups")
    totals = groups.agg(F.max("reach"), F.max("bytes")).first()
    total, widest = int(totals[0] or 0), int(totals[1] or 0)
    cuts = shard_cuts(_Ends(groups, total), widest, shards) if total else []
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("reach") > F.lit(cut)).cast("int")
    groups = groups.withColumn("shard", shard).withColumn("first_row", F.col("rows_reach") - F.col("n"))
    firsts = {r["shard"]: r["first"] for r in groups.groupBy("shard").agg(F.min("first_row").alias("first")).collect()}  # one per shard
    shard_first = F.lit(0).cast("long")
    for number, first in firsts.items():
        shard_first = F.when(F.col("shard") == number, F.lit(first)).otherwise(shard_first)
    inside = Window.partitionBy("key").orderBy("sub").rowsBetween(Window.unboundedPreceding, -1)
    ahead = units.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0))).select("key", "sub", "ahead")
    starts = ahead.join(groups.select("key", "shard", (F.col("first_row") - shard_first).alias("group_start")), "key")
    starts = starts.select("key", "sub", "shard", (F.col("group_start") + F.col("ahead")).alias("unit_start"))
    number = F.row_number().over(Window.partitionBy("key", "sub").orderBy(F.col("id").asc_nulls_first()))
    out = rows.withColumn("number", number).join(starts, ["key", "sub"])
    slot = (F.col("unit_start") + F.col("number") - 1).cast("long")
    return out.select(F.col("id").alias(id_column), "size", "text_crc32", "shard", slot.alias("slot"))
