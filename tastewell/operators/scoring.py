"""Exact top lists by inner product: users stay where they are, candidates come in passes of bounded size.

Candidates stand in shells by the most they can reach, the length of the vector and the base, and inside a shell in small
blocks of like vectors, found by cutting the widest dimension where it parts them best. What a shell can reach rules it out
for users whose k-th best is above that; for the others a block's bounds (the least and greatest value of each dimension, and
its middle and radius) tell the most it can give a user, and only users whose k-th best score is below that are multiplied
with the block. Products run in single precision over the dimensions
that the block uses, few where vectors are sparse; what they cannot rule out is multiplied anew in double precision. Movies a
user has rated are masked inside the pass, so one pass gives k unrated ones whatever the history.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastewell.constants import SIMILARITY_WEIGHT
from tastewell.functions.scores import norm
from tastewell.session import written

# Tasks get these functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Scores are compared after rounding, so block layout cannot change an order.
SCORE_DECIMALS = 9
ROUNDING = 4 * 10.0**-SCORE_DECIMALS
LEAST = np.finfo(np.float32).min  # above the score of a masked movie
USERS_PER_TILE = 4096
ITEMS_PER_BLOCK = 128  # a tile is at most USERS_PER_TILE x ITEMS_PER_BLOCK scores: 2 MB
BLOCKS_PER_GROUP = 512  # bounds of so many blocks at once: 8 MB
SHELL = 0.95  # the least that a candidate of a shell reaches, as a share of the most
BLOCKS_PER_SHELL = 32  # at least: in fewer, few are alike
VALUES_PER_TILE = 1 << 20  # dense values of a tile's users: 8 MB
ACTIVE_SHARE = 0.5  # below it, a block is multiplied with the users it can give something
TOP_SCHEMA = "userId bigint, rank int, movieId bigint, score double"


def dense_rows(idx: np.ndarray, val: np.ndarray, lengths: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Sparse rows, one after the other, as one dense block; ``place`` names each dimension's column, -1 for none."""
    block = np.zeros((len(lengths), width))
    columns = place[idx]
    rows = np.repeat(np.arange(len(lengths)), lengths)
    kept = columns >= 0
    block[rows[kept], columns[kept]] = val[kept]
    return block


def _flat(lists: Sequence, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Lists one after the other, and their lengths."""
    lengths = np.fromiter((len(x) for x in lists), np.int64, len(lists))
    if not lengths.sum():
        return np.zeros(0, kind), lengths
    return np.concatenate([np.asarray(x) for x in lists], dtype=kind, casting="unsafe"), lengths


def _alike(vectors: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows in groups of at most ``size``, each cut along its widest dimension until it is small enough.

    The cut leaves the least variance on both sides, so that zeros part from what is not zero; no side gets less than
    a thirty-second of the rows.
    """
    found, left = [], [np.arange(len(vectors))]
    while left:
        rows = left.pop()
        if len(rows) <= size:
            found.append(rows)
            continue
        part = vectors[rows]
        values = part[:, int(np.argmax(part.var(0)))]
        order = np.argsort(values, kind="stable")
        values, many, least = values[order], len(rows), max(1, len(rows) // 32)
        front = np.arange(least, many - least + 1)
        between = np.cumsum(values - values.mean())[front - 1] ** 2 * (1 / front + 1 / (many - front))
        cut = least + int(np.argmax(between))
        left += [rows[order[cut:]], rows[order[:cut]]]
    return found


class Candidates:
    """The candidates of one pass as dense rows in blocks of like vectors, and the bounds of each block.

    Rows have a column for each dimension that any candidate uses, and the base as the last one.
    """

    def __init__(self, block: pd.DataFrame, dimensions: int, weight: float, size: int = ITEMS_PER_BLOCK):
        norms = block["norm"].to_numpy(dtype=float)
        (idx, lengths), (val, _) = _flat(block["idx"], np.int64), _flat(block["val"], float)
        used = np.unique(idx[val != 0])
        self.place = np.full(dimensions, -1)
        self.place[used] = np.arange(len(used))
        self.used, self.width = used, len(used)
        items = weight * dense_rows(idx, val, lengths, self.place, self.width)
        items /= np.where(norms > 0, norms, 1.0)[:, None]
        base, ids = block["base"].to_numpy(dtype=float), block["movieId"].to_numpy(dtype=np.int64)
        items = np.column_stack([items, base])
        # Those that can reach most stand first: they show what is worth looking for.
        lengths = np.linalg.norm(items[:, :-1], axis=1)
        reach = np.lexsort((ids, -(lengths + base)))
        far = (lengths + base)[reach]
        groups, shells, start = [reach[:size]], [0], size
        while start < len(reach):
            end = max(start + BLOCKS_PER_SHELL * size, int(np.searchsorted(-far, -SHELL * far[start], "right"))) if far[start] > 0 else len(reach)
            shells.append(len(groups))
            part = reach[start:end]
            groups += [part[g] for g in _alike(items[part], size)]
            start = end
        order = np.concatenate(groups)
        self.items, self.ids = items[order], ids[order]
        self.ends = np.cumsum([len(g) for g in groups])
        self.starts = self.ends - [len(g) for g in groups]
        spans = [self.items[s:e] for s, e in zip(self.starts, self.ends, strict=True) if e > s]
        shape = len(spans), self.items.shape[1]
        self.low = np.array([x.min(0) for x in spans]).reshape(shape)
        self.high = np.array([x.max(0) for x in spans]).reshape(shape)
        self.middle = np.array([x.mean(0) for x in spans]).reshape(shape)
        self.radius = np.array([np.linalg.norm(x - x.mean(0), axis=1).max() for x in spans])
        # The blocks of each shell, and its longest vector and greatest base.
        self.shells = [(a, b) for a, b in zip(shells, [*shells[1:], len(spans)], strict=True) if b > a]
        parts = [slice(self.starts[a], self.ends[b - 1]) for a, b in self.shells]
        self.tops = [(lengths[order[x]].max(), base[order[x]].max()) for x in parts]
        # What a block is multiplied with: its own columns only.
        self.columns = [np.flatnonzero((x != 0).any(0)) for x in spans]
        self.light = [x[:, c].astype(np.float32) for x, c in zip(spans, self.columns, strict=True)]
        self.longest = np.linalg.norm(self.items, axis=1).max(initial=0.0)
        self.by_id = np.argsort(self.ids, kind="stable")
        self.rank = np.empty(len(self.ids), np.int64)
        self.rank[self.by_id] = np.arange(len(self.ids))

    def vectors(self, idx: np.ndarray, val: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sparse users in the candidates' columns, without the base's."""
        return dense_rows(idx, val, lengths, self.place, self.width)

    def bounds(self, users: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The most that each of the blocks can give each user, by block and user; rounding is left to the caller."""
        boxes = self.high[blocks].astype(np.float32) @ np.maximum(users, 0).T
        if (users < 0).any():
            boxes += self.low[blocks].astype(np.float32) @ np.minimum(users, 0).T
        balls = self.middle[blocks].astype(np.float32) @ users.T
        balls += self.radius[blocks].astype(np.float32)[:, None] * np.linalg.norm(users, axis=1)
        return np.minimum(boxes, balls, out=boxes)

    def places(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the ids are candidates here, and their places."""
        sorted_ids = self.ids[self.by_id]
        at = np.minimum(np.searchsorted(sorted_ids, ids), max(0, len(sorted_ids) - 1))
        found = np.flatnonzero(sorted_ids[at] == ids) if len(sorted_ids) else np.zeros(0, np.int64)
        return found, self.by_id[at[found]]


def _ordered(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> np.ndarray:
    """The order by row, falling score and id; scores are rounded. One sort of whole numbers where all three fit into 63 bits."""
    if len(rows):
        steps, first = np.rint(scores * 10.0**SCORE_DECIMALS), ids.min()
        for_steps = int(steps.max() - steps.min()).bit_length()
        for_ids = (int(ids.max()) - int(first)).bit_length()
        if for_steps <= 52 and int(rows.max()).bit_length() + for_steps + for_ids <= 63:
            falling = (steps.max() - steps).astype(np.int64)
            return np.argsort((rows << (for_steps + for_ids)) | (falling << for_ids) | (ids - first))
    return np.lexsort((ids, -scores, rows))


def _merged(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, id, score and place (from 0) of the ``k`` best of each row; equal scores go to the lower id."""
    order = _ordered(rows, ids, scores)
    rows, ids, scores = rows[order], ids[order], scores[order]
    counts = np.bincount(rows)
    place = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    kept = place < k
    return rows[kept], ids[kept], scores[kept], place[kept]


def _products(users: np.ndarray, candidates: Candidates, rows: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rounded scores of single pairs, a bounded number of values at a time."""
    out = np.empty(len(rows))
    step = max(1, VALUES_PER_TILE // users.shape[1])
    for start in range(0, len(rows), step):
        cut = slice(start, start + step)
        out[cut] = np.einsum("ij,ij->i", users[rows[cut]], candidates.items[places[cut]])
    return np.round(out, SCORE_DECIMALS)


def best_of(users: np.ndarray, rated, candidates: Candidates, k: int, floor: np.ndarray | None = None):
    """(row, id, score, place) of every user's ``k`` best, those in ``rated`` left out, and the number of blocks skipped.

    Users are vectors of all dimensions, or of the columns that the candidates use. ``rated`` is None, a list of ids for each user, or all lists one after the
    other with their lengths. With a ``floor`` for each user, scores below that may be missing.
    """
    n, many = len(users), len(candidates.starts)
    if users.shape[1] != candidates.width:
        users = users[:, candidates.used]
    users = np.column_stack([users, np.ones(n)])
    light = users.astype(np.float32)
    people = np.ascontiguousarray(light.T)
    # Single precision is off by no more than this, however the sums are ordered.
    lengths = np.linalg.norm(users, axis=1)
    slack = (ROUNDING + 4 * np.finfo(np.float32).eps * (users.shape[1] + 4) * lengths * max(1.0, candidates.longest)).astype(np.float32)
    floor = np.full(n, -np.inf) if floor is None else floor.copy()
    limit = floor.astype(np.float32) - slack  # what a product in single precision has to reach
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    masked_rows = masked_places = np.zeros(0, np.int64)
    if rated is not None:
        flat, counts = rated if isinstance(rated, tuple) else _flat(rated, np.int64)
        found, masked_places = candidates.places(flat)
        masked_rows = np.repeat(np.arange(n), counts)[found]
        order = np.argsort(masked_places, kind="stable")
        masked_rows, masked_places = masked_rows[order], masked_places[order]
    cuts = np.searchsorted(masked_places, [candidates.starts, candidates.ends])
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    skipped = number = 0
    unset = np.isneginf(limit).any()

    def settle() -> None:
        nonlocal held, number, unset
        if not waiting:
            return
        rows, places = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting.clear()
        number = 0
        scores = _products(users, candidates, rows, places)
        good = scores >= floor[rows]
        found = rows[good], candidates.rank[places[good]], scores[good]
        held = _merged(*(np.concatenate([h, f]) for h, f in zip(held, found, strict=False)), k)
        full = held[3] == k - 1
        floor[held[0][full]] = held[2][full]
        limit[held[0][full]] = (held[2][full]).astype(np.float32) - slack[held[0][full]]
        unset = np.isneginf(limit).any()

    reaches = np.linalg.norm(light[:, :-1], axis=1)
    middle = light.mean(0, keepdims=True)
    for (first, last), (length, base) in zip(candidates.shells, candidates.tops, strict=True):
        # No vector of a shell gives more than its length times the user's.
        open_to = reaches * np.float32(length) + np.float32(base) + slack >= limit
        some = np.flatnonzero(open_to)
        if not len(some):
            skipped += last - first
            continue
        # Picking users costs more than multiplying some in vain.
        some = some if len(some) < n * ACTIVE_SHARE else None
        here, floors = (light, limit) if some is None else (light[some], limit[some])
        # The blocks that can give most to the users in the middle come first.
        order = first + np.argsort(-candidates.bounds(middle, np.arange(first, last))[:, 0], kind="stable")
        for begin in range(0, len(order), BLOCKS_PER_GROUP):
            group = order[begin : begin + BLOCKS_PER_GROUP]
            reach = candidates.bounds(here, group)
            reach += slack if some is None else slack[some]
            for place, block in enumerate(group):
                start, end = int(candidates.starts[block]), int(candidates.ends[block])
                active = reach[place] >= floors
                wanted = np.count_nonzero(active)
                if not wanted:
                    skipped += 1
                    continue
                columns = candidates.columns[block]
                who = some
                if wanted < len(here) * ACTIVE_SHARE:
                    who = np.flatnonzero(active) if some is None else some[active]
                scores = candidates.light[block] @ (people[columns] if who is None else people[columns[:, None], who])
                cut = slice(cuts[0, block], cuts[1, block])
                if cut.stop > cut.start:
                    rows, places = masked_rows[cut], masked_places[cut] - start
                    if who is not None:
                        at = np.minimum(np.searchsorted(who, rows), len(who) - 1)
                        kept = who[at] == rows
                        rows, places = at[kept], places[kept]
                    scores[places, rows] = -np.inf
                limits, margin = (limit, slack) if who is None else (limit[who], slack[who])
                if end - start > k and unset:
                    # Nothing below the k-th best of this block alone can stay.
                    best = np.partition(scores, end - start - k, axis=0)[end - start - k]
                    limits = np.maximum(limits, best - 2 * margin)
                limits = np.maximum(limits, LEAST)
                hit = np.flatnonzero(scores.max(0) >= limits)
                if not len(hit):
                    continue
                places, rows = np.nonzero(scores[:, hit] >= limits[hit])
                rows = hit[rows] if who is None else who[hit[rows]]
                waiting.append((rows, start + places))
                number += len(rows)
                if number >= n * k // 2 or unset:
                    settle()
                    floors = limit if some is None else limit[some]
            settle()
            floors = limit if some is None else limit[some]
    rows, ranks, scores, place = held
    return (rows, candidates.ids[candidates.by_id[ranks]], scores, place), skipped


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """A column of lists one after the other, and their lengths."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), lengths


def _tiles(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, ``rows`` at a time: batches may be far smaller."""
    held, many = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, rows - many)
            batch = batch.slice(part.num_rows)
            held.append(part)
            many += part.num_rows
            if many == rows:
                yield pa.concat_batches(held)
                held, many = [], 0
    if held:
        yield pa.concat_batches(held)


def score_pass(
    users: DataFrame, block: pd.DataFrame, k: int, dimensions: int, weight: float = SIMILARITY_WEIGHT, skipped=None, rest: tuple[float, float] | None = None
) -> DataFrame:
    """The ``k`` best of one block of candidates for every user, without a shuffle.

    The score is ``weight`` times the product of the normed vectors plus the candidate's ``base``. A column
    ``rated`` of the users holds movies that are left out, columns ``ids`` and ``scores`` the best of earlier passes. ``skipped``, an accumulator, counts blocks not multiplied.

    With ``rest``, the longest vector and the greatest base of the candidates to come, the result has a row for each user:
    the lists so far as ``ids`` and ``scores``, and the user's columns if one to come can still enter the list (``open``).

    The result is written, so that the block can be dropped from the executors at once.
    """
    # Plain arrays: a broadcast object would be unpacked by its class's name, which executors do not know.
    shipped = users.sparkSession.sparkContext.broadcast(vars(Candidates(block, dimensions, weight)))
    own = [f for f in users.schema.fields if f.name not in ("userId", "ids", "scores", "open")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        candidates = Candidates.__new__(Candidates)
        vars(candidates).update(shipped.value)
        per_tile = max(1, min(USERS_PER_TILE, VALUES_PER_TILE // (candidates.width + 1)))
        for part in _tiles(batches, per_tile):
            n, norms = part.num_rows, part["norm"].to_numpy(zero_copy_only=False)
            (idx, lengths), (val, _) = _lists(part["idx"]), _lists(part["val"])
            vectors = candidates.vectors(idx.astype(np.int64), val.astype(float), lengths)
            vectors /= norms[:, None]
            rated = _lists(part["rated"]) if "rated" in part.schema.names else None
            floor, held = None, None
            if "ids" in part.schema.names:
                (ids, counts), (scores, _) = _lists(part["ids"]), _lists(part["scores"])
                held = np.repeat(np.arange(n), counts), ids, scores
                floor = _kth(counts, scores, k)
            (rows, ids, scores, place), left_out = best_of(vectors, rated, candidates, k, floor)
            if held is not None:
                rows, ids, scores, place = _merged(*(np.concatenate(x) for x in zip(held, (rows, ids, scores), strict=True)), k)
            if skipped is not None:
                skipped.add(left_out)
            if rest is None:
                columns = [part["userId"].take(pa.array(rows)), pa.array((place + 1).astype(np.int32)), pa.array(ids), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["userId", "rank", "movieId", "score"])
                continue
            counts = np.bincount(rows, minlength=n)
            # The whole vector: those to come may use other columns.
            squares = np.bincount(np.repeat(np.arange(n), lengths), np.square(val.astype(float)), minlength=n)
            most = np.sqrt(squares) / norms * rest[0] + rest[1]
            closed = most + 1e-6 * np.abs(most) + ROUNDING < _kth(counts, scores, k)
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            kept = pa.array(np.arange(n), mask=closed)
            columns = [part["userId"], *(part[f.name].take(kept) for f in own), *(pa.ListArray.from_arrays(ends, pa.array(x)) for x in (ids, scores)), pa.array(~closed)]
            yield pa.RecordBatch.from_arrays(columns, names=["userId", *(f.name for f in own), "ids", "scores", "open"])

    carried = f"userId bigint, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in own)}, ids array<bigint>, scores array<double>, open boolean"
    found = written(users.mapInArrow(score, TOP_SCHEMA if rest is None else carried), "top-pass")
    shipped.destroy()
    return found


def _kth(counts: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The last score of each list of ``k``, the lists standing one after the other; below everything for shorter ones."""
    least = np.full(len(counts), -np.inf)
    full = counts == k
    least[full] = scores[np.cumsum(counts)[full] - 1]
    return least


def with_rated(users: DataFrame, history: DataFrame, candidates: DataFrame) -> DataFrame:
    """Users with ``rated``: the candidates among the movies they have rated, so at most one entry a candidate."""
    seen = history.select("userId", "movieId").join(candidates.select("movieId"), "movieId", "left_semi")
    lists = seen.groupBy("userId").agg(F.collect_set("movieId").alias("rated"))
    rated = F.coalesce("rated", F.array().cast("array<bigint>")).alias("rated")
    return users.join(lists, "userId", "left").select(*[F.col(c) for c in users.columns], rated)


def top_by_passes(
    users: DataFrame,
    candidates: DataFrame,
    k: int,
    dimensions: int,
    per_pass: int,
    weight: float = SIMILARITY_WEIGHT,
    history: DataFrame | None = None,
    skipped=None,
) -> DataFrame:
    """The ``k`` best candidates of every user: ``userId, rank, movieId, score``.

    Users have ``userId, idx, val, norm``, candidates ``movieId, idx, val, norm, base``. Users stay where they are; a pass
    ships at most ``per_pass`` candidates that use all dimensions, more if they use few. The candidates that can reach most
    come first, and a user whose list none of the others can enter any more has no part in later passes.
    With a ``history`` (``userId, movieId``) a user's rated movies are left out.
    """
    length = weight * norm(F.col("val")) / F.when(F.col("norm") > 0, F.col("norm")).otherwise(1.0)
    chosen = written(candidates.select("movieId", "idx", "val", "norm", "base", length.alias("length")), "chosen")
    # A candidate takes a value for each dimension that any of them uses.
    used = max(1, chosen.select(F.explode("idx").alias("i")).agg(F.count_distinct("i")).first()[0])
    chosen = written(_by_reach(chosen, max(per_pass, per_pass * dimensions // used)), "pass-candidates")
    left = users.select("userId", "idx", "val", "norm")
    if history is not None:
        left = with_rated(left, history, chosen)
    passes = chosen.groupBy("pass").agg(F.max("length"), F.max("base")).orderBy("pass").collect()
    found = []
    for place, (number, *_) in enumerate(passes):
        block = chosen.filter(F.col("pass") == number).drop("pass", "length").toArrow().to_pandas()
        rest = tuple(max(p[i] for p in passes[place + 1 :]) for i in (1, 2)) if place + 1 < len(passes) else None
        scored = score_pass(left, block, k, dimensions, weight, skipped, rest)
        if rest is None:
            found.append(scored)
            break
        entries = F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "entry")
        lists = scored.filter("NOT open").select("userId", entries)
        found.append(lists.select("userId", (F.col("at") + 1).alias("rank"), F.col("entry.ids").alias("movieId"), F.col("entry.scores").alias("score")))
        left = scored.filter("open")
        if left.isEmpty():
            break
    return reduce(DataFrame.unionByName, found) if found else users.sparkSession.createDataFrame([], TOP_SCHEMA)


def _by_reach(candidates: DataFrame, per_pass: int) -> DataFrame:
    """Candidates with the number of their pass, those with the longest vectors and greatest bases first; no pass holds more than ``per_pass``.

    Where too many reach equally far they are dealt by a hash.
    """
    many = candidates.count()
    if many > per_pass:
        passes = max(2, -(-many * 17 // (per_pass * 16)))
        reach = F.col("length") + F.col("base")
        cuts = candidates.select(reach.alias("reach")).approxQuantile("reach", [1 - i / passes for i in range(1, passes)], 1 / (64 * passes))
        number = reduce(Column.__add__, [F.when(reach < cut, 1).otherwise(0) for cut in cuts], F.lit(0))
        dealt = candidates.withColumn("pass", number)
        if dealt.groupBy("pass").count().agg(F.max("count")).first()[0] <= per_pass:
            return dealt.repartition("pass")
    return _in_passes(candidates, per_pass)


def _in_passes(candidates: DataFrame, per_pass: int) -> DataFrame:
    """Candidates with the number of their pass; no pass holds more than ``per_pass``.

    Movies, one row each, are dealt by a hash into the passes that the volume needs with a sixteenth to spare; if one is too
    large all the same, they are dealt into more. Every pass gives each user a list, so more of them cost more.
    """
    many = candidates.count()
    if many <= per_pass:
        return candidates.withColumn("pass", F.lit(0))
    passes = max(2, -(-many * 17 // (per_pass * 16)))
    while passes < 2 * many:
        dealt = candidates.withColumn("pass", F.pmod(F.xxhash64("movieId"), F.lit(passes)).cast("int"))
        if dealt.groupBy("pass").count().agg(F.max("count")).first()[0] <= per_pass:
            return dealt.repartition("pass")
        passes += passes // 4 + 1
    raise ValueError("movies stand among the candidates more than once")
