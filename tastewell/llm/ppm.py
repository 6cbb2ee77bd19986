"""Prediction by partial matching over bytes: a context trie trained on the corpus scores every document.

The text a document stands for is its words (runs without ASCII white space, A-Z lower-cased), joined by
one space and closed by an end symbol. A context holds the ``order`` bytes before a symbol. The trie is
spread over the cluster by the two bytes nearest to the symbol: such a subtree holds every longer context
that ends in them, so escapes down to order two are local; orders one and zero are one table of at most
65,536 counts. A symbol's code length depends on its n-gram alone, so documents are packed into chunks and
each chunk asks once for each of its distinct n-grams and words.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
CHUNK_BYTES = 8 << 20
SLICE_BYTES = 2 << 20  # of a chunk worked on at a time
KEYS_PER_BUCKET = 500_000
START, END = 0xFE, 0xFF  # bytes that UTF-8 never holds
SYMBOLS = 255  # every byte but START

CHUNK_SCHEMA = (
    "ids array<bigint>, learn array<boolean>, text binary, lengths array<int>, keys bigint, train_tokens bigint, "
    "train_docs bigint, pairs array<int>, pair_counts array<bigint>"
)
REQUEST_SCHEMA = "bucket bigint, chunk bigint, kind int, n bigint, keys binary, counts binary"
ANSWER_SCHEMA = "chunk bigint, kind int, bucket bigint, n bigint, known bigint, answers binary"
SCORE_SCHEMA = "id bigint, learn boolean, n_tokens bigint, n_known bigint, log_counts double, score double"


def _words(texts: pa.Array) -> pa.Array:
    """Lists of words; empty lists for texts without any."""
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    lists = pc.ascii_split_whitespace(trimmed)
    empty = pc.equal(pc.binary_length(trimmed), 0)
    if pc.any(empty).as_py():
        lists = pc.if_else(empty, pa.scalar([], lists.type), lists)
    return lists


def _stream(text: np.ndarray, lengths: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of all symbols of the packed texts, and where each text starts among them."""
    sizes = lengths + order + 1
    ends = np.cumsum(sizes)
    buffer = np.full(int(ends[-1]) + 8, START, np.uint8)
    held = np.ones(len(buffer), bool)
    held[-8:] = False
    starts = ends - sizes
    for k in range(order):
        held[starts + k] = False
    buffer[ends - 1] = END
    inner = held.copy()
    inner[ends - 1] = False
    buffer[inner] = text
    windows = np.ndarray((len(buffer) - 7,), ">u8", buffer, strides=(1,))
    places = np.flatnonzero(held) - order
    codes = windows[places].astype(np.uint64) >> np.uint64(8 * (7 - order))
    return codes, np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and how often each occurs."""
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, len(codes)))


def _slices(text: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """(documents, their codes, starts among these) for a bounded volume of text at a time; one document at least."""
    ends, start = np.cumsum(lengths), 0
    while start < len(lengths):
        begin = int(ends[start] - lengths[start])
        stop = max(start + 1, int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")))
        yield slice(start, stop), *_stream(text[begin : int(ends[stop - 1])], lengths[start:stop], order)
        start = stop


def _distinct(text: np.ndarray, lengths: np.ndarray, learn: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a chunk in order, and how often each occurs in training documents."""
    keys, trained, times = [], [], []
    for docs, codes, _ in _slices(text, lengths, order):
        keys.append(_counted(codes)[0])
        found = _counted(codes[np.repeat(learn[docs], lengths[docs] + 1)])
        trained.append(found[0])
        times.append(found[1])
    all_keys = _counted(np.concatenate(keys))[0]
    places = np.searchsorted(all_keys, np.concatenate(trained))
    return all_keys, np.bincount(places, weights=np.concatenate(times), minlength=len(all_keys)).astype(np.int32)


def _squeezed(keys: np.ndarray) -> bytes:
    """Ascending codes as differences, byte by byte, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _small(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _unsqueezed(data: bytes, n: int) -> np.ndarray:
    planes = _large(data, np.uint8, 8 * n).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _small(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True)


def _large(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, n * np.dtype(kind).itemsize, codec="zstd"), kind)


def _pieces(batches: Iterator[pa.RecordBatch], volume: int) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of at most ``volume`` bytes of text; a single text may exceed it."""
    for batch in batches:
        sizes, start = pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), 0
        while start < batch.num_rows:
            fit = max(1, int(np.searchsorted(np.cumsum(sizes[start:]), volume, side="right")))
            yield batch.slice(start, fit)
            start += fit


def _pack(order: int, chunk_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in _pieces(batches, SLICE_BYTES):
            lists = _words(batch.column(1))
            texts = pc.cast(pc.binary_join(lists, " "), pa.binary())
            place, lengths = 0, pc.binary_length(texts).to_numpy(zero_copy_only=False)
            while place < len(texts):
                # As many documents as fill the chunk; one at least.
                fit = int(np.searchsorted(np.cumsum(lengths[place:]), chunk_bytes - size, side="right"))
                stop = min(len(texts), place + max(fit, 0 if held else 1))
                if stop > place:
                    part = slice(place, stop)
                    held.append((batch.column(0)[part], batch.column(2)[part], texts[part], pc.list_value_length(lists[part])))
                    size += int(lengths[part].sum())
                    place = stop
                if place < len(texts) or size >= chunk_bytes:
                    full, held, size = held, [], 0
                    yield _chunk(full, order)
                    del full
                    pa.default_memory_pool().release_unused()
        if held:
            yield _chunk(held, order)

    return pack


def _chunk(held: list[tuple], order: int) -> pa.RecordBatch:
    ids, learn, texts, tokens = (pa.concat_arrays([h[i] for h in held]) for i in range(4))
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    text = b"".join(texts.to_pylist())
    train = learn.to_numpy(zero_copy_only=False).astype(bool)
    pairs, keys = np.zeros(1 << 16, np.int64), []
    for docs, codes, _ in _slices(np.frombuffer(text, np.uint8), lengths, order):
        keys.append(_counted(codes)[0])
        codes = codes[np.repeat(train[docs], lengths[docs] + 1)]
        pairs += np.bincount((codes & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
    seen = np.flatnonzero(pairs)
    tokens = tokens.to_numpy(zero_copy_only=False)
    one = lambda value, kind: pa.array([value], kind)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([ids.to_pylist()], pa.list_(pa.int64())),
            one(train.tolist(), pa.list_(pa.bool_())),
            one(pa.compress(text, codec="zstd", asbytes=True), pa.binary()),
            one(lengths.astype(np.int32), pa.list_(pa.int32())),
            one(len(_counted(np.concatenate(keys))[0]), pa.int64()),
            one(int(tokens[train].sum() + train.sum()), pa.int64()),
            one(int(train.sum()), pa.int64()),
            one(seen.astype(np.int32), pa.list_(pa.int32())),
            one(pairs[seen], pa.list_(pa.int64())),
        ],
        names=["ids", "learn", "text", "lengths", "keys", "train_tokens", "train_docs", "pairs", "pair_counts"],
    )


def _unpacked(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Text bytes, lengths, training mask and word lists of a chunk."""
    lengths = batch.column("lengths")[row].values.to_numpy().astype(np.int64)
    text = pa.decompress(batch.column("text")[row].as_buffer(), int(lengths.sum()), codec="zstd") if lengths.sum() else pa.py_buffer(b"")
    learn = batch.column("learn")[row].values.to_numpy(zero_copy_only=False).astype(bool)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    texts = pa.Array.from_buffers(pa.string(), len(lengths), [None, pa.py_buffer(offsets), text])
    return np.frombuffer(text, np.uint8), lengths, learn, _words(texts)


def _gram_bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of the subtree a code belongs to: the two bytes before its symbol."""
    subtree = (codes >> np.uint64(8)) & np.uint64(0xFFFF)
    mixed = (subtree + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _word_bucket(words: pa.Array, buckets: int) -> np.ndarray:
    hashed = pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False) if len(words) else np.zeros(0, np.uint64)
    return (hashed % np.uint64(buckets)).astype(np.int64)


def _by_bucket(bucket: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order by bucket, and where each bucket starts in it."""
    return np.argsort(bucket, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])


def _requests(order: int, buckets: int):
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                pa.default_memory_pool().release_unused()
                chunk = batch.column("chunk")[row].as_py()
                text, lengths, learn, lists = _unpacked(batch, row)
                keys, counts = _distinct(text, lengths, learn, order)
                place, at = _by_bucket(_gram_bucket(keys, buckets), buckets)
                keys, counts = keys[place], counts[place]
                spans = [slice(at[b], at[b + 1]) for b in range(buckets)]
                out = [(b, chunk, 0, w.stop - w.start, _squeezed(keys[w]), _small(counts[w])) for b, w in enumerate(spans) if w.stop > w.start]
                words = lists.flatten().dictionary_encode()
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                index = words.indices.to_numpy(zero_copy_only=False)
                counts = np.bincount(index[np.repeat(learn, sizes)], minlength=len(words.dictionary)).astype(np.int32)
                place, at = _by_bucket(_word_bucket(words.dictionary, buckets), buckets)
                spread = pa.ListArray.from_arrays(pa.array(at, pa.int32()), words.dictionary.take(pa.array(place)))
                joined = pc.cast(pc.binary_join(spread, " "), pa.binary())
                counts = counts[place]
                spans = [slice(at[b], at[b + 1]) for b in range(buckets)]
                out += [(b, chunk, 1, w.stop - w.start, joined[b].as_py(), _small(counts[w])) for b, w in enumerate(spans) if w.stop > w.start]
                columns = list(zip(*out, strict=True))
                if columns:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        names=["bucket", "chunk", "kind", "n", "keys", "counts"],
                    )

    return requests


def code_lengths(keys: np.ndarray, counts: np.ndarray, pairs: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of the last byte of each n-gram after the bytes before it.

    ``keys`` are distinct, ascending, and hold whole subtrees of the two bytes before the symbol; ``counts``
    are training counts (0: only asked for); ``pairs`` counts (byte before, symbol) over all training text.
    A context with n occurrences of q symbols escapes with q/2n and gives a symbol seen c times (2c-1)/2n;
    symbols seen in the longer context that was left are excluded first.
    """
    log, open_ = np.zeros(len(keys)), np.ones(len(keys), bool)
    trained = counts > 0
    grams, times = keys[trained], counts[trained].astype(np.int64)
    symbol = (keys & np.uint64(0xFF)).astype(np.int64)

    def step(c, n, q, where):
        """Applies one order to the open keys at ``where``."""
        live = n > 0
        hit = live & (c > 0)
        log[where[hit]] += np.log10((2 * c[hit] - 1) / (2 * n[hit]))
        open_[where[hit]] = False
        left = live & ~hit
        log[where[left]] += np.log10(q[left] / (2 * n[left]))

    above = None  # contexts of the order above: codes, number of symbols, mass of these symbols one order below
    for k in range(order, 1, -1):
        mask = np.uint64((1 << (8 * (k + 1))) - 1)
        sub, inverse = np.unique(grams & mask, return_inverse=True)
        c_all = np.bincount(inverse, weights=times, minlength=len(sub)).astype(np.int64)
        contexts, of = np.unique(sub >> np.uint64(8), return_inverse=True)
        n_all = np.bincount(of, weights=c_all, minlength=len(contexts)).astype(np.int64)
        q_all = np.bincount(of, minlength=len(contexts))
        if above is not None:  # what the contexts one byte longer exclude here
            mass = np.bincount(above[3], weights=c_all[np.searchsorted(sub, above[2] & mask)], minlength=len(above[0])).astype(np.int64)
            above = (above[0], above[1], mass)
        where = np.flatnonzero(open_)
        asked = keys[where]
        place, seen = _find(contexts, (asked & mask) >> np.uint64(8))
        n, q = np.where(seen, n_all[place], 0) if len(contexts) else np.zeros(len(where), np.int64), None
        q = np.where(seen, q_all[place], 0) if len(contexts) else n.copy()
        n, q = _excluding(n, q, above, (asked >> np.uint64(8)) & np.uint64((1 << (8 * (k + 1))) - 1))
        spot, there = _find(sub, asked & mask)
        c = np.where(there, c_all[spot], 0) if len(sub) else np.zeros(len(where), np.int64)
        step(c, n, q, where)
        above = (contexts, q_all, sub, of)
    # Orders one and zero from the table all tasks share.
    if above is not None:
        before = ((above[2] >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
        mass = np.bincount(above[3], weights=pairs[before, (above[2] & np.uint64(0xFF)).astype(np.int64)], minlength=len(above[0]))
        above = (above[0], above[1], mass.astype(np.int64))
    where = np.flatnonzero(open_)
    last = ((keys[where] >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
    n, q = pairs.sum(1)[last], (pairs > 0).sum(1)[last]
    n, q = _excluding(n, q, above, (keys[where] >> np.uint64(8)) & np.uint64(0xFFFF))
    step(pairs[last, symbol[where]], n, q, where)
    where = np.flatnonzero(open_)
    last = ((keys[where] >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64)
    single = pairs.sum(0)
    n = single.sum() - ((pairs > 0) * single[None, :]).sum(1)[last]
    q = (single > 0).sum() - (pairs > 0).sum(1)[last]
    step(single[symbol[where]], n, q, where)
    where = np.flatnonzero(open_)
    log[where] -= np.log10(max(1, SYMBOLS - int((single > 0).sum())))
    return log


def _find(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the values in an ascending array, and whether they are there."""
    place = np.searchsorted(ordered, values)
    if not len(ordered):
        return place, np.zeros(len(values), bool)
    place = np.minimum(place, len(ordered) - 1)
    return place, ordered[place] == values


def _excluding(n, q, above, longer):
    """Counts less the symbols that the context one byte longer has seen."""
    if above is None or not len(above[0]):
        return n, q
    place, seen = _find(above[0], longer)
    return n - np.where(seen, above[2][place], 0), q - np.where(seen, above[1][place], 0)


def _answer(order: int, pairs: np.ndarray):
    def answer(table: pa.Table) -> pa.Table:
        rows = table.sort_by([("kind", "ascending"), ("chunk", "ascending")]).to_pylist()
        out = []
        for kind in (0, 1):
            part = [r for r in rows if r["kind"] == kind]
            if not part:
                continue
            counts = np.concatenate([_large(r["counts"], np.int32, r["n"]) for r in part]).astype(np.int64)
            if kind == 0:
                keys, inverse = np.unique(np.concatenate([_unsqueezed(r["keys"], r["n"]) for r in part]), return_inverse=True)
                total = np.bincount(inverse, weights=counts, minlength=len(keys)).astype(np.int64)
                values = code_lengths(keys, total, pairs, order).astype(np.float32)[inverse]
                known = 0
            else:
                lists = pc.split_pattern(pa.array([r["keys"] for r in part], pa.binary()), b" ").flatten()
                codes = lists.dictionary_encode().indices.to_numpy(zero_copy_only=False)
                total = np.bincount(codes, weights=counts).astype(np.int64)
                values, known = total[codes], int((total > 0).sum())
            at = 0
            for i, r in enumerate(part):
                out.append((r["chunk"], kind, r["bucket"], r["n"], known if i == 0 else 0, _small(values[at : at + r["n"]])))
                at += r["n"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        columns = zip(*out, strict=True)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["chunk", "kind", "bucket", "n", "known", "answers"])

    return answer


def _finish(order: int, buckets: int, end_count: int):
    def finish(chunks: pa.Table, answers: pa.Table) -> pa.Table:
        batch = chunks.combine_chunks().to_batches()[0]
        text, lengths, learn, lists = _unpacked(batch, 0)
        by_kind: dict[int, list] = {0: [], 1: []}
        for r in sorted(answers.select(["kind", "bucket", "n", "answers"]).to_pylist(), key=lambda r: r["bucket"]):
            by_kind[r["kind"]].append(_large(r["answers"], (np.float32, np.int64)[r["kind"]], r["n"]))
        keys, _ = _distinct(text, lengths, learn, order)
        # The answers come bucket by bucket, ascending in each, as the requests went.
        value = np.empty(len(keys))
        value[_by_bucket(_gram_bucket(keys, buckets), buckets)[0]] = np.concatenate(by_kind[0])
        score = np.empty(len(lengths))
        for docs, codes, starts in _slices(text, lengths, order):
            index, own = pd.factorize(codes)
            score[docs] = np.add.reduceat(value[np.searchsorted(keys, own)][index], starts)
        words = lists.flatten().dictionary_encode()
        place, _ = _by_bucket(_word_bucket(words.dictionary, buckets), buckets)
        count = np.zeros(len(words.dictionary), np.int64)
        count[place] = np.concatenate([np.zeros(0, np.int64), *by_kind[1]])
        sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(len(sizes)), sizes)
        used = count[words.indices.to_numpy(zero_copy_only=False)]
        known = np.bincount(row, weights=used > 0, minlength=len(sizes)).astype(np.int64) + (end_count > 0)
        logs = np.bincount(row, weights=np.log10(used + 0.1), minlength=len(sizes)) + np.log10(end_count + 0.1)
        return pa.table(
            {
                "id": batch.column("ids")[0].values,
                "learn": pa.array(learn),
                "n_tokens": pa.array(sizes + 1),
                "n_known": pa.array(known),
                "log_counts": pa.array(logs),
                "score": pa.array(score),
            }
        )

    return finish


def ppm_scores(
    docs: DataFrame, learn: Column, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Score of every row's whole text under the model learned from the rows where ``learn`` holds.

    Returns id, held_out, n_tokens, n_known, train_tokens, base_score and score; the base is the smoothed
    word model. A null text counts as empty (its end symbol is scored), a null in ``learn`` as held out;
    repeated rows and ids are scored each. Further columns of the input are ignored. Without training rows
    every symbol has the same probability.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
    )
    chunks = written(
        rows.mapInArrow(_pack(order, chunk_bytes), CHUNK_SCHEMA).withColumn("chunk", F.monotonically_increasing_id()), "ppm-chunks"
    )
    totals = chunks.agg(F.sum("keys"), F.sum("train_tokens"), F.sum("train_docs")).first()
    keys, train_tokens, train_docs = (int(x or 0) for x in totals)
    pairs = np.zeros((256, 256), np.int64)  # at most 65,536 sums reach the driver
    for r in (
        chunks.select(F.explode(F.arrays_zip("pairs", "pair_counts")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.pair_counts").alias("n"))
        .collect()
    ):
        pairs[r["pair"] >> 8, r["pair"] & 0xFF] = r["n"]
    buckets = max(8, -(-keys // KEYS_PER_BUCKET))
    packed = chunks.select("chunk", "ids", "learn", "text", "lengths")
    requests = packed.mapInArrow(_requests(order, buckets), REQUEST_SCHEMA)
    answers = written(
        requests.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_answer(order, pairs), ANSWER_SCHEMA), "ppm-answers"
    )
    distinct = int(answers.agg(F.sum("known")).first()[0] or 0) + (train_docs > 0)
    scored = (
        packed.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_finish(order, buckets, train_docs), SCORE_SCHEMA)
    )
    norm = float(np.log10(train_tokens + 0.1 * (distinct + 1)))
    return scored.select(
        F.col("id").alias(id_column),
        (~F.col("learn")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") - F.col("n_tokens") * F.lit(norm)).alias("base_score"),
        "score",
    )
