"""Token ids in directly addressable codes: files that give any token without decoding a block.

An id is cut into chunks of ``CHUNK_BITS`` bits, lowest first. Level k holds the k-th chunk of every id that
has more than k chunks, in order, bit-packed; a bitmap tells for each entry of a level whether the id goes
on, and a directory counts the ones before every ``RANK_STEP`` entries. The place of an id's next chunk is
the number of ones before it in the bitmap. One row of the table holds one run of consecutive documents.
"""

from __future__ import annotations

import functools
import os
import re
import sys
import types
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell.llm.mixing import running
from tastewell.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BITS = 8
LEVELS = 4  # 32-bit ids
RANK_STEP = 512
END_ID = 1
TEXT_BYTES_PER_RUN = 2 << 20
KNOWN_WORDS = 450_000
KNOWN_PIECES = 300_000
PIECES_PER_TEXT = 512
WORD_END = "</w>"
MEMORY = "tastewell_word_ids"
SIGNS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
RUN_FIELDS = [
    ("part", "bigint"), ("run", "bigint"), ("n_tokens", "bigint"), ("doc_ids", "array<bigint>"), ("doc_tokens", "array<bigint>"),
    ("levels", "array<binary>"), ("bitmaps", "array<binary>"), ("ranks", "array<binary>"),
]
RUN_SCHEMA = ", ".join(f"{n} {t}" for n, t in RUN_FIELDS)
RUN_TYPES = [pa.int64()] * 3 + [pa.list_(pa.int64())] * 2 + [pa.list_(pa.binary())] * 3


def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, bitmaps and rank directories of one run of ids."""
    levels, bitmaps, ranks = [], [], []
    rest = ids.astype(np.uint32)
    for _ in range(LEVELS):
        if not len(rest):
            break
        levels.append((rest & np.uint32(0xFF)).astype(np.uint8).tobytes())
        rest = rest >> np.uint32(CHUNK_BITS)
        on = rest > 0
        bitmaps.append(np.packbits(on, bitorder="little").tobytes())
        ranks.append(np.concatenate([[0], np.cumsum(on)])[:-1:RANK_STEP].astype("<u4").tobytes())
        rest = rest[on]
    return levels, bitmaps, ranks


def decode(levels: list[bytes], bitmaps: list[bytes], n: int) -> np.ndarray:
    """All ids of a run."""
    ids = np.zeros(n, np.uint32)
    live = np.arange(n)
    for k, (level, bitmap) in enumerate(zip(levels, bitmaps, strict=True)):
        chunk = np.frombuffer(level, np.uint8).astype(np.uint32)
        ids[live] |= chunk << np.uint32(CHUNK_BITS * k)
        live = live[np.unpackbits(np.frombuffer(bitmap, np.uint8), count=len(chunk), bitorder="little").astype(bool)]
    return ids


def token_at(levels: list[bytes], bitmaps: list[bytes], ranks: list[bytes], place: int) -> int:
    """One id, by following its chunks through the directories."""
    out = 0
    for k, level in enumerate(levels):
        out |= level[place] << (CHUNK_BITS * k)
        if not bitmaps[k][place >> 3] >> (place & 7) & 1:
            return out
        step = place // RANK_STEP
        ones = int(np.frombuffer(ranks[k], "<u4", 1, 4 * step)[0])
        first = step * RANK_STEP // 8
        whole = np.frombuffer(bitmaps[k], np.uint8, (place >> 3) - first, first)
        ones += int(np.bitwise_count(whole).sum())
        place = ones + (bitmaps[k][place >> 3] & ((1 << (place & 7)) - 1)).bit_count()
    return out


class _WordIds:
    """Ids of words this process has seen, flat, with their places. White space only separates in these
    vocabularies, so a text's ids are those of its words. Words and the pieces they are made of are forgotten
    apart, each when its memory is full: pieces are only looked up for words that are new."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallel part
        self.tokenizer = Tokenizer.from_file(path)
        tokens = self.tokenizer.get_added_tokens_decoder()
        self.marks = [t.content for t in tokens.values()]
        self.separator = next(((t.content, i) for i, t in tokens.items() if t.special and t.content.split() == [t.content]), None)
        # A cheap test for words that may hold a special token.
        self.suspect = re.compile("[" + re.escape("".join({m[0] for m in self.marks} | {"\0"})) + "]").search
        # Vocabularies that mark the ends of words tell where each of many words stops.
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([str(self.tokenizer.id_to_token(i)).endswith(WORD_END) for i in range(size)], bool)
        self.marks_ends = bool(self.ends.any())
        self.letters: dict[str, bool] = {}
        self._forget_words()
        self._forget_pieces()

    def _forget_words(self) -> None:
        self.slots = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget_pieces(self) -> None:
        self.pieces = {"": 0}
        self.piece_flat, self.piece_starts, self.piece_sizes = np.zeros(0, np.uint32), np.zeros(1, np.int64), np.zeros(1, np.int64)

    @classmethod
    def of_process(cls, path: str) -> _WordIds:
        """The one of this worker process: later tasks find the words of earlier ones."""
        held = sys.modules.setdefault(MEMORY, types.ModuleType(MEMORY)).__dict__
        if path not in held:
            held[path] = cls(path)
        return held[path]

    def _split(self, words: pa.Array) -> pa.Array:
        """The stem of each word and, after it, the signs at its end, which every vocabulary here encodes apart.

        Words that may hold a special token and those whose stem does not end in a letter stay whole.
        """
        suspect = self._suspects(words)
        lower = pc.if_else(pc.and_not(pc.string_is_ascii(words), suspect), pc.ascii_lower(words), words)
        stems = pc.ascii_rtrim(lower, characters=SIGNS)
        last = pc.utf8_slice_codeunits(stems, -1).dictionary_encode()
        for sign in last.dictionary.to_pylist():
            if sign not in self.letters:
                self.letters[sign] = self._stays_letter(sign)
        letter = np.array([self.letters[sign] for sign in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
        sizes = pc.binary_length(lower).to_numpy().astype(np.int64)
        kept = np.where(letter & ~suspect.to_numpy(zero_copy_only=False), pc.binary_length(stems).to_numpy(), sizes)
        # Both parts of a word stand side by side in its bytes.
        ends = np.cumsum(sizes)
        offsets = np.zeros(2 * len(sizes) + 1, np.int64)
        offsets[1::2] = ends - sizes + kept
        offsets[2::2] = ends
        joined = pc.binary_join(pa.LargeListArray.from_arrays([0, len(lower)], lower), "")
        return pa.LargeStringArray.from_buffers(2 * len(sizes), pa.py_buffer(offsets), joined.buffers()[2])

    def _suspects(self, words: pa.Array) -> pa.Array:
        """Which words may hold a special token."""
        first = sorted({m[0] for m in self.marks} | {"\0"})
        return functools.reduce(pc.or_, [pc.match_substring(words, sign) for sign in first])

    @staticmethod
    def _stays_letter(sign: str) -> bool:
        """Whether a sign still ends in a letter when normalised and lower-cased: a mark at its end would join what follows."""
        forms = (sign, unicodedata.normalize("NFC", sign), unicodedata.normalize("NFC", sign).lower(), unicodedata.normalize("NFKC", sign).lower())
        return all(form and form[-1].isalpha() for form in forms)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and the number of each.

        Many go in one text: words of letters with a space between them, others with a special token, which
        splits a text before anything else looks at it. Pieces that may hold a special token go alone.
        """
        sizes, parts, order = np.zeros(len(pieces), np.int64), [], []
        lone = np.zeros(len(pieces), bool) if self.separator else np.ones(len(pieces), bool)
        if self.suspect("".join(pieces)):
            lone |= np.fromiter(map(bool, map(self.suspect, pieces)), bool, len(pieces))
        lettered = np.fromiter(map(str.isalpha, pieces), bool, len(pieces)) & ~lone & self.marks_ends
        letters, joint, alone = (np.flatnonzero(x).tolist() for x in (lettered, ~lettered & ~lone, lone))
        for start in range(0, len(letters), PIECES_PER_TEXT):
            # A piece of letters is one word of the vocabulary's own split: it stops where a word ends.
            group = letters[start : start + PIECES_PER_TEXT]
            ids = self._ids(" ".join([pieces[i] for i in group]))
            ends = np.flatnonzero(self.ends[ids])
            if len(ends) != len(group) or ends[-1] != len(ids) - 1:
                joint += group
                continue
            sizes[group] = np.diff(np.concatenate([[-1], ends]))
            parts.append(ids)
            order += group
        for start in range(0, len(joint), PIECES_PER_TEXT):
            group = joint[start : start + PIECES_PER_TEXT]
            ids = self._ids(self.separator[0].join([pieces[i] for i in group]))
            cuts = np.flatnonzero(ids == self.separator[1])
            sizes[group] = np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1
            parts.append(np.delete(ids, cuts))
            order += group
        for i in alone:
            ids = self._ids(pieces[i])
            sizes[i] = len(ids)
            parts.append(ids)
            order.append(i)
        # The parts stand in the order of encoding; each piece's place among them, piece by piece.
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        begin = np.zeros(len(pieces), np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return _gathered(flat, begin, sizes), sizes

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _add(self, words: pa.Array, names: list[str]) -> None:
        coded = self._split(words).dictionary_encode()
        used = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.pieces.get, used, repeat(-1)), np.int64, len(used))
        missed = np.flatnonzero(places < 0)
        if len(self.pieces) + len(missed) > KNOWN_PIECES:
            self._forget_pieces()
            missed = np.array([k for k, p in enumerate(used) if p], np.int64)
            places[:] = 0
        if len(missed):
            new = [used[k] for k in missed.tolist()]
            ids, sizes = self._encode(new)
            places[missed] = np.arange(len(self.piece_sizes), len(self.piece_sizes) + len(new))
            self.pieces.update(zip(new, places[missed].tolist(), strict=True))
            self.piece_starts = np.concatenate([self.piece_starts, len(self.piece_flat) + np.cumsum(sizes) - sizes])
            self.piece_sizes = np.concatenate([self.piece_sizes, sizes])
            self.piece_flat = np.concatenate([self.piece_flat, ids])
        places = places[coded.indices.to_numpy()]
        ids = _gathered(self.piece_flat, self.piece_starts[places], self.piece_sizes[places])
        sizes = self.piece_sizes[places].reshape(-1, 2).sum(1)
        self.slots.update(zip(names, range(len(self.sizes), len(self.sizes) + len(names)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, ids])

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's ids."""
        lists = pc.ascii_split_whitespace(texts)
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        slot = np.fromiter(map(self.slots.get, distinct, repeat(-1)), np.int64, len(distinct))
        missed = np.flatnonzero(slot < 0)
        if len(self.slots) + len(missed) > KNOWN_WORDS:
            self._forget_words()
            missed = np.arange(len(distinct))
        if len(missed):
            slot[missed] = np.arange(len(self.sizes), len(self.sizes) + len(missed))
            self._add(words.dictionary.take(pa.array(missed)), [distinct[k] for k in missed.tolist()])
        slot = slot[words.indices.to_numpy(zero_copy_only=False)]
        sizes = self.sizes[slot]
        ids = _gathered(self.flat, self.starts[slot], sizes)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), dtype=np.int64)
        return ids, np.diff(upto[ends], prepend=0)


def _gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    return flat[np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(int(sizes.sum()))]


def _with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """The end id after every document's ids."""
    ends = np.cumsum(sizes + 1)
    out = np.full(int(ends[-1]), end_id, np.uint32)
    inner = np.ones(len(out), bool)
    inner[ends - 1] = False
    out[inner] = ids
    return out


def _runs(path: str, end_id: int):
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = _WordIds.of_process(path), 0
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            start = 0
            while start < batch.num_rows:
                fit = int(np.searchsorted(np.cumsum(lengths[start:]), TEXT_BYTES_PER_RUN, side="right"))
                part = batch.slice(start, max(1, fit))
                start += part.num_rows
                ids, sizes = known.of(part.column("text"))
                coded = encode(_with_end(ids, sizes, end_id))
                columns = [part.column("part")[0].as_py(), number, len(ids) + len(sizes), part.column("id").to_pylist(), sizes + 1, *coded]
                number += 1
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], t) for c, t in zip(columns, RUN_TYPES, strict=True)], names=[n for n, _ in RUN_FIELDS]
                )

    return runs


def write_tokens(docs: DataFrame, tokenizer_path: str, folder: str, id_column: str = "doc_id", text_column: str = "text", end_id: int = END_ID) -> None:
    """Encode every whole text and write the runs to ``folder`` in ascending order of the id.

    Null ids come first; rows of one id follow each other by a hash of their text. A null text is empty and
    has the end id only. The runs of a part are numbered; parts and runs follow the order of the ids.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    dealt.select("part", "id", "text").mapInArrow(_runs(tokenizer_path, end_id), RUN_SCHEMA).write.option("compression", "zstd").parquet(folder)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            ids = decode(r["levels"], r["bitmaps"], r["n_tokens"]).astype("<u4")
            ends = np.cumsum(r["doc_tokens"])
            starts = ends - r["doc_tokens"]
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ends), r["part"], np.int64)),
                    pa.array(np.full(len(ends), r["run"], np.int64)),
                    pa.array(r["doc_ids"], pa.int64()),
                    pa.array(starts),
                    pa.array(np.array(r["doc_tokens"], np.int64)),
                    pa.array(sums, pa.int64()),
                ],
                names=["part", "run", "id", "inside", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    runs = spark.read.parquet(folder)
    ahead = running(runs.select("part", "run", "n_tokens"), [], "part", ["run"], {"n_tokens": "upto"})
    ahead = ahead.select("part", "run", (F.col("upto") - F.col("n_tokens")).alias("before"))
    docs = runs.mapInArrow(_documents, "part bigint, run bigint, id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint")
    return docs.join(ahead, ["part", "run"]).select("id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def read_token(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """(place, token) for each global token place asked for; only the runs that hold one are sent and touched."""
    runs = spark.read.parquet(folder)
    ahead = running(runs.select("part", "run", "n_tokens"), [], "part", ["run"], {"n_tokens": "upto"})
    span = ahead.select("part", "run", (F.col("upto") - F.col("n_tokens")).alias("before"), "upto")
    asked = span.join(places.select("place"), (F.col("place") >= F.col("before")) & (F.col("place") < F.col("upto")))
    wanted = asked.groupBy("part", "run").agg(F.collect_list("place").alias("places"), F.first("before").alias("before"))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                tokens = [token_at(r["levels"], r["bitmaps"], r["ranks"], p - r["before"]) for p in r["places"]]
                yield pa.RecordBatch.from_arrays([pa.array(r["places"], pa.int64()), pa.array(tokens, pa.int64())], names=["place", "token"])

    return runs.join(wanted, ["part", "run"]).mapInArrow(look, "place bigint, token bigint")


def token_documents(docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Writes the token files to a fresh folder and returns what ``read_documents`` finds in them."""
    folder = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, folder, id_column, text_column)
    return read_documents(docs.sparkSession, folder).withColumnRenamed("id", id_column)
