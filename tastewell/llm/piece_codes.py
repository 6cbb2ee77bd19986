"""Exact encoding with a piece vocabulary whose pieces arise by merging, without running the merges over the text.

A sequence of pieces is the merged form of a text exactly if every two neighbours are the merged form of the two
strings side by side: the first merge across a border would happen in the pair alone as well. So a text is walked
from its front with the longest piece that begins at each place, found by an Aho-Corasick automaton, and a piece is
taken if merging it anew with the one before leaves both as they are. Where no piece fits, the place is marked in a
bitfield as failed, the last piece is given back and the next shorter one tried; no place fails twice, so the walk
takes a number of steps linear in the text. Short stretches take this walk side by side, one step of all at a time.
"""

from __future__ import annotations

import math
import re
import sys
import types
from collections import Counter
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"  # the vocabulary's sign for a space
SPACE_BYTES = SPACE.encode()
CHARS_PER_STEP = 1 << 20
IDS_PER_STEP = 1 << 18
LONGEST_KNOWN_UNIT = 64
KNOWN_UNITS = 170_000
KNOWN_PAIRS = 1 << 20  # a power of two
KNOWN_LONE_PAIRS = 1 << 16
COMMON_SIGNS = 255
UNITS_PER_WALK = 1 << 13
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())
MEMORY = "tastewell_piece_codes"


class Pieces:
    """The vocabulary of one model, and the units of text this process has encoded with it."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.model
        size = self.many = model.get_piece_size()
        self.byte_ids = {bytes.fromhex(model.id_to_piece(i)[3:5])[0]: i for i in range(size) if model.is_byte(i)}
        ordinary = [i for i in range(size) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.pieces = {i: model.id_to_piece(i) for i in ordinary}
        self.ids = {p: i for i, p in self.pieces.items()}
        self.scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.unknown = model.unk_id()
        # Pieces that merging never leaves behind cannot be in an encoding. The others' last merge joins two parts.
        self.parts: dict[str, tuple[str, str]] = {}
        self.reached = {i: len(p) for i, p in self.pieces.items() if len(p) == 1 or self.merged(p) == [p]}
        # Where parts are always merged before the whole, merges run in the order of their scores.
        self.ordered = all(
            all(len(part) == 1 or self.scores[part] > self.scores[p] for part in parts) for p, parts in self.parts.items() if SPACE * 2 not in p
        )
        self.ends = {i: self._spine(self.pieces[i], 1) for i in self.reached}
        self.fronts = {i: self._spine(self.pieces[i], 0) for i in self.reached}
        self.automaton = ahocorasick.Automaton()
        for i, length in self.reached.items():
            self.automaton.add_word(self.pieces[i], i)
        self.automaton.make_automaton()
        # The longest piece that is a proper prefix of each piece.
        self.shorter = {i: self._longest_prefix(self.pieces[i]) for i in self.reached}
        self.signs = {p for p in self.ids if len(p) == 1}
        self._build_trie()
        # The last place of each table stands for no piece.
        self.lengths, self.next_shorter = np.zeros(size + 1, np.int32), np.full(size + 1, -1, np.int32)
        for i, length in self.reached.items():
            self.lengths[i] = length
            self.next_shorter[i] = -1 if self.shorter[i] is None else self.shorter[i]
        # Pairs that were looked at, each in the place its number gives: a later one takes it over.
        self.pairs: dict[int, bool] = {}
        self.pair_keys = np.full(KNOWN_PAIRS, -1, np.int64)  # twice the pair, and one more if it fits
        self.byte_kinds = self._kinds_of_bytes()
        self._forget()

    def _build_trie(self) -> None:
        """The pieces of common signs as a table: the next node by node and sign, nodes that lead on first."""
        used = Counter(chain.from_iterable(self.pieces.values()))
        self.common = {sign for sign, _ in used.most_common(COMMON_SIGNS)} & self.signs
        self.border = next(c for c in map(chr, range(sys.maxunicode)) if c not in used)  # no piece reaches across it
        self.sign_class = np.zeros(sys.maxunicode + 1, np.uint8)  # 0 leads nowhere
        for number, sign in enumerate(sorted(self.common)):
            self.sign_class[ord(sign)] = number + 1
        spelt = {p: i for i in self.reached if self.common.issuperset(p := self.pieces[i])}
        prefixes = {p[:end] for p in spelt for end in range(len(p))}
        prefixes.discard("")
        nodes = ["", *sorted(prefixes), *(p for p in spelt if p not in prefixes)]
        number = {p: k for k, p in enumerate(nodes)}
        self.inner = 1 + len(prefixes)
        # No sign leads to the first node, so 0 stands for none.
        self.next_node = np.zeros((self.inner, len(self.common) + 1), np.min_scalar_type(len(nodes)))
        for p, k in number.items():
            if p:
                self.next_node[number[p[:-1]], self.sign_class[ord(p[-1])]] = k
        self.node_piece = np.array([spelt.get(p, -1) for p in nodes], np.int32)

    def _longest(self, text: str) -> np.ndarray:
        """The longest piece that begins at each place of a text of common signs and borders, -1 at the borders."""
        signs = self.sign_class[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        longest = np.full(len(text) + 1, -1, np.int32)
        place = np.flatnonzero(signs)
        signs = np.append(signs, 0)
        node, ahead = np.zeros(len(place), self.next_node.dtype), place
        while len(place):
            node = self.next_node[node, signs[ahead]]
            alive = np.flatnonzero(node)
            node, place, ahead = node[alive], place[alive], ahead[alive]
            piece = self.node_piece[node]
            full = np.flatnonzero(piece >= 0)
            longest[place[full]] = piece[full]
            on = np.flatnonzero(node < self.inner)
            node, place, ahead = node[on], place[on], ahead[on] + 1
        return longest

    @classmethod
    def of_process(cls, path: str) -> Pieces:
        """The one of this worker process: later tasks find the units of earlier ones."""
        held = sys.modules.setdefault(MEMORY, types.ModuleType(MEMORY)).__dict__
        if path not in held:
            held[path] = cls(path)
        return held[path]

    @staticmethod
    def model_of_process(path: str):
        """The library's model alone: decoding needs no vocabulary tables and no units."""
        import sentencepiece

        held = sys.modules.setdefault(MEMORY, types.ModuleType(MEMORY)).__dict__
        if path in held:
            return held[path].model
        name = f"model {path}"
        if name not in held:
            held[name] = sentencepiece.SentencePieceProcessor(model_file=path)
        return held[name]

    def _longest_prefix(self, piece: str) -> int | None:
        for end in range(len(piece) - 1, 0, -1):
            i = self.ids.get(piece[:end])
            if i in self.reached:
                return i
        return None

    def _kinds_of_bytes(self) -> np.ndarray | None:
        """What a byte is part of: 0 a word, 1 a mark that some piece joins to the word before it, 2 another mark, 3 a sign
        without a piece. None if pieces reach across spaces."""
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            return None
        joined = {p[k] for p in self.ids for k in range(1, len(p)) if p[k] in MARKS and p[k - 1] not in MARKS + SPACE}
        kinds = np.zeros(256, np.uint8)
        for sign in map(chr, range(128)):
            kinds[ord(sign)] = 3 if sign not in self.signs else 0 if sign not in MARKS else 1 if sign in joined else 2
        return kinds

    def _units(self, stretches: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The units of stretches of normalised text, none of them empty, and the number of each stretch's units.

        Pieces never reach across the place before a space that follows something else, the one between a word and a mark
        that no piece joins to the words before it, and the two ends of a sign without a piece.
        """
        held = pa.array(stretches, pa.large_string())
        offsets = np.frombuffer(held.buffers()[1], np.int64)[: len(held) + 1]
        if self.byte_kinds is None:
            return held, np.ones(len(held), np.int64)
        data = np.frombuffer(held.buffers()[2], np.uint8)[: offsets[-1]]
        kinds = self.byte_kinds[data]
        space = np.zeros(len(data), bool)
        first, second, third = SPACE_BYTES
        space[:-2] = (data[:-2] == first) & (data[1:-1] == second) & (data[2:] == third)
        border = kinds == 2
        border[1:] &= kinds[:-1] == 0
        border |= space
        border[3:] &= ~space[:-3]  # neither spaces nor marks leave a space before them
        alone = kinds == 3
        border |= alone
        border[1:] |= alone[:-1]
        border[offsets[:-1]] = True
        starts = np.flatnonzero(border)
        ends = np.append(starts, len(data))
        units = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends), held.buffers()[2])
        return units, np.diff(np.searchsorted(ends, offsets))

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.flat, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merged(self, text: str) -> list[str]:
        """The merged form of a short text by its definition: the best pair first, the leftmost of equal ones."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, place = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, place = score, k
            if best is None:
                break
            if len(parts) == 2:
                self.parts[text] = tuple(parts)
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts

    def _spine(self, piece: str, side: int) -> list[tuple[str, float, float]]:
        """The parts at one end of a piece, itself first: each with the scores of the merges that make and consume it."""
        out, consumed = [], -math.inf
        while piece:
            out.append((piece, self.scores[piece] if len(piece) > 1 else math.inf, consumed))
            consumed = out[-1][1]
            parts = self.parts.get(piece)
            piece = parts[side] if parts else ""
        return out

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the two pieces' strings anew gives the two pieces.

        It does unless a part at the end of the left one and a part at the front of the right one, both there at
        the same time, merge before either is consumed. Of equal scores the one further left comes first.
        """
        if self.ordered and SPACE * 2 not in self.pieces[left] + self.pieces[right]:
            scores = self.scores
            for x, made_x, gone_x in self.ends[left]:
                for y, made_y, gone_y in self.fronts[right]:
                    score = scores.get(x + y)
                    if score is not None:
                        moment = min(score, made_x, made_y)
                        if moment > gone_x and moment >= gone_y:
                            return False
            return True
        a, b = self.pieces[left], self.pieces[right]
        return self.merged(a + b) == [a, b]

    def _all_compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``compatible`` for many pairs."""
        keys = left.astype(np.int64) * self.many + right
        places = (keys * 0x9E3779B1 >> 16) & (len(self.pair_keys) - 1)
        held = self.pair_keys[places]
        fits = (held & 1).astype(bool)
        missed = np.flatnonzero(held >> 1 != keys)
        if len(missed):
            new, back = np.unique(keys[missed], return_inverse=True)
            found = np.fromiter((self.compatible(*divmod(key, self.many)) for key in new.tolist()), bool, len(new))
            fits[missed] = found[back]
            self.pair_keys[(new * 0x9E3779B1 >> 16) & (len(self.pair_keys) - 1)] = 2 * new + found
        return fits

    def _walked(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units of common signs one after the other, and the number of each; no unit is empty.

        Every unit makes a step at a time: it takes its piece, tries a shorter one, or gives the last one back.
        """
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        text = self.border.join(units)
        starts = np.cumsum(sizes + 1) - sizes - 1
        longest = self._longest(text)
        failed = np.zeros(len(text) + 1, bool)
        taken = np.full(len(text) + 1, -1, np.int32)  # the pieces of each unit, from its start on
        counts = np.zeros(len(units), np.int64)
        who, place, tops, stops, first = np.arange(len(units)), starts.copy(), starts.copy(), starts + sizes, starts
        piece, last = longest[place], np.full(len(units), -1, np.int32)
        while len(who):
            some = piece >= 0
            end = place + self.lengths[piece]
            fits = some & ~failed[end]
            asked = np.flatnonzero(fits & (last >= 0))
            fits[asked] = self._all_compatible(last[asked], piece[asked])
            on = np.flatnonzero(fits)
            taken[tops[on]] = piece[on]
            tops[on] += 1
            place[on] = end[on]
            last[on] = piece[on]
            shorter = self.next_shorter[piece]
            back = np.flatnonzero(~some)
            if len(back):
                failed[place[back]] = True
                tops[back] -= 1
                given = taken[tops[back]]
                taken[tops[back]] = -1
                place[back] -= self.lengths[given]
                shorter[back] = self.next_shorter[given]
                last[back] = np.where(tops[back] > first[back], taken[tops[back] - 1], -1)
            shorter[on] = longest[place[on]]
            piece = shorter
            left = place < stops
            if not left.all():
                counts[who[~left]] = (tops - first)[~left]
                who, place, tops, stops, first, piece, last = (x[left] for x in (who, place, tops, stops, first, piece, last))
        return taken[taken >= 0], counts

    def _known_signs(self, text: str) -> list[int]:
        """Ids of a text whose signs all are pieces."""
        size = len(text)
        longest: list[int] = [0] * size
        reached, shorter = self.reached, self.shorter
        for end, i in self.automaton.iter(text):
            longest[end - reached[i] + 1] = i  # a later end is a longer piece
        pairs, many = self.pairs, self.many
        failed = bytearray(size // 8 + 1)
        out: list[int] = []
        place, piece, last = 0, longest[0], None
        while place < size:
            while piece is not None:
                end = place + reached[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if last is None:
                        break
                    fits = pairs.get(last * many + piece)
                    if fits is None:
                        if len(pairs) >= KNOWN_LONE_PAIRS:
                            pairs.clear()
                        fits = pairs[last * many + piece] = self.compatible(last, piece)
                    if fits:
                        break
                piece = shorter[piece]
            if piece is not None:
                out.append(piece)
                last, place = piece, end
                if end < size:
                    piece = longest[end]
            else:
                failed[place >> 3] |= 1 << (place & 7)
                piece = out.pop()
                place -= reached[piece]
                piece = shorter[piece]
                last = out[-1] if out else None
        return out

    def encode_unit(self, text: str) -> list[int]:
        """Ids of a stretch of normalised text; signs outside the vocabulary become their bytes."""
        if self.signs.issuperset(text):
            return self._known_signs(text)
        out: list[int] = []
        start = 0
        for place, sign in enumerate(text):
            if sign not in self.signs:
                if place > start:
                    out += self._known_signs(text[start:place])
                out += [self.byte_ids.get(b, self.unknown) for b in sign.encode()] if self.byte_ids else [self.unknown]
                start = place + 1
        if start < len(text):
            out += self._known_signs(text[start:] if start else text)
        return out

    def _stretches(self, text: str) -> Iterator[str]:
        """A normalised text, a bounded number of signs at a time where a border of units allows it."""
        start = 0
        while self.byte_kinds is not None and len(text) - start > CHARS_PER_STEP:
            border = re.compile(f"(?<!{SPACE}){SPACE}").search(text, start + CHARS_PER_STEP)
            if border is None:
                break
            yield text[start : border.start()]
            start = border.start()
        if start < len(text):
            yield text[start:]

    def _encode_new(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of short units one after the other, and the number of each, after the order that they stand in: those with rare
        signs come last."""
        plain = np.fromiter(map(self.common.issuperset, units), bool, len(units))
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        walkable = list(compress(units, plain))
        walks = [self._walked(walkable[k : k + UNITS_PER_WALK]) for k in range(0, len(walkable), UNITS_PER_WALK)]
        for k in order[len(walkable) :].tolist():
            ids = self.encode_unit(units[k])
            walks.append((np.array(ids, np.int32), np.array([len(ids)])))
        return order, *(np.concatenate(x) for x in zip(*walks, strict=True))

    def _encode_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after the other, and the number of each."""
        coded = units.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        slots = np.fromiter(map(self.slots.get, distinct, repeat(-1)), np.int64, len(distinct))
        missed = [k for k in np.flatnonzero(slots < 0).tolist() if len(distinct[k]) <= LONGEST_KNOWN_UNIT]
        if len(self.slots) + len(missed) > KNOWN_UNITS:
            self._forget()
            slots[:] = -1
            missed = [k for k, u in enumerate(distinct) if len(u) <= LONGEST_KNOWN_UNIT]
        if missed:
            order, found, lengths = self._encode_new([distinct[k] for k in missed])
            missed = np.array(missed)[order]
            slots[missed] = np.arange(len(self.sizes), len(self.sizes) + len(missed))
            self.slots.update(zip([distinct[k] for k in missed.tolist()], slots[missed].tolist(), strict=True))
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])
            self.sizes = np.concatenate([self.sizes, lengths])
            self.flat = np.concatenate([self.flat, found])
        # Units too long to be kept are encoded for this step only.
        long = np.flatnonzero(slots < 0)
        parts = [np.array(self.encode_unit(distinct[k]), np.int32) for k in long.tolist()]
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        slots[long] = len(self.sizes) + np.arange(len(long))
        starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(lengths) - lengths])[slots]
        sizes = np.concatenate([self.sizes, lengths])[slots]
        flat = np.concatenate([self.flat, *parts]) if parts else self.flat
        which = coded.indices.to_numpy(zero_copy_only=False)
        many = sizes[which]
        return flat[np.repeat(starts[which] - np.cumsum(many) + many, many) + np.arange(int(many.sum()))], many

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of each text's ids."""
        totals = np.zeros(len(texts), np.int64)
        parts: list[np.ndarray] = []
        stretches: list[str] = []
        owners: list[int] = []
        signs = 0

        def step() -> None:
            units, counts = self._units(stretches)
            ids, sizes = self._encode_units(units)
            np.add.at(totals, owners, np.add.reduceat(sizes, np.cumsum(counts) - counts))
            parts.append(ids)

        for number, text in enumerate(texts):
            for found in self._stretches(self.model.normalize(text)):
                stretches.append(found)
                owners.append(number)
                signs += len(found)
                if signs >= CHARS_PER_STEP:
                    step()
                    stretches, owners, signs = [], [], 0
        if stretches:
            step()
        return (np.concatenate(parts) if parts else np.zeros(0, np.int32)), totals


def _encoded(path: str):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The columns of a batch with the ids of its last one, in parts of bounded size."""
        pieces = Pieces.of_process(path)
        for batch in batches:
            lengths = pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(zero_copy_only=False)
            start = 0
            while start < batch.num_rows:
                fit = int(np.searchsorted(np.cumsum(lengths[start:]), CHARS_PER_STEP, side="right"))
                part = batch.slice(start, max(1, fit))
                start += part.num_rows
                ids, sizes = pieces.encode(part.column(part.num_columns - 1).to_pylist())
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))
                pa.default_memory_pool().release_unused()
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["__row", "__ids"])

    return encoded


def _decoded(path: str):
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Pieces.model_of_process(path)
        for batch in batches:
            lists = batch.column(1)
            start, texts, many = 0, [], 0
            for place in range(batch.num_rows):
                ids = lists[place].values
                # The library reads the numbers of an array where they stand.
                texts.append(model.decode(ids.to_numpy() if ids is not None else []))
                many += 0 if ids is None else len(ids)
                if many >= IDS_PER_STEP or place == batch.num_rows - 1:
                    rows = batch.column(0).slice(start, len(texts))
                    yield pa.RecordBatch.from_arrays([rows, pa.array(texts, pa.string())], names=["__row", "__text"])
                    start, texts, many = place + 1, [], 0

    return decoded


def encoded_texts(docs: DataFrame, model_path: str, text_column: str = "text", out: str = "ids") -> DataFrame:
    """The frame's other columns and ``out``, the ids of the whole text; the text column itself is left out.

    Without begin or end ids. Null texts are empty and have no ids; signs outside the vocabulary become the ids
    of their bytes. Rows come back as often as they came, whatever their other columns are called; a column
    named like ``out`` is replaced. The model is read by its path on every executor.
    """
    value = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rest = docs.withColumn(text_column, value)
    row = [F.col(f"`{c}`") for c in docs.columns if c not in (text_column, out)]
    sent = rest.select(F.struct(*(row or [F.lit(None).cast("int").alias("__none")])).alias("__row"), F.col(f"`{text_column}`").alias("__text"))
    made = sent.mapInArrow(_encoded(model_path), T.StructType([sent.schema["__row"], T.StructField("__ids", T.ArrayType(T.IntegerType()))]))
    return made.select(*([F.col("__row.*")] if row else []), F.col("__ids").alias(out))


def decoded_ids(df: DataFrame, model_path: str, ids_column: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with ``out``, the text that the model gives for the ids; null ids decode to the empty text."""
    row = [F.col(f"`{c}`") for c in df.columns if c != out]
    sent = df.select(F.struct(*row).alias("__row"), F.col(f"`{ids_column}`").cast("array<int>").alias("__ids"))
    made = sent.mapInArrow(_decoded(model_path), T.StructType([sent.schema["__row"], T.StructField("__text", T.StringType())]))
    return made.select("__row.*", F.col("__text").alias(out))
