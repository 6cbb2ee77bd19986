"""Cheapest repair of conversations whose turns are blank, repeated, cut short, missing or in the wrong order.

The role initials of a repaired conversation read ``(s?(ua)+)?``. A turn moves between four states (nothing yet, after
a system turn, after the user, after the assistant), so its cheapest edits are a min-plus matrix of four by four
and a stretch of turns is the product of its turns' matrices. Turns of one role and fault are one symbol; a run of
equal symbols is a power of its matrix, put together from cached binary powers. Costs to go are carried from the end over
the runs; the choices are then unrolled from the front, the least letter that keeps the cost first.

Turns are dealt by conversation, turn, role and text in ranges, so a conversation of any length spreads over tasks. Stretches
of bounded size are reduced to their matrices; only these meet in one place, and every stretch is unrolled on its own.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- Fixed values -----------------------------------------------------------
WHITE = " \t\n\v\f\r"
ENDS = ".!?"
LEGAL = {"su", "ua", "au"}  # initials that may follow each other
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
# ----------------------------------------------------------------------------
TURNS_PER_STRETCH, SIGNS_PER_STRETCH = 4096, 1 << 20
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # what an inserted or reroled turn becomes
NAMES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
MUST_GO = "x"  # symbol of blank and repeated turns; others have their initial, or "o", in capitals if cut short
FAR = 1 << 40
Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def own_moves(symbol: str, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, state after) of the edits of one turn in a state."""
    moves = [("D", DELETE, state)]
    if symbol != MUST_GO:
        extra = CUT if symbol.isupper() else 0
        role = INITIALS.get(symbol.lower())
        if role == NEXT[state] or role == SYSTEM and state == EMPTY:
            moves.append(("K", extra, role))
        moves.append(("R", REROLE + extra, NEXT[state]))
    return moves


def product(left: Matrix, right: Matrix) -> Matrix:
    return tuple(tuple(min(row[k] + right[k][j] for k in range(STATES)) for j in range(STATES)) for row in left)


def applied(matrix: Matrix, costs: Vector) -> Vector:
    """Costs to go before a stretch from those after it."""
    return tuple(min(row[k] + costs[k] for k in range(STATES)) for row in matrix)


def _inserts() -> Matrix:
    """Cheapest inserts from state to state."""
    out = [[0 if i == j else FAR for j in range(STATES)] for i in range(STATES)]
    for i in range(STATES):
        state, cost = i, 0
        for _ in range(STATES):
            state, cost = NEXT[state], cost + INSERT
            out[i][state] = min(out[i][state], cost)
    return tuple(map(tuple, out))


IDENTITY: Matrix = tuple(tuple(0 if i == j else FAR for j in range(STATES)) for i in range(STATES))
# What a whole conversation may end in, inserts after its last turn included.
END: Vector = applied(_inserts(), tuple(0 if s in (EMPTY, ASSISTANT) else FAR for s in range(STATES)))
_powers: dict[tuple[str, int], Matrix] = {}
_steps: dict[tuple[str, Vector], Vector] = {}
_choices: dict[tuple[str, int, Vector], tuple[str, int]] = {}


def power(symbol: str, exponent: int) -> Matrix:
    """The matrix of 2 ** exponent turns of one symbol, inserts before each turn included."""
    found = _powers.get((symbol, exponent))
    if found is None:
        if exponent:
            half = power(symbol, exponent - 1)
            found = product(half, half)
        else:
            own = [[FAR] * STATES for _ in range(STATES)]
            for state in range(STATES):
                for _, cost, after in own_moves(symbol, state):
                    own[state][after] = min(own[state][after], cost)
            found = product(_inserts(), tuple(map(tuple, own)))
        found = _powers[symbol, exponent] = tuple(tuple(min(c, FAR) for c in row) for row in found)
    return found


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", symbols)]


def stretch_matrix(symbols: str) -> Matrix:
    """The product of all turns' matrices, run by run."""
    out = IDENTITY
    for symbol, length in runs(symbols):
        for exponent in range(length.bit_length()):
            if length >> exponent & 1:
                out = product(out, power(symbol, exponent))
    return tuple(tuple(min(c, FAR) for c in row) for row in out)


def _before_run(symbol: str, length: int, costs: Vector) -> Vector:
    for exponent in range(length.bit_length()):
        if length >> exponent & 1:
            costs = applied(power(symbol, exponent), costs)
    return costs


def _relative(costs: Vector) -> Vector:
    """Costs above the least: all that choices depend on, and few different ones."""
    least = min(costs)
    return tuple(min(c - least, FAR) for c in costs)


def _step(symbol: str, costs: Vector) -> Vector:
    """Relative costs to go before one turn."""
    found = _steps.get((symbol, costs))
    if found is None:
        found = _steps[symbol, costs] = _relative(applied(power(symbol, 0), costs))
    return found


def _choice(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    """The letters of one turn, inserts before it and its own, and the state after it."""
    found = _choices.get((symbol, state, after))
    if found is None:
        letters, place = "", state
        while True:
            before = applied(power(symbol, 0), after)[place]
            options = [(letter, cost + after[to], to) for letter, cost, to in own_moves(symbol, place)]
            options.append(("I", INSERT + applied(power(symbol, 0), after)[NEXT[place]], NEXT[place]))
            letter, _, place = min(o for o in options if o[1] == before)
            letters += letter
            if letter != "I":
                break
        found = _choices[symbol, state, after] = letters, place
    return found


def unrolled(symbols: str, state: int, after: Vector, last: bool) -> list[str]:
    """The letters of every turn of a stretch and, at the end of a conversation, one more entry for inserts."""
    parts = runs(symbols)
    ends = [_relative(after)]
    for symbol, length in reversed(parts):
        ends.append(_relative(_before_run(symbol, length, ends[-1])))
    ends.pop()
    out = []
    for (symbol, length), costs in zip(parts, reversed(ends), strict=True):
        behind = [costs]
        for _ in range(length - 1):
            behind.append(_step(symbol, behind[-1]))
        for costs in reversed(behind):
            letters, state = _choice(symbol, state, costs)
            out.append(letters)
    if last:
        letters = ""
        while state not in (EMPTY, ASSISTANT):
            letters, state = letters + "I", NEXT[state]
        out.append(letters)
    return out


def edited(roles: list[str], texts: list[str], edits: list[str], state: int) -> tuple[list[str], list[str], int]:
    """Roles and texts that the edits leave, and the state after them."""
    out_roles, out_texts = [], []
    for i, letters in enumerate(edits):
        for letter in letters:
            if letter == "D":
                continue
            if letter == "K":
                out_roles.append(roles[i])
                state = INITIALS[roles[i][:1]]
            else:
                state = NEXT[state]
                out_roles.append(NAMES[state])
            out_texts.append("" if letter == "I" else texts[i])
    return out_roles, out_texts, state


class _Stretch:
    """Consecutive turns of one conversation, as they are read."""

    def __init__(self, conv, number: int, opens: bool):
        self.conv, self.number, self.opens = conv, number, opens
        self.turns, self.roles, self.texts, self.symbols = [], [], [], []
        self.blank = self.duplicate = self.truncated = self.signs = 0

    def add(self, turn: int | None, role: str, text: str, repeated: bool) -> None:
        end = text.rstrip(WHITE)[-1:]
        initial = role[:1] if role[:1] in INITIALS else "o"
        if not end:
            self.blank += 1
            symbol = MUST_GO
        elif repeated:
            self.duplicate += 1
            symbol = MUST_GO
        elif end not in ENDS:
            self.truncated += 1
            symbol = initial.upper()
        else:
            symbol = initial
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.symbols.append(symbol)
        self.signs += len(text)

    def full(self) -> bool:
        return len(self.turns) >= TURNS_PER_STRETCH or self.signs >= SIGNS_PER_STRETCH

    def row(self, part: int, whole: bool) -> list:
        known = [t for t in self.turns if t is not None]
        initials = [r[:1] for r in self.roles]
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        symbols = "".join(self.symbols)
        matrix = [] if whole else [c for row in stretch_matrix(symbols) for c in row]
        return [
            self.conv, part, self.number, whole, known[0] if known else None, known[-1] if known else None, len(set(known)), initials[0], initials[-1],
            self.blank, self.duplicate, self.truncated, illegal, symbols, matrix, self.roles, self.texts,
        ]


STRETCH = (
    "part bigint, number bigint, whole boolean, low bigint, high bigint, turns bigint, first string, last string, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, symbols string, matrix array<bigint>, roles array<string>, texts array<string>"
)
COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
REPAIRED = f"chunk struct<part: bigint, number: bigint>, low bigint, high bigint, turns bigint, {COUNTS}, edits string, roles array<string>, texts array<string>"
DIGEST = f"gaps bigint, {COUNTS}, audit string, repaired_sha256 string"


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


def _stretches(schema: pa.Schema):
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches of the sorted turns. One is whole if the task has turns of other conversations on both sides of it."""
        part = TaskContext.get().partitionId()
        held, fresh, inner, made, signs = None, None, False, [], 0
        for batch in batches:
            for conv, turn, role, one, two, is_turn, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held is None or held.conv != conv or held.full():
                    new = held is None or held.conv != conv
                    if held is not None:
                        made.append(held.row(part, new and inner and held.opens))
                        signs += held.signs
                    inner = inner if held is None or not new else True
                    held = _Stretch(conv, 0 if held is None else held.number + 1, new)
                key = (conv, turn, role, one, two)
                if is_turn:
                    held.add(turn, role, text, fresh != key)
                    fresh = None
                else:
                    fresh = key
                if len(made) >= 1024 or signs >= SIGNS_PER_STRETCH:
                    yield _batch(made, schema)
                    made, signs = [], 0
        if held is not None:
            made.append(held.row(part, False))
        if made:
            yield _batch(made, schema)

    return stretches


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each conversation, which stand together; the first column names it."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != held[0][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _backward(schema: pa.Schema):
    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Costs to go after every stretch, from the end of its conversation."""
        for stretches in _by_conversation(batches):
            rows, costs = [], END
            for _, part, number, flat in reversed(stretches):
                costs = _relative(costs)
                rows.append([part, number, list(costs), not rows])
                costs = applied(tuple(tuple(flat[STATES * i : STATES * (i + 1)]) for i in range(STATES)), costs)
            yield _batch(rows, schema)

    return backward


def _exits(schema: pa.Schema):
    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state that a stretch's least letters lead to, from each state before it."""
        for batch in batches:
            rows = []
            for part, number, symbols, costs in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = []
                for state in range(STATES):
                    place = state
                    for letters, symbol in zip(unrolled(symbols, state, tuple(costs), False), symbols, strict=True):
                        place = _after(symbol, letters, place)
                    ends.append(place)
                rows.append([part, number, ends])
            yield _batch(rows, schema)

    return exits


def _after(symbol: str, letters: str, state: int) -> int:
    for letter in letters:
        if letter == "K":
            state = INITIALS[symbol.lower()]
        elif letter != "D":
            state = NEXT[state]
    return state


def _forward(schema: pa.Schema):
    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """State before every stretch, and what it shares with the one before: a turn number, an illegal border."""
        for stretches in _by_conversation(batches):
            rows, state, high, last = [], EMPTY, None, None
            for _, part, number, low, top, first, final, ends in stretches:
                shared = int(low is not None and low == high)
                rows.append([part, number, state, shared, int(last is not None and last + first not in LEGAL)])
                state, last = ends[state], final
                high = high if top is None else top
            yield _batch(rows, schema)

    return forward


def _repaired(schema: pa.Schema):
    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                # A stretch at a time: its texts are of bounded size.
                conv, part, number, low, high, turns, blank, duplicate, truncated, illegal, symbols, roles, texts, state, costs, last = (
                    c[i].as_py() for c in batch.columns
                )
                edits = unrolled(symbols, state, tuple(costs), last)
                cost = 0
                for letters, symbol in zip(edits, symbols + "." * last, strict=True):
                    extra = CUT if symbol.isupper() else 0
                    for letter in letters:
                        cost += {"K": extra, "R": REROLE + extra, "D": DELETE, "I": INSERT}[letter]
                new_roles, new_texts, _ = edited(roles, texts, edits, state)
                chunk = {"part": part, "number": number}
                yield _batch([[conv, chunk, low, high, turns, blank, duplicate, truncated, illegal, cost, "".join(edits), new_roles, new_texts]], schema)

    return repair


def _digests(schema: pa.Schema):
    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row of every conversation; its texts pass by chunk by chunk."""
        made: list[list] = []
        state: list | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                conv, low, high, turns, *counts, edits, roles, texts = (c[i].as_py() for c in batch.columns)
                if state is None or state[0] != conv:
                    if state is not None:
                        made.append(_digest(state))
                    state = [conv, None, None, 0, [0] * len(counts), [], hashlib.sha256(), False]
                if edits is None:  # a conversation's own name, for those without any turn left
                    continue
                state[1] = low if state[1] is None else state[1]
                state[2] = state[2] if high is None else high
                state[3] += turns
                state[4] = [a + b for a, b in zip(state[4], counts, strict=True)]
                state[5].append(edits)
                for role, text in zip(roles, texts, strict=True):
                    state[6].update(f"{chr(10) * state[7]}{role}:{text}".encode())
                    state[7] = True
            if len(made) >= 1024:
                yield _batch(made, schema)
                made = []
        if state is not None:
            made.append(_digest(state))
        if made:
            yield _batch(made, schema)

    return digests


def _digest(state: list) -> list:
    conv, low, high, turns, counts, edits, hashed, _ = state
    return [conv, 0 if low is None else high - low + 1 - turns, *counts, "".join(edits), hashed.hexdigest()]


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _mapped(df: DataFrame, make, fields: str, key: str | None = None) -> DataFrame:
    """``df`` through a function on Arrow batches that is told its result's schema; ``key`` names a first column to keep."""
    spark = df.sparkSession
    schema = spark.createDataFrame([], fields).schema
    if key:
        schema = type(schema)([df.schema[key], *schema.fields])
    return df.mapInArrow(make(_arrow(schema)), schema)


def repaired_chunks(
    conversations: DataFrame, conv_column: str = "conv_id", turn_column: str = "turn", role_column: str = "role", text_column: str = "text"
) -> DataFrame:
    """The cheapest repair of every conversation, in chunks of bounded size.

    One row a chunk: the conversation; ``chunk``, by which its chunks are ordered; the least and greatest turn number;
    ``turns``, how many distinct ones begin here; the numbers of blank, repeated and cut turns and of illegal
    neighbours; the cost and the letters of the edits; roles and texts after them. Sums over a conversation's chunks are
    its totals.

    Turns are taken by number, null first; turns of one number by role and a hash of the text, so equal rows are
    neighbours and the later ones repeats. A null role or text counts as one space, an empty role as an illegal one. Turns of a
    null conversation are one conversation. Other columns are ignored, whatever their names; no turns, no rows.
    """
    blank = F.lit(" ")
    role, text = F.coalesce(F.col(f"`{role_column}`"), blank), F.coalesce(F.col(f"`{text_column}`"), blank)
    hashes = [F.xxhash64(role, text).alias("one"), F.xxhash64(F.lit("second"), text, role).alias("two")]
    turns = conversations.select(
        F.col(f"`{conv_column}`").alias("conv"), F.col(f"`{turn_column}`").cast("long").alias("turn"), role.alias("role"), *hashes, F.lit(True).alias("is_turn"), text.alias("text")
    )
    # A mark stands right before the first of equal turns of a conversation: they meet by sorting, not by a join.
    first = turns.groupBy("conv", "role", "one", "two").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    marks = first.select("conv", F.col("first.turn").alias("turn"), "role", "one", "two", F.lit(False).alias("is_turn"), F.lit(None).cast("string").alias("text"))
    order = ["conv", "turn", "role", "one", "two"]
    dealt = turns.union(marks).repartitionByRange(*order).sortWithinPartitions(*order, "is_turn")
    stretches = written(_mapped(dealt, _stretches, STRETCH, "conv"), "stretches")

    def in_order(df: DataFrame) -> DataFrame:
        return df.repartition("conv").sortWithinPartitions("conv", "part", "number")

    rest = stretches.filter("NOT whole")
    back = _mapped(in_order(rest.select("conv", "part", "number", "matrix")), _backward, "part bigint, number bigint, costs array<bigint>, ends boolean")
    back = written(back, "backward")
    exits = _mapped(rest.select("part", "number", "symbols").join(back.drop("ends"), ["part", "number"]), _exits, "part bigint, number bigint, exits array<int>")
    seen = rest.select("conv", "part", "number", "low", "high", "first", "last").join(exits, ["part", "number"])
    ahead = _mapped(in_order(seen.select("conv", "part", "number", "low", "high", "first", "last", "exits")), _forward, "part bigint, number bigint, state int, shared bigint, clash bigint")
    linked = rest.join(back, ["part", "number"]).join(ahead, ["part", "number"])
    start = [F.lit(EMPTY).alias("state"), F.array(*[F.lit(c).cast("long") for c in END]).alias("costs"), F.lit(True).alias("ends"), F.lit(0).cast("long").alias("shared"), F.lit(0).cast("long").alias("clash")]
    whole = stretches.filter("whole").select("*", *start)
    columns = ["conv", "part", "number", "low", "high", (F.col("turns") - F.col("shared")).alias("turns"), "blank", "duplicate", "truncated"]
    columns += [(F.col("illegal") + F.col("clash")).alias("illegal"), "symbols", "roles", "texts", "state", "costs", "ends"]
    chunks = _mapped(whole.select(*columns).union(linked.select(*columns)), _repaired, REPAIRED, "conv")
    return chunks.withColumnRenamed("conv", conv_column)


def conversation_digests(chunks: DataFrame, names: DataFrame, conv_column: str = "conv_id") -> DataFrame:
    """One row for every conversation in ``names``: gaps, counts, cost, all letters, and the hash of ``role:text`` lines.

    Those without a chunk have zeros, no letters and the hash of nothing. The hash runs over a conversation from front to end,
    so one task reads its chunks one after the other; it holds one chunk and the letters.
    """
    fields = ["low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "edits", "roles", "texts"]
    own = names.select(F.col(f"`{conv_column}`").alias("conv")).distinct()
    empty = own.select("conv", F.lit(None).cast(chunks.schema["chunk"].dataType).alias("chunk"), *[F.lit(None).cast(chunks.schema[f].dataType).alias(f) for f in fields])
    rows = chunks.select(F.col(f"`{conv_column}`").alias("conv"), "chunk", *fields).union(empty)
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "chunk").drop("chunk")
    return _mapped(dealt, _digests, DIGEST, "conv").withColumnRenamed("conv", conv_column)
