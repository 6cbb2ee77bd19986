"""Repairs against a search over all edits, stretches against whole conversations, odd rows."""

import hashlib
import heapq
import random

import pytest

from tastewell.llm import conversations as cv

FINAL = (cv.EMPTY, cv.ASSISTANT)


def _faults(turns):
    seen, out = set(), []
    for _, role, text in turns:
        end = text.rstrip(cv.WHITE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _search(turns):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) by the cheapest path over all edits, least letters first."""
    turns = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in turns), key=lambda r: (r[0] is not None, r[0] or 0))
    faults = _faults(turns)
    heap, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(turns) and state in FINAL:
            break
        if (i, state) in done:
            continue
        done.add((i, state))
        after = {0: 2, 1: 2, 2: 3, 3: 2}[state]
        name = "user" if after == 2 else "assistant"
        heapq.heappush(heap, (cost + 5, audit + "I", i, after, (*out, f"{name}:")))
        if i < len(turns):
            _, role, text = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, out))
            if faults[i] not in ("blank", "duplicate"):
                cut = 5 if faults[i] else 0
                if role[:1] == name[0]:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, after, (*out, f"{role}:{text}")))
                if role[:1] == "s" and state == 0:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, 1, (*out, f"{role}:{text}")))
                heapq.heappush(heap, (cost + cut + 1, audit + "R", i + 1, after, (*out, f"{name}:{text}")))
    known = [t for t, _, _ in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def _conversation(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    texts = ["Yes.", "No!", "What?", "Cut", "", " \n", None, "Same."]
    turn, out = 0, []
    for _ in range(n):
        turn += rng.choice([1, 1, 1, 2])
        fresh = f"Text {rng.randrange(10**6)}" + rng.choice([".", "!", ". ", ""])
        out.append((None if rng.random() < 0.02 else turn, rng.choice(roles), rng.choice([fresh, fresh, rng.choice(texts)])))
    return out


def _got(spark, convs, partitions=3):
    rows = [(c, *t, "x", 1) for c, turns in convs.items() for t in turns]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string, number int").repartition(partitions)
    names = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    found = cv.conversation_digests(cv.repaired_chunks(df), names)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r[0]: tuple(r)[1:] for r in found.collect()}


def _one_order(turns):
    """Null turns have no order but the operator's own: at most one of them is left."""
    held, out = False, []
    for t in turns:
        if t[0] is None and held:
            continue
        held |= t[0] is None
        out.append(t)
    return out


@pytest.mark.parametrize("stretch", [4096, 7])
def test_against_a_search(spark, monkeypatch, stretch):
    monkeypatch.setattr(cv, "TURNS_PER_STRETCH", stretch)
    rng = random.Random(stretch)
    convs = {i: _one_order(_conversation(rng, rng.randint(1, 25))) for i in range(150)}
    convs |= {200: [], 201: [(1, "system", "Only.")], 202: [(None, None, None)], None: [(1, "user", "Hi."), (2, "assistant", "Ho.")]}
    # A third of all turns in one conversation, most of them one text.
    convs[203] = [(i, rng.choice(["user", "assistant"]), rng.choice(["Again.", "Again.", f"New {i}."])) for i in range(900)]
    convs[204] = [(i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(300)]
    got = _got(spark, convs)
    assert got == {c: _search(turns) for c, turns in convs.items()}
    assert got[200] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[204][6] == "K" * 300


def test_equal_rows_repeat(spark):
    turns = [(1, "user", "Hi."), (1, "user", "Hi."), (2, "assistant", "Ho."), (2, "assistant", "Ho."), (2, "assistant", "Ho.")]
    assert _got(spark, {1: turns})[1] == _search(turns)
    assert _got(spark, {1: turns})[1][6] == "KDKDD"


def test_long_texts_and_empty_tables(spark):
    turns = [(i, "user" if i % 2 else "assistant", f"{i} " * 200_000 + ".") for i in range(1, 8)]
    assert _got(spark, {1: turns, 2: [(1, "user", "Hi."), (2, "assistant", "Ho.")]})[1] == _search(turns)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    chunks = cv.repaired_chunks(empty)
    assert chunks.collect() == []
    assert cv.conversation_digests(chunks, empty).collect() == []


def test_runs_and_single_steps_agree():
    rng = random.Random(4)
    for _ in range(200):
        symbols = "".join(rng.choice("suaoxSUAO") * rng.randint(1, 12) for _ in range(rng.randint(1, 6)))
        single = cv.IDENTITY
        for symbol in symbols:
            single = cv.product(single, cv.power(symbol, 0))
        assert cv.applied(cv.stretch_matrix(symbols), cv.END) == cv.applied(single, cv.END)
    assert cv.runs("uuaax") == [("u", 2), ("a", 2), ("x", 1)]
