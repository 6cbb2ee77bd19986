"""Ids against the library's on planted, random and long texts; decoding; frames with odd rows."""

import random

import pytest

from tastewell.llm import piece_codes

sentencepiece = pytest.importorskip("sentencepiece")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return piece_codes.Pieces(PATH)


def _same(pieces, model, texts):
    ids, sizes = pieces.encode(texts)
    start = 0
    for text, size in zip(texts, sizes.tolist(), strict=True):
        assert ids[start : start + size].tolist() == model.encode(text), repr(text)
        start += size
    assert start == len(ids)


def test_random_texts(pieces, model):
    rng = random.Random(1)
    signs = "abcdetion sr  ▁\n\t.,!'()éèßİñ漢字あ한😀‍\x00\x01\x85　<>x0123"
    _same(pieces, model, ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(5000)])
    vocabulary = list(pieces.ids)
    _same(pieces, model, ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 8))) for _ in range(5000)])
    _same(pieces, model, [" " * n + "a" * m + " " * n for n in range(40) for m in (0, 1, 3)])


def test_long_texts(pieces, model, monkeypatch):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    texts = ["".join(rng.choice("abcdefgh") for _ in range(100_000)), "a" * 100_000, " " * 100_000, " ".join(words) + "  \n", "日" * 50_000]
    _same(pieces, model, texts)
    monkeypatch.setattr(piece_codes, "CHARS_PER_STEP", 64)
    _same(pieces, model, ["", *texts[2:4], "x", ""])


def test_memory_is_emptied(model, monkeypatch):
    monkeypatch.setattr(piece_codes, "KNOWN_UNITS", 10)
    monkeypatch.setattr(piece_codes, "KNOWN_PAIRS", 10)
    small = piece_codes.Pieces(PATH)
    for start in range(0, 200, 20):
        _same(small, model, [f"word number{n} and number{n - 1}." for n in range(start, start + 20)])


def test_pairs_against_merging(pieces):
    rng = random.Random(3)
    ids = list(pieces.reached)
    short = [i for i in ids if len(pieces.pieces[i]) <= 3]
    clashes = 0
    for group in (ids, short):
        for _ in range(20_000):
            left, right = rng.choice(group), rng.choice(group)
            a, b = pieces.pieces[left], pieces.pieces[right]
            clashes += not pieces.compatible(left, right)
            assert pieces.compatible(left, right) == (pieces.merged(a + b) == [a, b]), (a, b)
    assert clashes > 500


def test_frames(spark, model):
    texts = [(1, "Hello  world."), (1, "Hello  world."), (2, None), (None, ""), (3, "naïve 日本 \U0001f600\n"), (4, "long " * 4000), (5, "a▁b")]
    docs = spark.createDataFrame([(*t, "kept", [0]) for t in texts], "doc_id long, text string, `a.b` string, ids array<int>")
    found = piece_codes.decoded_ids(piece_codes.encoded_texts(docs, PATH), PATH, out="back")
    assert found.columns == ["doc_id", "a.b", "ids", "back"]
    want = [(i, "kept", model.encode(t or ""), model.decode(model.encode(t or ""))) for i, t in texts]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))
    assert piece_codes.encoded_texts(docs.limit(0), PATH).collect() == []
    assert piece_codes.encoded_texts(docs.select("text"), PATH).columns == ["ids"]
    nothing = spark.createDataFrame([(None,)], "ids array<int>")
    assert piece_codes.decoded_ids(nothing, PATH).first()["decoded"] == ""


def test_decoding_needs_the_model_only(monkeypatch):
    import sys
    import types

    import pyarrow as pa

    monkeypatch.setitem(sys.modules, piece_codes.MEMORY, types.ModuleType(piece_codes.MEMORY))
    monkeypatch.setattr(piece_codes.Pieces, "__init__", lambda *_: pytest.fail("tables of the vocabulary are built"))
    ids = piece_codes.Pieces.model_of_process(PATH).encode("two words")
    batch = pa.RecordBatch.from_arrays([pa.array([{"a": 1}]), pa.array([ids], pa.list_(pa.int32()))], names=["__row", "__ids"])
    assert [b.column(1).to_pylist() for b in piece_codes._decoded(PATH)(iter([batch]))] == [["two words"]]


def test_short_units_are_walked_side_by_side(model, monkeypatch):
    monkeypatch.setattr(piece_codes, "KNOWN_PAIRS", 16)
    monkeypatch.setattr(piece_codes, "UNITS_PER_WALK", 7)
    small = piece_codes.Pieces(PATH)
    rng = random.Random(4)
    units = sorted({"".join(rng.choice("abcdehinorst'") for _ in range(rng.randint(1, 30))) for _ in range(3000)})
    want = [small._known_signs(u) for u in units]
    ids, sizes = small._walked(units)
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    monkeypatch.setattr(small, "_known_signs", lambda _: pytest.fail("a unit is walked alone"))
    _same(small, model, [" ".join(units[k : k + 50]) for k in range(0, len(units), 50)])


def test_units_are_cut_where_no_piece_reaches(pieces, model, monkeypatch):
    signs = "ab▁'.-\té日"
    rng = random.Random(5)
    texts = ["▁", "a", "é", *("".join(rng.choice(signs) for _ in range(rng.randint(1, 30))) for _ in range(300))]
    units, counts = pieces._units(texts)
    cut, start = units.to_pylist(), 0
    for text, count in zip(texts, counts.tolist(), strict=True):
        assert count and "".join(cut[start : start + count]) == text and all(cut[start : start + count])
        assert [i for u in cut[start : start + count] for i in pieces.encode_unit(u)] == pieces.encode_unit(text)
        start += count
    assert start == len(cut)
    assert pieces._units(["▁▁don't,▁no.▁\tx"])[0].to_pylist() == ["▁▁don", "'t,", "▁no.", "▁", "\t", "x"]
    # A unit that stands often in a text is looked up once.
    looked = []
    monkeypatch.setattr(pieces, "slots", type("Slots", (dict,), {"get": lambda self, *a: looked.append(a[0]) or dict.get(self, *a)})())
    _same(pieces, model, ["again " * 500])
    assert len(looked) == 2


def test_decoding_reads_arrays_and_sends_rows_together(model, monkeypatch):
    import numpy as np
    import pyarrow as pa

    texts = ["two words", "", "naïve 日本 \U0001f600\x01", "x" * 50, "end"]
    given = []

    class Model:
        def decode(self, ids):
            given.append(type(ids))
            return model.decode(ids)

    monkeypatch.setattr(piece_codes.Pieces, "model_of_process", lambda _: Model())
    monkeypatch.setattr(piece_codes, "IDS_PER_STEP", 20, raising=False)
    lists = pa.array([*map(model.encode, texts), None], pa.list_(pa.int32()))
    batch = pa.RecordBatch.from_arrays([pa.array([{"a": k} for k in range(len(lists))]), lists], names=["__row", "__ids"])
    found = list(piece_codes._decoded(PATH)(iter([batch])))
    assert [r for b in found for r in b.to_pylist()] == [{"__row": {"a": k}, "__text": t} for k, t in enumerate([*texts, ""])]
    assert 1 < len(found) < len(lists) and given == [np.ndarray] * 5 + [list]
