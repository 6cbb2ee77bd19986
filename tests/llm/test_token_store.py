"""Round trips of the codes, and word-wise ids against ids of whole texts."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastewell.llm import token_store
from tastewell.session import scratch_path

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


@pytest.mark.parametrize("top", [1, 200, 70_000, 2**32])
def test_codes(top):
    ids = np.random.default_rng(top).integers(0, top, 3000).astype(np.uint32)
    levels, bitmaps, ranks = token_store.encode(ids)
    assert (token_store.decode(levels, bitmaps, len(ids)) == ids).all()
    for place in (0, 1, 511, 512, 513, 1023, 2048, 2999):
        assert token_store.token_at(levels, bitmaps, ranks, place) == ids[place]


ROWS = [
    (5, "Hello, it's a test -- naïve café"), (2, None), (9, ""), (1, " \t\n\x0b "), (None, "no id"), (3, "İstanbul ΟΔΟΣ ΟΔΟΣ. é x y   z"),
    (7, "a <|endoftext|> b<|startoftext|>c"), (7, "same id"), (7, "same id"), (8, "word " * 3000), (4, "日本語 \U0001f600‍ x\u0085y \x1c z"), (6, "'s 't we'll I'd"),
]


def test_documents(spark):
    docs = spark.createDataFrame([(*r, 1, 2) for r in ROWS], "doc_id long, text string, part int, start int").repartition(4)
    got = [tuple(r) for r in token_store.token_documents(docs, PATH).orderBy("start").collect()]
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    ids = {}
    for i, t in ROWS:
        ids.setdefault(i, []).append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1])
    assert [g[0] for g in got] == sorted((i for i, _ in ROWS), key=lambda i: (i is not None, i or 0))
    at = 0
    for doc_id, start, n, crc in got:
        assert start == at
        at += n
        assert (n, crc) in {(len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in ids[doc_id]}
    assert token_store.token_documents(docs.limit(0), PATH).collect() == []


def test_random_texts_equal_the_tokenizer():
    rng = random.Random(5)
    signs = [
        *"İiIßΣςóŉﬁKÅ가가.!?,-(<|>1２²aBcd  \n\t 　\x00\x1c\x85漢あ\U0001f600Ωﬃẞ'", "é", "\u0301", "\u0307", "\u0958", "\u0929", "\u200d", "\ufe0f",
        "\u0915", "\u093c", "\u0345", "'s", "'ll", "re", "<|endoftext|>", "<|startoftext|>",
    ]
    texts = ["AVRUPA BİRLİĞİ.", "KENDİSİ, dedi", *("".join(rng.choice(signs) for _ in range(rng.randint(0, 25))) for _ in range(20_000))]
    words = token_store._WordIds(PATH)
    ids, sizes = words.of(pa.array(texts))
    start = 0
    for text, size in zip(texts, sizes.tolist(), strict=True):
        assert ids[start : start + size].tolist() == words.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)
        start += size


def test_random_access(spark, monkeypatch):
    monkeypatch.setattr(token_store, "TEXT_BYTES_PER_RUN", 60)
    docs = spark.createDataFrame([(i, f"text number {i} with words " * (i % 5)) for i in range(40)], "doc_id long, text string")
    folder = scratch_path(spark, "random-access")
    token_store.write_tokens(docs, PATH, folder)
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    every = [t for i in range(40) for t in [*tokenizer.encode(f"text number {i} with words " * (i % 5), add_special_tokens=False).ids, 1]]
    asked = spark.range(0, len(every), 7).select(F.col("id").alias("place"))
    got = {r["place"]: r["token"] for r in token_store.read_token(spark, folder, asked).collect()}
    assert got == {p: every[p] for p in range(0, len(every), 7)}


def test_words_stay_known_when_pieces_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_store, "KNOWN_PIECES", 30, raising=False)
    rng = random.Random(4)
    words = token_store._WordIds(PATH)
    texts = [" ".join("".join(rng.choices("abcdeé.", k=rng.randint(1, 7))) for _ in range(20)) for _ in range(12)]
    for text in texts:
        ids, sizes = words.of(pa.array([text]))
        assert list(ids) == words.tokenizer.encode(text, add_special_tokens=False).ids and list(sizes) == [len(ids)]
    assert set(" ".join(texts).split()) <= set(words.slots)
    assert len(words.pieces) <= 41


def test_words_are_split_together():
    import unicodedata

    words = token_store._WordIds(PATH)
    rng = random.Random(5)
    made = ["".join(rng.choices("abZé0ſ'.,!)́İ漢<", k=rng.randint(1, 9))) for _ in range(3000)]
    made += ["...", "x", "É!", "a\0b.", "<|endoftext|>.", "The.", "é.", "́.", "don't,", "İ."]
    parts = words._split(pa.array(made)).to_pylist()
    cut = 0
    for word, stem, signs in zip(made, parts[::2], parts[1::2], strict=True):
        assert stem + signs in (word, word.lower()) and stem and set(signs) <= set(token_store.SIGNS)
        whole = any(sign in word for sign in "<\0")
        assert not signs or (not whole and unicodedata.normalize("NFC", stem)[-1].isalpha())
        cut += bool(signs)
    assert cut > 300 and ("the", ".") in zip(parts[::2], parts[1::2], strict=True)
    for start in range(0, len(made), 500):
        texts = [" ".join(made[start + k : start + k + 9]) for k in range(0, 500, 9)]
        ids, sizes = words.of(pa.array([*texts, "", " "]))
        want = [words.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert sizes.tolist() == [*map(len, want), 0, 0] and ids.tolist() == [i for w in want for i in w]
