"""The scores against a direct count over small texts."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastewell.llm import ppm

TEXTS = ["the cat sat on the mat", "The CAT\tsat", "", None, "  \n ", "été çà là été", "the cat sat on the mat", "a" * 3000 + " b", "x \x0b y", "z"]


def _tokens(text):
    return (text or "").encode().lower().split()


def _model(texts, order):
    contexts = [defaultdict(Counter) for _ in range(order + 1)]
    for text in texts:
        stream = b"\xfe" * order + b" ".join(_tokens(text)) + b"\xff"
        for at in range(order, len(stream)):
            for k in range(order + 1):
                contexts[k][stream[at - k : at]][stream[at]] += 1
    return contexts


def _log(contexts, order, before, symbol):
    total, excluded = 0.0, set()
    for k in range(order, -1, -1):
        seen = {s: c for s, c in contexts[k].get(before[len(before) - k :], {}).items() if s not in excluded}
        if not seen:
            continue
        n = sum(seen.values())
        if symbol in seen:
            return total + math.log10((2 * seen[symbol] - 1) / (2 * n))
        total += math.log10(len(seen) / (2 * n))
        excluded |= set(seen)
    return total - math.log10(255 - len(excluded))


@pytest.mark.parametrize(("order", "chunk"), [(5, 40), (3, 1 << 20)])
def test_scores_equal_a_direct_count(spark, order, chunk):
    rows = [(i, t, i % 3 != 0, "extra") for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learn boolean, score string").repartition(3)
    got = {r["doc_id"]: r for r in ppm.ppm_scores(docs, F.col("learn"), order=order, chunk_bytes=chunk).collect()}
    trained = [t for i, t in enumerate(TEXTS) if i % 3]
    contexts = _model(trained, order)
    counts = Counter(w for t in trained for w in [*_tokens(t), None])
    n, v = sum(counts.values()), len(counts)
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        tokens = [*_tokens(text), None]
        stream = b"\xfe" * order + b" ".join(_tokens(text)) + b"\xff"
        score = sum(_log(contexts, order, stream[a - order : a], stream[a]) for a in range(order, len(stream)))
        base = sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens)
        row = got[i]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
        assert row["held_out"] == (i % 3 == 0)
        assert row["score"] == pytest.approx(score, rel=1e-5, abs=1e-5)
        assert row["base_score"] == pytest.approx(base)


def test_probabilities_of_a_context_sum_to_one():
    rng = np.random.default_rng(0)
    text = rng.choice(list(b"abcd "), 400).astype(np.uint8).tobytes()
    codes, _ = ppm._stream(np.frombuffer(text, np.uint8), np.array([400]), 5)
    keys, counts = ppm._counted(codes)
    pairs = np.zeros((256, 256), np.int64)
    np.add.at(pairs, ((codes >> np.uint64(8)).astype(np.int64) & 255, codes.astype(np.int64) & 255), 1)
    for context in (keys[3] >> np.uint64(8), np.uint64(0x7A7A7A7A61)):
        asked = (context << np.uint64(8)) | np.array([s for s in range(256) if s != 0xFE], np.uint64)
        every = np.union1d(keys, asked)
        held = np.zeros(len(every), np.int64)
        held[np.searchsorted(every, keys)] = counts
        logs = ppm.code_lengths(every, held, pairs, 5)
        assert (10 ** logs[np.searchsorted(every, asked)]).sum() == pytest.approx(1)


def test_empty_table_and_no_training(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ppm.ppm_scores(none, F.lit(True)).collect() == []
    one = spark.createDataFrame([(None, "ab"), (None, "ab")], "doc_id long, text string")
    rows = ppm.ppm_scores(one, F.lit(None).cast("boolean")).collect()
    assert [(r["doc_id"], r["held_out"], r["n_known"], r["train_tokens"]) for r in rows] == [(None, True, 0, 0)] * 2
    assert rows[0]["score"] == pytest.approx(-3 * math.log10(255), rel=1e-5)
