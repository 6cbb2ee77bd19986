"""Planted insults, plain and disguised; the kernel against its definition."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tastewell.llm import toxicity

INSULTS = ["zorgling", "fleebnik", "drokhead"]


def _corpus(n, seed):
    rng = np.random.default_rng(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    texts, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(60)]
        if i % 3 == 0:
            words[rng.integers(60)] = INSULTS[i % len(INSULTS) if i % 2 else rng.integers(3)]
        texts.append(" ".join(words))
        labels.append(int(i % 3 == 0))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def model():
    return toxicity.train(*_corpus(300, 1))


def test_held_out(model):
    texts, labels = _corpus(300, 2)
    scores = model.scores(pa.array(texts))
    assert (scores[labels == 1] >= 0.7).mean() >= 0.98
    assert (scores[labels == 0] >= 0.7).mean() <= 0.01


@pytest.mark.parametrize("word", ["z-o-r-g-l-i-n-g", "ZORGLING!", "zorgxling", "f l e e b n i k", "fleebn1k", "zorglingg"])
def test_disguises(model, word):
    texts, _ = _corpus(2, 3)
    assert model.scores(pa.array([f"{texts[1]} {word} {texts[1]}"]))[0] >= 0.7


def test_kernel():
    def direct(s, t):
        def found(w):
            out = {}
            for i, j, k in itertools.combinations(range(len(w)), 3):
                if k - i < toxicity.SPAN:
                    out[w[i], w[j], w[k]] = out.get((w[i], w[j], w[k]), 0) + toxicity.DECAY ** (k - i + 1)
            return out

        a, b = found(s), found(t)
        return sum(v * b.get(u, 0) for u, v in a.items()) / np.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))

    words, marks = ["<idiot>", "<idixot>", "<banana>", "<xyzzy>", "idiots"], ["<idiot>", "banan"]
    expected = np.array([[direct(w, m) for m in marks] for w in words])
    expected[expected < toxicity.LEAST_VALUE] = 0
    assert toxicity.Kernel(marks).values(words) == pytest.approx(expected, abs=1e-5)


def test_rows(spark, model):
    texts, labels = _corpus(60, 4)
    rows = [*enumerate(texts), (900, None), (901, ""), (None, texts[0]), (902, "word " * 200_000 + "zorgling"), (903, "x" * 5000), (0, texts[0])]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, score string").repartition(3)
    got = toxicity.score_texts(docs, model).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r["score"] for r in got}
    assert by_id[900] == by_id[901] < 0.5 < by_id[902]
    assert all(0 <= r["score"] <= 1 for r in got)
    label_rows = spark.createDataFrame([(i, int(x)) for i, x in enumerate(labels)] + [(None, 1), (900, None)], "doc_id long, toxic int")
    sample, marks = toxicity.labelled_sample(docs, label_rows, F.lit(True))
    assert (len(sample), int(marks.sum())) == (60, int(labels.sum()))
    assert toxicity.score_texts(docs.limit(0), model).collect() == []


def test_one_label_only():
    assert toxicity.train(["a", "b"], np.array([0, 0])).scores(pa.array(["a", None])) == pytest.approx([0.01, 0.01])
    assert toxicity.train([], np.zeros(0)).scores(pa.array(["a"])) == pytest.approx([0.01])


def _insulted(n, seed):
    rng = np.random.default_rng(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]
    stems = np.random.default_rng(9)
    insults = ["".join(stems.choice(list("bcfgjklmpquvwxyz"), 9)) for _ in range(100)]
    texts = []
    for i in range(n):
        words = ["".join(rng.choice(syllables, rng.integers(1, 5))) for _ in range(40)]
        if i % 2:
            words[rng.integers(40)] = insults[i // 2 % 100]
        texts.append(" ".join(words))
    return texts, np.arange(n) % 2


def test_a_hundred_evenly_used_insults():
    # Each stands in one toxic text of a hundred: ten times in all.
    model = toxicity.train(*_insulted(2000, 7))
    texts, labels = _insulted(400, 8)
    scores = model.scores(pa.array(texts))
    assert (scores[labels == 1] >= 0.7).mean() >= 0.98
    assert (scores[labels == 0] >= 0.7).mean() <= 0.01
