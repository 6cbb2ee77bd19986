"""Invented languages, whole words of which differ."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tastewell.llm import language

PARTS = {"aa": ["the", "er", "ing", "and"], "bb": ["sch", "ung", "ein", "ö"], "cc": ["ción", "que", "ñ", "lla"]}


def _text(rng, lang, words):
    return " ".join("".join(rng.choice(PARTS[lang], 3)) for _ in range(words))


def test_held_out_accuracy_and_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, _text(rng, "abc"[i % 3] * 2, 30), "abc"[i % 3] * 2, i % 4 > 0) for i in range(300)]
    rows += [(900, None, "aa", True), (901, "", "bb", True), (902, "123 ... !", "cc", True), (None, "thering", None, True), (903, _text(rng, "bb", 60000), None, False)]
    rows += [rows[0]]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, learn boolean, score string").repartition(4)
    got = language.learn_and_predict(docs, F.col("learn"), keep=["doc_id", "learn"]).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    held = [r for r in got if not r["learn"] and r["doc_id"] < 900]
    assert np.mean([r["lang_pred"] == "abc"[r["doc_id"] % 3] * 2 for r in held]) >= 0.98
    assert by_id[903]["lang_pred"] == "bb"
    assert {by_id[i]["lang_pred"] for i in (900, 901, 902)} == {language.UNKNOWN}
    assert all(0 <= r["score"] <= 1 for r in got)


def test_slices_do_not_change_a_bundle(monkeypatch):
    import pyarrow as pa

    texts = pa.array(["some words of a text", None, "andere wörter", "x"])
    distinct, rows, index, _ = language._trigrams(texts)
    whole = language._bundled(distinct, rows, index, 4, 64)
    monkeypatch.setattr(language, "GRAMS_PER_SLICE", 3)
    assert (language._bundled(distinct, rows, index, 4, 64) == whole).all()
    direct = np.zeros(64)
    for g in zip(" some words of a text ", "some words of a text ", "ome words of a text ", strict=False):
        a, b, c = (language._letter_vectors(np.array([ord(x)]), 64)[0].astype(int) for x in g)
        if g[1] != " ":
            direct += np.roll(a, 2) * np.roll(b, 1) * c
    assert whole[0] == pytest.approx(direct)


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "text", "aa")], "doc_id long, text string, lang string")
    assert [tuple(r)[1:] for r in language.learn_and_predict(docs, F.lit(False)).collect()] == [(language.UNKNOWN, 0.0, 0.0)]
    assert language.learn_and_predict(docs.limit(0), F.lit(True)).collect() == []


def test_identified(spark):
    rng = np.random.default_rng(4)
    schema = "doc_id long, text string, lang string, cosine double"
    rows = [(i, _text(rng, "abc"[i % 3] * 2, 30), "abc"[i % 3] * 2 if i % 5 else None, 0.0) for i in range(600)]
    junk = [(1000 + i, " ".join("".join(rng.choice(list("qxzjkvw"), 12)) for _ in range(25)), None, 0.0) for i in range(20)]
    bare = [(2000, None, "aa", 0.0), (2001, "12 ?!", "bb", 0.0)]
    docs = spark.createDataFrame(rows + junk + bare, schema).repartition(3)
    kept = language.identified(docs, F.col("doc_id") % 4 != 0)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == list(range(600))
    # Nothing learned: null labels, or a null condition.
    unlabelled = language.identified(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert unlabelled.count() == language.identified(docs, F.lit(None).cast("boolean")).count() == 620


def test_pipeline_keeps_documents_if_nothing_was_learned(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "some text", None), (2, "...", None), (None, "more", "aa")], "doc_id long, text string, lang string")
    kept = corpus_pipeline.identify_language(spark, docs, "")
    assert sorted(r["text"] for r in kept.collect()) == ["more", "some text"]
