"""The registered queries on the smallest tables: SQL twins, shapes, folds, and the whole pipeline."""

import hashlib
import re
import zlib

import duckdb
import pytest

import corpus_pipeline
from tastewell.llm import queries
from tests.conftest import SF
from tests.llm.test_conversations import _search

COLUMNS = {
    "op1_ppm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    "op2_simhash": ["doc_id", "fingerprint", "component_id"],
    "op3_minimax": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op4_fair_queue": ["doc_id", "size", "source_size", "target", "taken"],
    "op5_string_kernel": ["doc_id", "held_out", "score", "predicted"],
    "op6_prefix_join": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op7_maxscore": ["query_id", "rank", "vec_id", "score"],
    "op8_page_model": ["page_id", "url", "text", "n_chars"],
    "op9_direct_codes": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op10_hyperdimensional": ["doc_id", "held_out", "lang_pred", "score", "cosine"],
    "op11_backtracking": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op12_score_slots": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"],
    "op13_run_length": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.statements()))
def test_against_sql(spark, sql, name):
    df = queries.registered()[name](spark, SF)
    result = sql.sql(queries.statements()[name])
    order = sorted(df.columns)
    expected = [tuple(r[result.columns.index(c)] for c in order) for r in result.fetchall()]
    assert sorted(map(tuple, df.select(*order).collect())) == sorted(expected)


@pytest.mark.parametrize("name", list(COLUMNS))
def test_rows_and_columns(spark, name):
    df = queries.registered()[name](spark, SF)
    assert df.columns == COLUMNS[name]
    source = {"op8_page_model": "pages", "op13_run_length": "conversations"}.get(name, "documents")
    if name not in ("op7_maxscore", "op12_score_slots"):
        key = df.columns[0]
        ids = sorted(r[0] for r in df.select(key).collect())
        rows = queries.table(spark, SF, source).select(key)
        assert ids == sorted(r[0] for r in (rows.distinct() if name == "op13_run_length" else rows).collect())


def test_op11_equals_the_library(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    found = {r["doc_id"]: tuple(r)[1:] for r in queries.op11_backtracking(spark, SF).collect()}
    for doc_id, text in queries.table(spark, SF, "documents").select("doc_id", "text").collect():
        ids = model.encode(text or "")
        digests = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), model.decode(ids))]
        assert found[doc_id] == (len(ids), *digests)


def test_op13_equals_a_search(spark):
    convs = {}
    for conv, turn, role, text in queries.table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect():
        turns = convs.setdefault(conv, [])
        fate = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fate, text)
        if fate:
            turns += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    found = {r[0]: tuple(r)[1:] for r in queries.op13_run_length(spark, SF).collect()}
    assert found == {conv: _search(turns) for conv, turns in convs.items()}


def test_fold(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", queries.fold(7).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["doc_id"]).encode()) % 7 for r in rows)


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    fields = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SF)
        if name != "token_ids":
            assert docs.columns == fields
        if name in ("language", "near_duplicates", "decontamination"):
            assert docs.join(before, "doc_id", "left_anti").count() == 0
            assert 0.8 * before.count() <= docs.count() <= before.count()
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert docs.count() == corpus_pipeline.run(spark, SF).count()
