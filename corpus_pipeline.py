"""From documents to token files: language, near duplicates, benchmark passages, mix, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell.llm import decontamination, language, mixing, simhash, token_store
from tastewell.llm.queries import fold, table, tokenizer_path
from tastewell.session import written

SHINGLE, SIMILARITY = 5, 0.8


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose text is like a language; those with letters, if none was learned. ``lang`` stays as it came.

    Profiles come from the labelled four fifths of the documents. The order and number of rows is free.
    """
    return language.identified(docs, fold(5) != 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of every group of texts alike in 0.8 of their five-word shingles."""
    return simhash.deduplicated(docs, shingle=SHINGLE, similarity=SIMILARITY)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no ten-word window of a benchmark item."""
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in the order of the queue."""
    return mixing.mixed(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids in the token files."""
    return token_store.token_documents(docs, tokenizer_path())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
    ("token_ids", write_token_ids),
]

# Trained profiles and the tokenizer's merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the documents; each one's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
