"""The registered queries of the operators in this folder, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell.llm import conversations, decontamination, hard_negatives, language, maxscore, mixing, page_text, piece_codes, ppm, sharding, simhash, token_store, toxicity
from tastewell.llm.labelled_pages import labelled_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(divisor: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo the divisor."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under the trie of the training fold, beside the word model."""
    return ppm.ppm_scores(table(spark, sf_dir, "documents"), fold(10) != 0)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicate_groups(table(spark, sf_dir, "documents"))


def op3_minimax(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; shards have near equal bytes."""
    rows = sharding.shard_rows(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_fair_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    documents, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(3) == 1, F.lit(True)))
    sample = toxicity.labelled_sample(docs, table(spark, sf_dir, "labels"), ~F.col("held_out"))
    scored = toxicity.score_texts(docs, toxicity.train(*sample), keep=["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op6_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie inside an occurrence of a benchmark window."""
    found = decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.concat_ws(",", "item_list"), 256)
    return found.select(F.col("row.id").alias("doc_id"), "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


def op7_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for every vector whose id is divisible by 100."""
    return maxscore.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_page_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = page_text.extract_text(table(spark, sf_dir, "pages"), *page_text.train(labelled_pages()))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_direct_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    return token_store.token_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_hyperdimensional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.coalesce(fold(5) == 0, F.lit(True)))
    return language.learn_and_predict(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op11_backtracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's piece ids, and the digest of the text they decode to."""
    model = tokenizer_path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = piece_codes.decoded_ids(piece_codes.encoded_texts(docs, model), model)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_score_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every vector whose id is divisible by 50."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with nulls as one space and turns dropped, emptied, cut, repeated or reroled by their key's hash."""
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    key = F.concat(conv, F.lit(":"), turn)
    fate = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(fate == 1, F.lit("")).when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fate == 4, F.lit("user")).otherwise(role)
    times = F.array_repeat(F.lit(0), F.when(fate == 3, 2).otherwise(1))
    return rows.filter(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")


def op13_run_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every damaged conversation."""
    rows = table(spark, sf_dir, "conversations")
    return conversations.conversation_digests(conversations.repaired_chunks(damaged(rows)), rows)


REGISTERED = [op1_ppm, op2_simhash, op3_minimax, op4_fair_queue, op5_string_kernel, op6_prefix_join, op7_maxscore, op8_page_model, op9_direct_codes, op10_hyperdimensional]
REGISTERED += [op11_backtracking, op12_score_slots, op13_run_length]


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in REGISTERED}


# Words of both tables; every item window of ten words or less; every stretch of that length in a document.
PREFIX_JOIN_SQL = """
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '{separators}'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '{separators}'), lambda x: x <> '') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, list_slice(w, s, s + 9) AS win
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 8))) AS s FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT len(win) AS n FROM windows),
stretches AS (
  SELECT doc_id, n, s, list_slice(w, s, s + n - 1) AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lengths WHERE len(w) >= n)),
hits AS (SELECT doc_id, s, n, item FROM stretches JOIN windows USING (win)),
spots AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM hits)) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (doc_id) LEFT JOIN items USING (doc_id)
"""

MAXSCORE_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""


# Whole numbers, positives and their windows; the best three rows of another label inside each.
SCORE_SLOTS_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 50 = 0) a JOIN v c ON c.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS place FROM s WHERE same) WHERE place <= 5),
n AS (
  SELECT anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""


def statements() -> dict[str, str]:
    """SQL twins by query name. The others hash, learn or search in ways that SQL does not have."""
    separators = decontamination.SEPARATORS
    return {
        "op6_prefix_join": PREFIX_JOIN_SQL.format(upper=decontamination.UPPER, lower=decontamination.LOWER, separators=separators),
        "op7_maxscore": MAXSCORE_SQL,
        "op12_score_slots": SCORE_SLOTS_SQL,
    }
