"""Benchmark decontamination: a prefix-filtered join of word windows, in DataFrame operations.

A window (ten consecutive words of an item, or a whole shorter item) occurs in a document where all its
words stand in order. Containment has to be complete, so the prefix of a window that must be looked up is
one element: its rarest shingle, by the counts of the shingles in the documents. A document position that
holds this shingle fixes where the window would start; windows that would reach over either end are left
out, and the rest are compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastewell.session import written

SEPARATORS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
BROADCAST_ROWS = 200_000  # of windows at most ten words long: some 40 MB


def lowered(text: Column) -> Column:
    """A-Z in lower case and nothing else; only texts beyond ASCII need the slow way."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null gives none."""
    # A separator at both ends makes the first and last piece empty for every text, so that they can be cut off.
    spaced = F.concat(F.lit(" "), lowered(F.coalesce(text, F.lit(""))), F.lit(" "))
    pieces = F.split(spaced, SEPARATORS)
    return F.slice(pieces, 2, F.greatest(F.lit(0), F.size(pieces) - 2))


def item_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text", size: int = WINDOW) -> DataFrame:
    """(window, words, items): every distinct window with the ids of its items, in text form."""
    rows = items.select(F.col(id_column).cast("string").alias("item"), words_of(F.col(text_column)).alias("all")).filter("size(all) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - (size - 1)))
    cut = rows.select("item", F.explode(F.transform(starts, lambda s: F.slice("all", s, size))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).withColumn("window", F.concat_ws(" ", "words"))


def _at_prefix(words: DataFrame, keys: DataFrame, small: bool) -> DataFrame:
    """(doc words exploded to positions) joined with ``keys`` on the word; keys are sent whole only if small."""
    spots = words.select("*", F.posexplode("words").alias("at", "word"))
    return spots.join(F.broadcast(keys) if small else keys, "word")


def hits(rows: DataFrame, windows: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(row, start, length, items): every occurrence of a window. ``rows`` has row and words."""
    small = windows.limit(broadcast_rows + 1).count() <= broadcast_rows
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    counts = written(_at_prefix(rows.select("words"), vocabulary, small).groupBy("word").agg(F.count("*").alias("n")), "word-counts")
    # The rarest word of each window, the first such place; a word that no document has rules the window out.
    spread = windows.select("window", "words", "items", F.posexplode("words").alias("offset", "word"))
    ranked = spread.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rarest = ranked.groupBy("window").agg(
        F.min(F.struct("n", "word", "offset")).alias("rarest"), F.first("words").alias("window_words"), F.first("items").alias("items")
    )
    keyed = rarest.filter("rarest.n > 0").select(F.col("rarest.word").alias("word"), "rarest.offset", "window_words", "items")
    keyed = written(keyed.groupBy("word").agg(F.collect_list(F.struct("offset", "window_words", "items")).alias("windows")), "prefixes")
    if small:
        found = _at_prefix(rows, keyed, True).select("row", "words", "at", F.explode("windows").alias("w"))
    else:
        # Only row and position travel to the windows; the words are fetched for what is left.
        spots = _at_prefix(rows, keyed, False).select("row", "at", F.explode("windows").alias("w"))
        found = spots.join(rows, "row")
    start = F.col("at") - F.col("w.offset")
    length = F.size("w.window_words")
    bounded = found.filter((start >= 0) & (start + length <= F.size("words")))
    exact = bounded.filter(F.slice("words", start + 1, length) == F.col("w.window_words"))
    return exact.select("row", start.alias("start"), length.alias("length"), F.col("w.items").alias("items"))


def covered(found: DataFrame) -> DataFrame:
    """(row, n_hit, item_list): words inside any occurrence, and the items, sorted as strings."""
    ahead = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.select("row", "start", (F.col("start") + F.col("length")).alias("end"))
    reach = F.coalesce(F.max("end").over(ahead), F.lit(0))
    sums = ends.distinct().select("row", F.greatest(F.lit(0), F.col("end") - F.greatest("start", reach)).alias("new")).groupBy("row").agg(F.sum("new").alias("n_hit"))
    items = found.select("row", F.explode("items").alias("item")).groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("item_list"))
    # A window whose items all have a null id has no row in ``items``; its words count all the same.
    return sums.join(items, "row", "left").select("row", "n_hit", F.coalesce("item_list", F.array().cast("array<string>")).alias("item_list"))


def contamination(
    docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
    item_text: str = "text", size: int = WINDOW, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(row, n_words, n_hit, n_items, item_list, contaminated) for every row of ``docs``.

    ``row`` is the struct of id and text hash that ``row_key`` gives. Null and empty texts have no words and
    are never contaminated; items without words never match; equal items all count, items with a null id
    do not. Repeated rows come back as often as they came; other columns are ignored.
    """
    key, words = row_key(id_column, text_column), words_of(F.col(text_column))
    windows = written(item_windows(items, item_column, item_text, size), "windows")
    found = written(hits(docs.select(key.alias("row"), words.alias("words")), windows, broadcast_rows), "hits")
    # Repeated rows have one key: their occurrences are counted once, and each of them gets the answer.
    sums = covered(found).withColumnRenamed("row", "__row")
    counted = docs.select(key.alias("row"), F.size(words).cast("long").alias("n_words"))
    out = counted.join(sums, F.col("row").eqNullSafe(F.col("__row")), "left")
    item_list = F.coalesce("item_list", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("row", "n_words", n_hit.alias("n_hit"), F.size(item_list).cast("long").alias("n_items"), item_list.alias("item_list"), (n_hit > 0).alias("contaminated"))


def row_key(id_column: str = "doc_id", text_column: str = "text") -> Column:
    """What tells rows apart: id and text."""
    return F.struct(F.col(id_column).alias("id"), F.xxhash64(text_column).alias("text_hash"))


def decontaminated(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no window of an item, with their columns, whatever these are called.

    Null and empty texts hold no window and stay; repeated rows go or stay together.
    """
    found = contamination(docs, items, id_column, text_column).filter("contaminated")
    hit = written(found.select(F.col("row").alias("__row")).distinct(), "contaminated")
    if hit.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        hit = F.broadcast(hit)
    # One struct keeps the columns of the documents apart from the key.
    own = docs.select(row_key(id_column, text_column).alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc"))
    return own.join(hit, F.col("__key").eqNullSafe(F.col("__row")), "left_anti").select("__doc.*")
