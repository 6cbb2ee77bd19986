"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order, repeated as often as the target needs. A document's
virtual finish time is the words its source has sent up to it, divided by the source's target. All sources
are merged in the order of finish times and cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastewell.session import written

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
SEED = 17
BROADCAST_ROWS = 500_000  # of ids and finish times: some 30 MB
PARTS = 4096  # of a source's shuffled order, and of the time up to the cut


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """(source, source_size, target) from one row per source (source, source_size).

    The weights repeat over the sources in code-point order, null last. A target stops at ``repeats`` times
    its source's size; what is over is shared by weight among the rest until none is above. Sources that
    are full at level x hold their limit, the others x times their weight, so the level follows from the
    sources in the order of limit over weight. One row per source: the windows over them stay small.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    rows = sizes.withColumn("place", F.row_number().over(place) - 1)
    rows = rows.withColumn("weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
    rows = rows.withColumn("limit", F.col("source_size") * F.lit(repeats))
    ordered = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    rows = rows.withColumn("before", F.coalesce(F.sum("limit").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.withColumn("left", F.sum("weight").over(ordered.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("all", F.sum("source_size").over(Window.partitionBy()))
    rows = rows.withColumn("level", (F.col("all") - F.col("before")) / F.col("left"))
    # The level is that of the first source that it does not fill.
    open_ = F.col("level") * F.col("weight") < F.col("limit")
    rows = rows.withColumn("cut", F.min(F.when(open_, F.struct(F.col("limit") / F.col("weight"), "place", "level"))).over(Window.partitionBy()))
    target = F.least(F.col("limit").cast("double"), F.coalesce(F.col("cut.level") * F.col("weight"), F.col("limit").cast("double")))
    return rows.select("source", F.col("source_size").cast("long"), target.alias("target"))


def running(df: DataFrame, keys: list[str], part: str, order: list, sums: dict[str, str]) -> DataFrame:
    """Adds running sums (column: new name) per ``keys``, by ``part`` first; no key has to fit into one task.

    The sums of the parts run first (at most as many rows per key as there are parts), then each part runs
    for itself.
    """
    ahead = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, part).agg(*(F.sum(c).alias(f"__sum_{c}") for c in sums))
    before = {c: F.coalesce(F.sum(f"__sum_{c}").over(ahead), F.lit(0)).alias(f"__ahead_{c}") for c in sums}
    totals = totals.select(*(F.col(k).alias(f"__{k}") for k in keys), F.col(part).alias("__part"), *before.values())
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    inside = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = df.select("*", *(F.sum(c).over(inside).alias(name) for c, name in sums.items()))
    joined = summed.join(totals, [*same, F.col(part).eqNullSafe(F.col("__part"))])
    joined = joined.withColumns({name: F.col(name) + F.col(f"__ahead_{c}") for c, name in sums.items()})
    return joined.drop("__part", *(f"__{k}" for k in keys), *(f"__ahead_{c}" for c in sums))


def mix(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS, repeats: int = REPEATS, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(documents, queue).

    Documents: row, id, size, source, source_size, target and taken for every input row; queue: row, round,
    size, taken and finish of every document that is sent, in the order of finish. The last one may be taken
    in part, so that exactly the budget, the sum of all targets, is taken. Sizes are words of the whole text
    (null: 0). Documents without words take nothing. A null source is a source of its own. Repeated rows
    count each; rows with equal ids are told apart by their content and, when that is equal too, are alike.
    """
    fields = docs.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(F.col(text_column)).alias("size"),
        # Depends on the content, so that reruns agree however the rows are read.
        F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column), F.col(source_column)).alias("mark"),
    )
    # Equal rows are one entry with a count: they stand next to each other in the shuffled order.
    rows = written(fields.groupBy("id", "source", "size", "mark").agg(F.count("*").alias("copies")), "mix-rows")
    rows = rows.withColumn("words", F.col("size") * F.col("copies")).withColumn("part", F.shiftrightunsigned("mark", 52))
    targets = written(source_targets(rows.groupBy("source").agg(F.sum("words").alias("source_size")), weights, repeats), "mix-targets")
    placed = running(rows, ["source"], "part", ["mark", "id", "size"], {"words": "reached"})
    named = targets.select(F.col("source").alias("__source"), "source_size", "target")
    placed = written(placed.join(named, F.col("source").eqNullSafe(F.col("__source"))).drop("__source"), "mix-placed")
    copies = (
        placed.filter("words > 0 AND target > 0")
        .withColumn("round", F.explode(F.sequence(F.lit(0), F.least(F.lit(repeats - 1), F.ceil(F.col("target") / F.col("source_size")).cast("int")))))
        .withColumn("finish", (F.col("reached") + F.col("round") * F.col("source_size")) / F.col("target"))
        # The whole budget is reached by finish 1 plus one entry of each source; later ones cannot be sent.
        .withColumn("start", F.col("finish") - F.col("words") / F.col("target"))
        .filter("start <= 1")
        .withColumn("slot", F.least(F.floor(F.col("finish") * PARTS), F.lit(PARTS)).cast("long"))
    )
    budget = targets.agg(F.sum("source_size")).first()[0] or 0
    queue = running(copies, [], "slot", ["finish", F.col("source").asc_nulls_last(), "mark", "id", "size"], {"words": "sent"})
    queue = queue.withColumn("taken", F.least(F.col("words"), F.lit(int(budget)) - (F.col("sent") - F.col("words")))).filter("taken > 0")
    queue = written(queue.select("id", "source", "size", "mark", "copies", "round", "finish", "taken"), "mix-queue")
    sums = queue.groupBy("id", "source", "size", "mark").agg(F.sum("taken").alias("taken"))
    keys = ["id", "source", "size", "mark"]
    other = sums.select(*(F.col(k).alias(f"__{k}") for k in keys), "taken")
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    joined = placed.join(other, same, "left").withColumn("taken", F.coalesce("taken", F.lit(0)))
    # What an entry takes is dealt to its copies in full rounds, the rest one copy after the other.
    per = F.col("size") * F.col("copies")
    full = F.when(per > 0, F.floor(F.col("taken") / per)).otherwise(0).cast("long")
    documents = joined.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rest = F.col("taken") - full * per - (F.col("copy") - 1) * F.col("size")
    documents = documents.withColumn("taken", full * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest)))
    return documents.select("id", "source", "size", "source_size", "target", F.col("taken").cast("long"), "mark"), queue


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """The rows of the mix in the order of the queue, with all columns of ``docs``.

    A document comes as often as its words are taken; the last document of the queue comes whole.
    """
    _, queue = mix(docs, id_column, text_column, source_column)
    sent = queue.select("id", "mark", "finish", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))).alias("copy"))
    mark = F.xxhash64(F.lit(SEED), F.col(id_column), F.col(text_column), F.col(source_column))
    shares = sent.groupBy(F.col("id").alias("__id"), F.col("mark").alias("__mark")).agg(F.sort_array(F.collect_list("finish")).alias("__finish"))
    shares = written(shares, "mix-shares")
    if shares.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        shares = F.broadcast(shares)
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_column).cast("long").alias("doc_key"), mark.alias("doc_mark"))
    if queue.filter("copies > 1").limit(1).count():
        # Equal rows share one entry, which says how often the text is sent in all.
        whole = whole.dropDuplicates(["doc_key", "doc_mark"])
    joined = whole.join(shares, F.col("doc_key").eqNullSafe(F.col("__id")) & (F.col("doc_mark") == F.col("__mark")))
    out = joined.select("doc", F.explode("__finish").alias("finish"), "doc_key")
    return out.repartitionByRange("finish", "doc_key").sortWithinPartitions("finish", "doc_key").select("doc.*")
