"""Records of CSV files whose quoted fields hold line breaks, read split by split.

Whether a line begins inside a quoted field depends on all of the file before it. A line is a function of two states (outside or
inside of quotes at its front) to the state at its end; the functions of a split's lines make that of the split, and
those of the splits before it give the state it begins in. With that state each split finds its records on its own. Only what a
border cuts is put together afterwards: the open end of a split and the lines that the next ones begin with.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTSIDE, INSIDE = 0, 1
# The rest of a line from the front of a field on: whole fields, and an open quoted one if the line ends in it.
FIELDS = re.compile(r'(?:"(?:[^"]|"")*+(?:"[^,]*(?:,|\Z)|(\Z))|[^,]*(?:,|\Z))')
CLOSING = re.compile(r'(?:[^"]|"")*+"(?!")[^,]*(?:,|\Z)')


def state_after(line: str, state: int) -> int:
    """The state at the end of a line; quotes count at the front of a field and inside a quoted one only."""
    if '"' not in line:
        return state
    place = 0
    if state == INSIDE:
        closed = CLOSING.match(line)
        if closed is None:
            return INSIDE
        place = closed.end()
    while place < len(line):
        field = FIELDS.match(line, place)
        if field[1] is not None:
            return INSIDE
        place = field.end()
    return OUTSIDE


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, after_outside, after_inside) of each split; one comes back in parts if a task reads it in several batches."""
    for batch in batches:
        made: list[list] = []
        for value, file, block, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not made or made[-1][:2] != [file, block]:
                made.append([file, block, row, OUTSIDE, INSIDE])
            made[-1][3] = state_after(value, made[-1][3])
            made[-1][4] = state_after(value, made[-1][4])
        if made:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            columns = [pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "row", "outside", "inside"])


def _start_states(functions: DataFrame) -> DataFrame:
    """(file, block, state): the state at the front of every split, from the functions of the ones before it."""
    parts = F.array_sort(F.collect_list(F.struct("block", "row", "outside", "inside")))
    files = functions.groupBy("file").agg(parts.alias("parts"))

    def step(held, part):
        after = F.when(held.state == INSIDE, part.inside).otherwise(part.outside)
        here = F.struct(part.block.alias("block"), held.state.alias("state"))
        return F.struct(after.alias("state"), F.concat(held.starts, F.array(here)).alias("starts"))

    first = F.struct(F.lit(OUTSIDE).alias("state"), F.array().cast("array<struct<block:bigint,state:int>>").alias("starts"))
    starts = files.select("file", F.explode(F.aggregate("parts", first, step).starts).alias("start"))
    # Parts of one split follow each other: the first one's state is that of the split.
    rank = F.row_number().over(Window.partitionBy("file", "start.block").orderBy("at"))
    placed = starts.withColumn("at", F.monotonically_increasing_id()).withColumn("rank", rank)
    return placed.filter("rank = 1").select("file", F.col("start.block").alias("block"), F.col("start.state").alias("state"))


WHOLE, HEAD, OPEN = range(3)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, row, kind, value): whole records, the lines a split begins with inside a record, and its open end."""
    held: list | None = None  # file, block, first row, kind, lines, state

    def taken(record: list) -> list:
        return [*record[:4], "\n".join(record[4])]

    for batch in batches:
        made = []
        for value, file, block, row, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if start is None:
                raise ValueError("the files were split another way the second time; read them again")
            if held is not None and (held[0], held[1]) != (file, block):
                if held[4]:
                    held[3] = OPEN if held[3] == WHOLE and held[5] == INSIDE else held[3]
                    made.append(taken(held))
                held = None
            if held is None:
                held = [file, block, row, HEAD if start == INSIDE else WHOLE, [], start]
            elif held[5] == OUTSIDE:
                if held[4]:
                    made.append(taken(held))
                held = [file, block, row, WHOLE, [], OUTSIDE]
            held[4].append(value)
            held[5] = state_after(value, held[5])
        if made:
            yield _batch(made)
    if held is not None and held[4]:
        held[3] = OPEN if held[3] == WHOLE and held[5] == INSIDE else held[3]
        yield _batch([taken(held)])


def _batch(made: list[list]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], names=["file", "block", "row", "kind", "value"])


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, file, block, row) of every record; a record with line breaks in quotes is one value.

    Large files are read in splits. A quote that is never closed makes the rest of its file one record.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    placed = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    placed = placed.withColumn("row", F.monotonically_increasing_id())
    functions = placed.mapInArrow(_split_functions, "file string, block bigint, row bigint, outside int, inside int")
    starts = _start_states(functions)
    # One short row a split; the lines stay where they are read.
    known = placed.join(F.broadcast(starts), ["file", "block"], "left").select("value", "file", "block", "row", "state")
    found = known.mapInArrow(_records, "file string, block bigint, row bigint, kind int, value string")
    whole = found.filter(F.col("kind") == WHOLE).select("value", "file", "block", "row")
    # What borders cut: an open end and the heads up to the next open end of the file belong together.
    cut = found.filter(F.col("kind") != WHOLE)
    before = Window.partitionBy("file").orderBy("block", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = F.last(F.when(F.col("kind") == OPEN, F.struct("block", "row")), ignorenulls=True).over(before)
    joined = cut.withColumn("owner", owner).groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("block", "row", "value"))).alias("parts"))
    texts = F.array_join(F.transform("parts", lambda p: p.value), "\n")
    whole_again = joined.select(texts.alias("value"), "file", F.col("owner.block").alias("block"), F.col("owner.row").alias("row"))
    # A file's last line break ends its last record.
    return whole.union(whole_again).withColumn("value", F.regexp_replace("value", r"\r\z", ""))
