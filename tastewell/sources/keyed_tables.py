"""Tables with one row a key that loads merge into: only what a load touches is written anew.

The rows stand in units, each a folder of files with a range of keys; units are in the order of the keys and do not overlap. A
manifest names the units and is never changed: a load writes new folders for the units that hold its keys and
then a manifest with the next number, so readers see the table before the load or after it. Folders that are
not touched stay as they are. A unit that has grown is cut, neighbours that are touched together are dealt anew.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell.session import written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MANIFESTS = "_manifests"
ROWS_PER_UNIT = 4_000_000
ROWS_PER_TASK = 200_000  # a task writes several units, if they are small
STRETCH, PIECE, UNIT = "_stretch", "_piece", "_unit"


@dataclass
class Unit:
    """Keys from ``low`` up to the next unit's, in the files below ``path``."""

    low: list
    rows: int
    path: str


class ChangedMeanwhile(RuntimeError):
    """Another load has switched the table since this one began; nothing of this load is visible."""


def _place(spark: SparkSession, path: str):
    here = spark._jvm.org.apache.hadoop.fs.Path(path)
    return here, here.getFileSystem(spark._jsc.hadoopConfiguration())


def version(spark: SparkSession, path: str) -> int:
    """Number of the newest manifest; 0 if the table does not exist."""
    here, files = _place(spark, f"{path}/{MANIFESTS}")
    if not files.exists(here):
        return 0
    names = (s.getPath().getName() for s in files.listStatus(here))
    return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)


def units(spark: SparkSession, path: str, number: int | None = None) -> list[Unit]:
    """The units of a version, the newest by default, in the order of their keys."""
    number = version(spark, path) if number is None else number
    if not number:
        return []
    here, files = _place(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    stream = files.open(here)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return [Unit(**u) for u in json.loads(text)]


def _switch(spark: SparkSession, path: str, number: int, found: list[Unit]) -> None:
    """Makes a version the newest; fails if another one has taken its number."""
    target, files = _place(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
    draft, _ = _place(spark, f"{path}/{MANIFESTS}/.{uuid.uuid4().hex}")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps([asdict(u) for u in found]).encode()))
    out.close()
    if files.exists(target) or not files.rename(draft, target):
        files.delete(draft, False)
        raise ChangedMeanwhile(f"{path} has a version {number} already")


def read_keyed(spark: SparkSession, path: str, schema, number: int | None = None) -> DataFrame:
    """The rows of a version, the newest by default."""
    found = units(spark, path, number)
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{u.path}" for u in found])


def unit_of(lows: list[list], keys: Sequence[str]) -> Column:
    """Index of the unit that a key belongs to: the last one that does not begin after it."""
    if len(lows) < 2:
        return F.lit(0)
    columns = [np.array([low[i] for low in lows]) for i in range(len(keys))]

    @F.pandas_udf("int")
    def index(*values: pd.Series) -> pd.Series:
        # Binary search of all keys at once; the first column that differs decides.
        low, high = np.zeros(len(values[0]), np.int64), np.full(len(values[0]), len(columns[0]), np.int64)
        while (low < high).any():
            middle = (low + high) // 2
            at = np.minimum(middle, len(columns[0]) - 1)
            after, same = np.zeros(len(low), bool), np.ones(len(low), bool)
            for column, value in zip(columns, values, strict=True):
                held, key = column[at], value.to_numpy()
                after |= same & (held > key)
                same &= held == key
            open_ = low < high
            high = np.where(open_ & after, middle, high)
            low = np.where(open_ & ~after, middle + 1, low)
        return pd.Series(np.maximum(low - 1, 0).astype(np.int32))

    return index(*[F.col(k) for k in keys])


def _written_units(rows: DataFrame, path: str, keys: Sequence[str], size: int, rows_per_unit: int, partition: list[str]) -> list[tuple]:
    """Writes at most ``size`` rows in ranges of their keys and returns (partition values, low, rows, path) of every range, in order.

    A task sorts one range and cuts it into units, so there are no more tasks than the rows need, however small the units.
    """
    spark = rows.sparkSession
    folder = f"data/{uuid.uuid4().hex}"
    tasks = max(1, -(-size // max(rows_per_unit, ROWS_PER_TASK)))
    ordered = rows.repartitionByRange(tasks, *partition, *keys).sortWithinPartitions(*partition, *keys)
    # The lower 33 bits are the place in the task, the upper ones its number.
    place = F.monotonically_increasing_id()
    numbered = ordered.withColumn(PIECE, place)
    task, unit = F.shiftrightunsigned(PIECE, 33), F.floor(F.col(PIECE).bitwiseAND(F.lit((1 << 33) - 1)) / F.lit(rows_per_unit))
    dealt = numbered.withColumn(PIECE, task * F.lit(1 << 33) + unit).sortWithinPartitions(*partition, PIECE, *keys)
    dealt.write.partitionBy(*partition, PIECE).parquet(f"{path}/{folder}")
    back = spark.read.schema(dealt.schema).parquet(f"{path}/{folder}")
    found = back.groupBy(*partition, PIECE).agg(F.min(F.struct(*keys)).alias("low"), F.count("*").alias("n")).collect()  # one a unit
    out = []
    for r in found:
        names = "".join(f"/{p}={r[p]}" for p in [*partition, PIECE])
        out.append((tuple(r[p] for p in partition), list(r["low"]), r["n"], folder + names))
    return sorted(out, key=lambda u: (u[0], u[1]))


def replace_keyed(rows: DataFrame, path: str, keys: Sequence[str], rows_per_unit: int = ROWS_PER_UNIT) -> None:
    """Makes the rows, one a key, the whole table; its earlier version is kept until ``vacuum``."""
    spark = rows.sparkSession
    before = version(spark, path)
    held = written(rows, "keyed-rows")
    found = _written_units(held, path, keys, held.count(), rows_per_unit, [])
    _switch(spark, path, before + 1, [Unit(low, n, folder) for _, low, n, folder in found])


def merge_keyed(
    rows: DataFrame, path: str, keys: Sequence[str], add: Sequence[str] = (), rows_per_unit: int = ROWS_PER_UNIT
) -> DataFrame:
    """Merges rows, one a key and none null, into the table and returns what changed: keys, ``old`` and ``new`` as structs.

    A row takes the place of the stored one with its key. Columns in ``add`` are summed up with the stored ones
    instead, and rows all of whose sums are zero go. Units without a key of the rows are neither read nor written.
    """
    spark = rows.sparkSession
    before = version(spark, path)
    stored = units(spark, path, before)
    payload = [c for c in rows.columns if c not in keys]
    lows = [u.low for u in stored]
    fresh = written(rows.withColumn(UNIT, unit_of(lows, keys)), "load")
    counts = {r[UNIT]: r["count"] for r in fresh.groupBy(UNIT).count().collect()}  # at most one a unit
    touched = sorted(counts) if stored else []
    if not counts:
        return fresh.select(*keys, F.struct(*payload).alias("old"), F.struct(*payload).alias("new")).limit(0)
    # Touched units that stand side by side are dealt out together.
    stretch, number = {}, -1
    for i, unit in enumerate(touched):
        number += i == 0 or touched[i - 1] != unit - 1
        stretch[unit] = number
    if stored:
        table = spark.read.schema(rows.schema).parquet(*[f"{path}/{stored[u].path}" for u in touched])
        table = table.withColumn(UNIT, unit_of(lows, keys))
    else:
        table, stretch = fresh.limit(0), {0: 0}
    whose = F.lit(0)
    if len(set(stretch.values())) > 1:
        of_unit = [stretch.get(u, -1) for u in range(len(stored))]
        whose = F.get(F.lit(of_unit), F.col(UNIT))
    both = table.withColumn("_new", F.lit(False)).unionByName(fresh.withColumn("_new", F.lit(True))).withColumn(STRETCH, whose)
    old = F.max(F.when(~F.col("_new"), F.struct(*payload))).alias("old")
    new = F.max(F.when(F.col("_new"), F.struct(*payload))).alias("new")
    matched = written(both.groupBy(STRETCH, *keys).agg(old, new), "matched")
    values = []
    for c in payload:
        if c in add:
            values.append((F.coalesce(F.col(f"old.{c}"), F.lit(0)) + F.coalesce(F.col(f"new.{c}"), F.lit(0))).cast(rows.schema[c].dataType).alias(c))
        else:
            values.append(F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c))
    merged = matched.select(STRETCH, *keys, *values).select(STRETCH, *rows.columns)
    if add:
        merged = merged.filter(" OR ".join(f"`{c}` <> 0" for c in add))
    size = sum(counts.values()) + sum(stored[u].rows for u in touched)
    made = _written_units(merged, path, keys, size, rows_per_unit, [STRETCH])
    kept = [u for i, u in enumerate(stored) if i not in set(touched)]
    found = sorted([*kept, *(Unit(low, n, folder) for _, low, n, folder in made)], key=lambda u: u.low)
    _switch(spark, path, before + 1, found)
    return matched.filter("new IS NOT NULL").select(*keys, "old", "new")


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Deletes what no version but the newest ``keep`` needs; the number of folders deleted."""
    newest = version(spark, path)
    needed = {u.path for number in range(max(1, newest - keep + 1), newest + 1) for u in units(spark, path, number)}
    deleted = 0
    for number in range(newest - keep, 0, -1):
        here, files = _place(spark, f"{path}/{MANIFESTS}/{number:012d}.json")
        if not files.exists(here):
            break
        for unit in units(spark, path, number):
            folder, _ = _place(spark, f"{path}/{unit.path}")
            if unit.path not in needed and files.exists(folder):
                files.delete(folder, True)
                deleted += 1
        files.delete(here, False)
    return deleted
