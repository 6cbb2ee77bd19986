"""Ordered groups without an unbounded sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Up to this limit Spark itself trims each group before the shuffle.
MAP_SIDE_SETTING = "spark.sql.optimizer.windowGroupLimitThreshold"


def top_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    salts: int = 1,
) -> DataFrame:
    """The first ``n`` rows of every group in the given total order, numbered from 1.

    Spark trims each group to ``n`` rows inside every map task, so a hot group never reaches
    one task whole: at most ``n`` rows per map task do. With ``salts`` > 1 each group is first
    cut down in that many independent parts, which bounds the final sort by ``n * salts`` rows
    however many map tasks there are. Use it where a single group may span the whole table.
    """
    parts = df
    if n > int(df.sparkSession.conf.get(MAP_SIDE_SETTING)):
        salts = max(salts, 64)
    if salts > 1:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)))
        window = Window.partitionBy(*keys, "_salt").orderBy(*order)
        parts = (
            salted.withColumn("_part_rank", F.row_number().over(window))
            .filter(F.col("_part_rank") <= n)
            .drop("_salt", "_part_rank")
        )
    window = Window.partitionBy(*keys).orderBy(*order)
    return parts.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[tuple[Column, bool]],
    order: Sequence[Column],
    name: str = "ordinal",
) -> DataFrame:
    """Number every row of every group in order, without sorting a whole group in one task.

    ``buckets`` is a leading part of the order, as (expression, descending) pairs. Rows are
    counted per bucket, the counts are summed up along the buckets in two levels, so that no window holds all
    buckets of a key, and only the rows inside one bucket are sorted by ``order``. Null keys and bucket values are values like any other.
    """
    labels = [f"_bucket_{i}" for i in range(len(buckets))]
    cut = df.withColumns({label: expr for label, (expr, _) in zip(labels, buckets)})
    along = [
        F.desc(label) if descending else F.asc(label)
        for label, (_, descending) in zip(labels, buckets)
    ]
    counts = cut.groupBy(*keys, *labels).agg(F.count("*").alias("_rows"))
    ahead = (Window.unboundedPreceding, -1)
    # Two levels: the buckets of one first value among themselves, and the first values of a key.
    among = Window.partitionBy(*keys, labels[0]).orderBy(*along).rowsBetween(*ahead)
    along_key = Window.partitionBy(*keys).orderBy(along[0]).rowsBetween(*ahead)
    totals = counts.groupBy(*keys, labels[0]).agg(F.sum("_rows").alias("_all")).withColumn("_before", F.sum("_all").over(along_key))
    totals = totals.select("_before", *[F.col(c).alias(f"_first_{c}") for c in (*keys, labels[0])])
    within = counts.withColumn("_within", F.sum("_rows").over(among)).join(
        totals, [F.col(c).eqNullSafe(F.col(f"_first_{c}")) for c in (*keys, labels[0])]
    )
    offset = F.coalesce("_before", F.lit(0)) + F.coalesce("_within", F.lit(0))
    offsets = within.select(*keys, *labels, offset.alias("_offset"))
    inside = Window.partitionBy(*keys, *labels).orderBy(*order)
    named = offsets.select("_offset", *[F.col(c).alias(f"_of_{c}") for c in (*keys, *labels)])
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in (*keys, *labels)]
    return (
        cut.join(named, same)
        .withColumn(name, F.col("_offset") + F.row_number().over(inside))
        .select(*df.columns, name)
    )
