"""The three CSV inputs, with rejects, and last-write-wins by position in the files.

Every reader returns ``(rows, rejects)``. Rejects keep the raw text and a reason, so nothing
is dropped silently. Fields are read as text and cast afterwards: one bad row never fails a
load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastewell import schemas
from tastewell.functions.casting import VISIBLE_TEXT, is_blank, to_finite_double, to_long
from tastewell.sources.quoted_lines import read_records

RAW = "_raw"
CORRUPT = "_corrupt"
POSITION = "_position"


def _read_text_fields(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str],
    multi_line: bool,
    check_header: bool = False,
) -> DataFrame:
    """All columns as text, plus the raw text of rows with too few or too many fields.

    ``check_header`` fails on a file whose header differs; otherwise position counts.
    """
    fields = [T.StructField(name, T.StringType()) for name in [*columns, RAW]]
    return spark.read.csv(
        path,
        schema=T.StructType(fields),
        header=True,
        enforceSchema=not check_header,
        quote='"',
        escape='"',
        multiLine=multi_line,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=RAW,
        maxCharsPerColumn=-1,
    )


def _by_header(
    spark: SparkSession, path: str | list[str], columns: Sequence[str], multi_line: bool
) -> DataFrame:
    """As above, but columns are found by their name in the header.

    Only a header is read to find the order; other columns are ignored. All files must have
    the same header.
    """
    header = spark.read.csv(path, header=True, quote='"', escape='"').columns
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"columns missing from the header: {', '.join(missing)}")
    return _read_text_fields(spark, path, header, multi_line, check_header=True)


def _read_lines(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """As ``_read_text_fields``, line by line: files are split, and every line keeps its raw text.

    Each line is parsed for itself with all columns, so what a caller selects cannot change which
    rows are good. Lines like the first one are headers.
    """
    lines = spark.read.text(path)
    header = lines.first()
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1"}
    kept = lines.filter(F.col("value").rlike(VISIBLE_TEXT) & (F.col("value") != F.lit(header["value"] if header else "")))
    fields = F.from_csv("value", F.lit(schema), options)
    return kept.select("*", fields.alias("_fields"), "_metadata").select(
        *[F.col(f"_fields.{c}").alias(c) for c in columns], F.col("value").alias(RAW), "_metadata"
    )


def _read_records(spark: SparkSession, path: str | list[str], columns: Sequence[str]) -> DataFrame:
    """As ``_read_lines``, but a record may hold line breaks in quotes; files are split all the same."""
    records = read_records(spark, path)
    schema = ", ".join(f"`{c}` string" for c in [*columns, CORRUPT])
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, "maxCharsPerColumn": "-1", "multiLine": "true"}
    # The first record of every file is its header.
    first = records.filter("block = 0").groupBy("file").agg(F.min("row").alias("_first"))
    body = records.join(F.broadcast(first), "file", "left").filter(F.col("_first").isNull() | (F.col("row") != F.col("_first")) | (F.col("block") != 0))
    kept = body.filter(F.length(F.regexp_replace("value", "[\\r\\n]", "")) > 0)
    fields = F.from_csv("value", F.lit(schema), options)
    place = F.struct(F.col("file").alias("file_path"), F.col("block").alias("file_block_start")).alias("_metadata")
    return kept.select("*", fields.alias("_fields")).select(*[F.col(f"_fields.{c}").alias(c) for c in columns], F.col(f"_fields.{CORRUPT}").alias(RAW), place, F.col("row").alias("_row"))


def _unbalanced() -> Column:
    """An odd number of quotes: a line that is a part of a row with line breaks, or broken."""
    quotes = F.length(RAW) - F.length(F.translate(RAW, '"', ""))
    return F.col(RAW).isNotNull() & (quotes % 2 == 1)


def _with_position(df: DataFrame, path: str | list[str]) -> DataFrame:
    """Where a row stands: file, split of the file, row within the split.

    One task reads one split from start to end, so the three order rows as the files do. Files
    given one by one count in the order given, those of one folder by their path.
    """
    given = [path] if isinstance(path, str) else list(path)
    file = F.col("_metadata.file_path")
    places = [F.when(file.contains(p.split(":")[-1].rstrip("/")), F.lit(i)) for i, p in enumerate(given)]
    return df.withColumn(
        POSITION,
        F.struct(
            F.coalesce(*places, F.lit(len(given))).alias("given"),
            file.alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            (F.col("_row") if "_row" in df.columns else F.monotonically_increasing_id()).alias("row"),
        ),
    )


def _field_count(raw: Column) -> Column:
    """Number of comma-separated fields, commas inside quotes not counted."""
    unquoted = F.regexp_replace(raw, r'"(?:[^"]|"")*"', "")
    return F.size(F.split(unquoted, ",", -1))


def _is_short(needed: int) -> Column:
    return F.col(RAW).isNotNull() & (_field_count(F.col(RAW)) < needed)


def _text(name: str) -> Column:
    """An unquoted empty field is an empty text, as in plain CSV."""
    return F.coalesce(F.col(name), F.lit(""))


def _raw_text(columns: Sequence[str]) -> Column:
    """The row as text for the rejects; rebuilt from its fields where it was well-formed."""
    return F.coalesce(F.col(RAW), F.concat_ws(",", *[_text(c) for c in columns]))


def _partition(df: DataFrame, source: str, columns: Sequence[str], reason: Column, good):
    marked = df.withColumn("_reason", reason)
    rows = marked.filter(F.col("_reason").isNull()).select(*good)
    rejects = marked.filter(F.col("_reason").isNotNull()).select(
        F.lit(source).alias("source"),
        F.col("_reason").alias("reason"),
        _raw_text(columns).alias("raw"),
    )
    return rows, rejects


def _read_quoted(spark: SparkSession, path: str | list[str], columns: Sequence[str], multi_line: bool | None) -> DataFrame:
    if multi_line is None:
        return _read_records(spark, path, columns)
    return _read_text_fields(spark, path, columns, True) if multi_line else _read_lines(spark, path, columns)


def read_movies(
    spark: SparkSession, path: str | list[str], multi_line: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Movies: at least three fields, extra fields ignored, whole-number id.

    Titles may hold line breaks; files are split and records put together where a split cuts them. With
    ``multi_line`` on a file is read whole by one task; with it off, line by line, and the
    lines of a row with line breaks then are rejects.
    """
    columns = ["movieId", "title", "genres"]
    read = _read_quoted(spark, path, columns, multi_line)
    df = _with_position(read, path)
    reason = (
        F.when(F.lit(multi_line is False) & _unbalanced(), "unbalanced quote")
        .when(_is_short(3), "too few fields")
        .when(to_long(F.col("movieId")).isNull(), "movieId is not a whole number")
    )
    return _partition(
        df,
        "movies",
        columns,
        reason,
        [
            to_long(F.col("movieId")).alias("movieId"),
            _text("title").alias("title"),
            _text("genres").alias("genres"),
            POSITION,
        ],
    )


def read_ratings(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Ratings by column name; a row with a missing or malformed number is rejected.

    The files are split: numeric fields hold no line breaks.
    """
    columns = ["userId", "movieId", "rating", "timestamp"]
    df = _with_position(_by_header(spark, path, columns, multi_line=False), path)
    parsed = {
        "userId": to_long(F.col("userId")),
        "movieId": to_long(F.col("movieId")),
        "rating": to_finite_double(F.col("rating")),
        "ts": to_long(F.col("timestamp")),
    }
    reason = F.coalesce(
        *[F.when(value.isNull(), f"{name} is not a number") for name, value in parsed.items()]
    )
    good = [value.alias(name) for name, value in parsed.items()]
    return _partition(df, "ratings", columns, reason, [*good, POSITION])


def read_tags(
    spark: SparkSession, path: str | list[str], multi_line: bool | None = None
) -> tuple[DataFrame, DataFrame]:
    """Tags: at least four fields, tag not blank and kept untrimmed, whole-number ids.

    A malformed time becomes 0, as for stored tags without one.
    """
    columns = ["userId", "movieId", "tag", "timestamp"]
    df = _read_quoted(spark, path, columns, multi_line)
    reason = (
        F.when(F.lit(multi_line is False) & _unbalanced(), "unbalanced quote")
        .when(_is_short(4), "too few fields")
        .when(is_blank(F.col("tag")), "blank tag")
        .when(to_long(F.col("userId")).isNull(), "userId is not a number")
        .when(to_long(F.col("movieId")).isNull(), "movieId is not a number")
    )
    return _partition(
        df,
        "tags",
        columns,
        reason,
        [
            to_long(F.col("userId")).alias("userId"),
            to_long(F.col("movieId")).alias("movieId"),
            F.col("tag"),
            F.coalesce(to_long(F.col("timestamp")), F.lit(0)).cast("bigint").alias("ts"),
        ],
    )


def line_counts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines per movie id as it stands in the ratings files, readable or not: ``movie, lines``.

    Every line with two fields or more counts, but for the header; the second field is the movie.
    """
    lines = spark.read.text(path)
    header = lines.first()
    fields = F.split(F.trim("value"), ",", -1)
    counted = lines.filter((F.size(fields) >= 2) & (F.col("value") != F.lit(header["value"] if header else "")))
    return counted.groupBy(fields[1].alias("movie")).agg(F.count("*").alias("lines"))


def last_written(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the one standing last in the files.

    A maximum, not a window: copies of one key are combined before the shuffle, however many.
    """
    payload = [c for c in df.columns if c not in (*keys, POSITION)]
    last = F.max(F.struct(F.col(POSITION), *[F.col(c) for c in payload])).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in payload])


def load_csv(
    spark: SparkSession, movies: str | list[str], ratings: str | list[str], tags: str | list[str]
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The three tables with unique keys, and all rejects together."""
    movie_rows, movie_rejects = read_movies(spark, movies)
    rating_rows, rating_rejects = read_ratings(spark, ratings)
    tag_rows, tag_rejects = read_tags(spark, tags)
    rejects = movie_rejects.unionByName(rating_rejects).unionByName(tag_rejects)
    return (
        schemas.conform(last_written(movie_rows, ["movieId"]), schemas.MOVIES, "movies"),
        schemas.conform(
            last_written(rating_rows, ["userId", "movieId"]), schemas.RATINGS, "ratings"
        ),
        schemas.conform(tag_rows, schemas.TAGS, "tags"),
        rejects,
    )
