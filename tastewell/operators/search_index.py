"""Search over stored listings by the three-letter pieces that a match must hold.

The listing is stored in pages. For every piece of three characters the postings name the lines that hold it. A
regular expression is taken apart into pieces that every match has, with alternatives where it has them; lines that
hold what is needed are candidates, only their pages are read, and the expression itself decides. An
expression that needs no piece is searched for in all pages.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as parts
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastewell.operators.reports import search_listing, valid_pattern

ROWS_PER_PAGE = 50_000
PIECE = 3
LONGEST_CLAUSE = 16  # alternatives that are told apart


@dataclass(frozen=True)
class Needed:
    """All of ``pieces``, and for each of ``either`` one of its alternatives."""

    pieces: frozenset[str] = frozenset()
    either: tuple[tuple[Needed, ...], ...] = ()

    def __and__(self, other: Needed) -> Needed:
        return Needed(self.pieces | other.pieces, self.either + other.either)

    def empty(self) -> bool:
        return not self.pieces and not self.either

    def all_pieces(self) -> set[str]:
        return set(self.pieces).union(*(n.all_pieces() for group in self.either for n in group))

    def condition(self, held: dict[str, Column]) -> Column:
        out = F.lit(True)
        for piece in sorted(self.pieces):
            out = out & held[piece]
        for group in self.either:
            one = F.lit(False)
            for alternative in group:
                one = one | alternative.condition(held)
            out = out & one
        return out


def _pieces_of(text: str) -> Needed:
    """Pieces of a literal text; only plain letters, digits and signs, whose case is folded alike everywhere."""
    runs = re.findall(r"[\x20-\x7e]+", text.lower())
    return Needed(frozenset(run[i : i + PIECE] for run in runs for i in range(len(run) - PIECE + 1)))


def _of_tokens(tokens) -> Needed:
    needed, literal = Needed(), ""
    for kind, value in tokens:
        if kind is parts.LITERAL:
            literal += chr(value)
            continue
        needed, literal = needed & _pieces_of(literal), ""
        if kind is parts.SUBPATTERN:
            needed &= _of_tokens(value[-1])
        elif kind in (parts.MAX_REPEAT, parts.MIN_REPEAT, parts.POSSESSIVE_REPEAT) and value[0] > 0:
            needed &= _of_tokens(value[2])
        elif kind is parts.ATOMIC_GROUP:
            needed &= _of_tokens(value)
        elif kind is parts.BRANCH:
            group = tuple(_of_tokens(branch) for branch in value[1])
            if len(group) <= LONGEST_CLAUSE and not any(n.empty() for n in group):
                needed &= Needed(either=(group,))
    return needed & _pieces_of(literal)


def needed_pieces(query: str, literal: bool = False) -> Needed:
    """What every match of the query holds; nothing, where that cannot be told."""
    if literal:
        return _pieces_of(query)
    if "(?" in query or "\\" in query or re.search(r"\[[^]]*(\[|&&)", query):
        # Flags, look-arounds, escapes and classes of classes differ between the engines; these are searched for everywhere.
        return Needed()
    try:
        return _of_tokens(parser.parse(query))
    except (re.error, RecursionError, OverflowError):
        return Needed()


def _line(user: Column, details: Column) -> Column:
    """Id and details of a line with a sign between them that no piece holds."""
    return F.lower(F.concat(user.cast("string"), F.lit("\n"), details))


def store_listing(listing: DataFrame, root: str, rows_per_page: int = ROWS_PER_PAGE) -> None:
    """Writes a listing (``userId, total, details``) in pages of consecutive users, and its postings by piece."""
    pages = max(1, -(-listing.count() // rows_per_page))
    dealt = listing.repartitionByRange(pages, "userId").sortWithinPartitions("userId").withColumn("page", F.spark_partition_id())
    dealt.write.partitionBy("page").parquet(f"{root}/pages")
    stored = listing.sparkSession.read.parquet(f"{root}/pages")
    line = _line(F.col("userId"), F.coalesce("details", F.lit("")))
    places = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length("line") - PIECE + 1))
    pieces = F.array_distinct(F.transform(places, lambda i: F.substring(F.col("line"), i, F.lit(PIECE))))
    postings = stored.select("userId", "page", line.alias("line")).select("userId", "page", F.explode(pieces).alias("piece"))
    kept = postings.filter(F.col("piece").rlike(r"^[\x20-\x7e]{3}$"))
    # A frequent piece spreads over several files; row groups in the order of the pieces are skipped by their statistics.
    kept.repartitionByRange("piece", "userId").sortWithinPartitions("piece", "userId").write.parquet(f"{root}/postings")


def search_stored(spark: SparkSession, root: str, query: str, literal: bool = False) -> DataFrame:
    """The stored lines that match, as ``search_listing`` finds them in the whole listing."""
    pages = spark.read.parquet(f"{root}/pages")
    needed = needed_pieces(query, literal)
    if needed.empty() or not (literal or valid_pattern(pages, query)):
        return search_listing(pages.drop("page"), query, literal)
    asked = sorted(needed.all_pieces())
    held = spark.read.parquet(f"{root}/postings").filter(F.col("piece").isin(asked))
    flags = [F.max(F.col("piece") == piece).alias(f"has_{i}") for i, piece in enumerate(asked)]
    lines = held.groupBy("userId", "page").agg(*flags)
    fit = lines.filter(needed.condition({piece: F.col(f"has_{i}") for i, piece in enumerate(asked)})).select("userId", "page")
    numbers = [r["page"] for r in fit.select("page").distinct().collect()]  # at most one a page
    few = pages.filter(F.col("page").isin(numbers)).join(fit.select("userId"), "userId", "left_semi")
    return search_listing(few.drop("page"), query, literal)
