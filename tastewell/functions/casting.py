"""Casts for text fields that may be malformed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
VISIBLE_TEXT = r"(?U)\S"


def to_long(text: Column) -> Column:
    """Whole number or null; text such as ``4.0`` is not a whole number."""
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def to_finite_double(text: Column) -> Column:
    """Number or null; NaN, infinities and type suffixes count as malformed."""
    value = text.try_cast("double")
    return F.when(text.rlike(NUMBER_TEXT) & (F.abs(value) < float("inf")), value)


def is_blank(text: Column) -> Column:
    """Null, empty, or white space of any kind only."""
    return ~F.coalesce(text.rlike(VISIBLE_TEXT), F.lit(False))


def first_non_empty(*texts: Column) -> Column:
    """The first of several columns that is neither null nor empty."""
    return F.coalesce(*[F.nullif(text, F.lit("")) for text in texts])
