"""Presentation values: rounding, fixed decimals, separators, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tastewell.constants import NOT_AVAILABLE

DAY_SECONDS = 86400


def fixed(value: Column, places: int) -> Column:
    """Text with a fixed number of decimals, rounded by the exact binary value.

    ``format_number`` rounds as C and Python formats do: 2.175 is stored a little below the
    tie and shows as 2.17, 3.125 is a true tie and shows as 3.12. ``round``, ``bround`` and
    ``format_string`` go by the shortest decimal text of a double and differ on such values.
    """
    return F.replace(F.format_number(value, places), F.lit(","), F.lit(""))


def rounded(value: Column, places: int) -> Column:
    """The number that ``fixed`` shows."""
    return fixed(value, places).try_cast("double")


def signed(value: Column, places: int = 4) -> Column:
    """Text with sign and fixed decimals; null stays null."""
    return F.concat(F.when(value < 0, "").otherwise("+"), fixed(value, places))


def thousands(count: Column) -> Column:
    """``1,234,567``, or a placeholder where there is no count."""
    return F.coalesce(F.format_number(count, 0), F.lit(NOT_AVAILABLE))


def epoch_date(ts: Column) -> Column:
    """UTC calendar date of epoch seconds, null for zero, negative or missing values.

    Plain day arithmetic, so the session time zone cannot move the date.
    """
    day = F.floor(ts / F.lit(DAY_SECONDS)).cast("int")
    return F.when(ts > 0, F.date_add(F.lit("1970-01-01").cast("date"), day))
