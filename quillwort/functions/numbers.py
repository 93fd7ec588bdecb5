"""Shares, rounding and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, base: Column, digits: int = 1) -> Column:
    """100 * part / base, rounded half to even; 0 where the base is 0 or missing."""
    return F.when(F.coalesce(base, F.lit(0)) == 0, F.lit(0.0)).otherwise(F.bround(100.0 * part / base, digits))


def grouped_int(n: Column) -> Column:
    """An integer with points between thousands."""
    return F.translate(F.format_number(n, 0), ",", ".")


def percent_text(p: Column) -> Column:
    """A share with one decimal after a comma, and a percent sign."""
    return F.concat(F.replace(F.format_number(p, 1), F.lit("."), F.lit(",")), F.lit("%"))


def bar(p: Column, width: int = 20) -> Column:
    """A bar of ``width`` places for a share of 100."""
    full = F.greatest(F.lit(0), F.least(F.lit(width), F.bround(p / 100.0 * width, 0).cast("int")))
    return F.rpad(F.repeat(F.lit("#"), full), width, ".")


def to_double(text: Column) -> Column:
    """The number in a text, or null."""
    return text.try_cast("double")


def to_flag(text: Column) -> Column:
    """Whether a text is one of the accepted words for yes; false for null."""
    # Words that mean yes.
    return F.coalesce(F.lower(F.trim(text)).isin("1", "true", "sim", "yes"), F.lit(False))
