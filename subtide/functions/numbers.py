"""Ratios, the roundings the reports use, and numbers as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0))


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part`` in percent of ``whole``, rounded half up."""
    return F.round(ratio(part.cast("double") * 100.0, whole), places)


def round_half_even(value: Column, places: int) -> Column:
    """Round the scaled binary value half to even, as numeric array libraries do."""
    scale = float(10**places)
    return F.rint(value * scale) / scale


def round_as_printed(value: Column, places: int) -> Column:
    """The number that fixed-point formatting with ``places`` digits shows."""
    printed = F.format_number(value, places)
    return F.regexp_replace(printed, ",", "").cast("double")


def decimal_text(value: Column, places: int) -> Column:
    """Text of a double already rounded to ``places`` (0 to 2) digits, never in
    exponent form: at least one digit after the point, no other trailing zero."""
    if places <= 1:
        return value.cast("decimal(38,1)").cast("string")
    return F.regexp_replace(value.cast("decimal(38,2)").cast("string"), "0$", "")


def money_text(value: Column) -> Column:
    """Whole dollars with thousands separators, for display."""
    return F.concat(F.lit("$"), F.format_number(value, 0))


def percent_text(value: Column, places: int = 1) -> Column:
    """A percentage with a fixed number of digits, for display."""
    return F.concat(F.format_number(value, places), F.lit("%"))
