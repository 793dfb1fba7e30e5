"""Rounding on decimals: half away from zero, never on a binary fraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, places: int) -> Column:
    """Round through a wide decimal and hand back a double."""
    return F.round(value.cast("decimal(30,12)"), places).cast("double")


def ratio(numerator: Column, denominator: Column, places: int, scale: int = 1) -> Column:
    """``scale * numerator / denominator`` of two counts, NULL for a zero denominator."""
    top = (F.lit(scale) * numerator).cast("decimal(24,4)")
    return F.round(
        F.try_divide(top, denominator.cast("decimal(20,0)")).cast("decimal(36,16)"), places
    ).cast("double")


def share(part: Column, whole: Column, places: int = 1) -> Column:
    return ratio(part, whole, places, scale=100)


def plain_number(col: Column) -> Column:
    """True for an unsigned plain decimal, blanks around it allowed."""
    return col.rlike(r"\A\s*[0-9]+(\.[0-9]+)?\s*\z")
