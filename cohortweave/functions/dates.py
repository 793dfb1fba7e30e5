"""Dates kept as text in the facts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_month_year(col: Column) -> Column:
    """``07/MAR/2020`` (month in any case) to a date, NULL when malformed."""
    return F.try_to_date(col, "d/MMM/yyyy")


def study_date(col: Column) -> Column:
    """The two spellings in use: day/Mon/year, else ISO; NULL when neither fits."""
    return F.coalesce(day_month_year(col), F.try_to_date(col, "yyyy-MM-dd"))
