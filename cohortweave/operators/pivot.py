"""Selecting a domain's facts and turning them back into columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def domain(facts: DataFrame, name: str, study: str | None = None,
           variables: Iterable[str] | None = None) -> DataFrame:
    """Facts of one domain. Literal filters, so a store written by
    ``sources.store`` is pruned by directory and by row-group statistics."""
    out = facts.where(F.col("domain") == name)
    if study is not None:
        out = out.where(F.col("source_study") == study)
    if variables is not None:
        out = out.where(F.col("standard_var").isin(*variables))
    return out


def value_of(variable: str) -> Column:
    """The group's (greatest) value of one variable."""
    return F.max(F.when(F.col("standard_var") == variable, F.col("value")))


def eav_pivot(facts: DataFrame, keys: Iterable[str], outputs: Mapping[str, str],
              **extra: Column) -> DataFrame:
    """One row per ``keys``; ``outputs`` maps a new column to the variable it holds.

    Only max-like aggregates are used, so each map task sends at most one row per
    key and a key with very many facts costs no more than any other.
    """
    aggregates = [value_of(var).alias(name) for name, var in outputs.items()]
    aggregates += [col.alias(name) for name, col in extra.items()]
    return facts.groupBy(*keys).agg(*aggregates)
