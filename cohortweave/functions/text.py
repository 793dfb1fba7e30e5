"""String helpers with the null rules the study queries rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def substring_from(col: Column, pattern: str, group: int = 1) -> Column:
    """The part of ``col`` matched by ``pattern``; NULL (not '') when nothing matches."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def syn_suffix(subjid: Column) -> Column:
    """The trailing ``SYN-<digits>`` a participant keeps from one study to the next."""
    return substring_from(subjid, r"SYN-[0-9]+\z", 0)


def has_text(col: Column) -> Column:
    """True for a cell that is neither null nor the empty string."""
    return col.isNotNull() & (col != "")


def blank_to_null(col: Column) -> Column:
    return F.when(col != "", col)


def ordered_list(value: str, order: str | None = None, sep: str = ", ") -> Column:
    """Concatenate column ``value`` over the group in a stated order; NULL for no rows."""
    return F.expr(f"listagg({value}, '{sep}') WITHIN GROUP (ORDER BY {order or value})")


def is_yes(col: Column) -> Column:
    return col.isin("Y", "Yes", "1")


def is_no(col: Column) -> Column:
    return col.isin("N", "No", "2")
