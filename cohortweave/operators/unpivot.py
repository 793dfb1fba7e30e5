"""Wide forms to one row per recorded cell.

A source row is first packed: its mapped, non-blank cells become one array. Numbering
happens on packed rows (one per source row, not one per cell), then the arrays are
exploded. Which cells a domain takes from a form is a row of a frame, not a part of the plan. Labels and variable names are joined last from the dictionary, so they never
travel through a shuffle.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions.text import blank_to_null, has_text
from cohortweave.operators.dictionary import Entry, fed_columns, place_entries
from cohortweave.operators.sequence import nulls_last, sequence_within
from cohortweave.schema import STUDY_A, STUDY_B
from cohortweave.sources.store import cut_lineage

ROW = "source_row_number"

# STUDY_B domains that carry a visit number.
STUDY_B_VISIT_DOMAINS = frozenset({"LB", "PE", "SV", "BE", "BS", "VS", "MH", "CM"})

FORM_PARTS = 32  # a form's rows are dealt out, so that a join by form never meets one hot key
CELLS = "array<struct<mapping:int,value:string>>"


def column_or_null(df: DataFrame, name: str | None) -> Column:
    present = name is not None and name in df.columns
    return (F.col(f"`{name}`") if present else F.lit(None)).cast("string")


def mapped_cells(df: DataFrame, mapping: Iterable[Entry]) -> Column:
    """The row's non-blank mapped cells in dictionary order; columns the form lacks are
    skipped and a column mapped twice gives two cells."""
    cells = [
        F.struct(F.lit(m.ordinal).alias("mapping"), F.col(f"`{m.source_var}`").cast("string").alias("value"))
        for m in mapping if m.source_var in df.columns]
    if not cells:
        return F.array().cast(CELLS)
    return F.filter(F.array(*cells), lambda c: has_text(c["value"])).cast(CELLS)


def form_rows(df: DataFrame, form: str, fed: Collection[str], study: str) -> DataFrame:
    """A form's rows with all columns of its header as one array of texts, so that an entry finds its
    cell by place; columns no entry maps are not read."""
    if ROW not in df.columns:
        raise KeyError(f"a form needs the column {ROW}")
    names, none = header(df), F.lit(None).cast("string")

    def text(name: str) -> Column:
        return F.col(f"`{name}`").cast("string") if name in names else none

    visits = ("visit_num", "visit") if study == STUDY_A else ("visitnum",)
    return df.select(
        text("studyid").alias("studyid"), text("subjid").alias("subjid"),
        (text("scrno") if study == STUDY_A else none).alias("scrno"),
        F.lit(form).alias("source_form"), F.col(ROW).cast("bigint").alias(ROW),
        blank_to_null(text(next((c for c in visits if c in names), visits[0]))).alias("visitnum"),
        F.array(*[text(c) if c in fed else none for c in names]).cast("array<string>").alias("values"))


def header(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != ROW]


def ie_sequence(placed: DataFrame, study: str) -> DataFrame:
    """``ie_seq`` of eligibility columns: the column's place in the form (STUDY_A), or the
    place of its criterion, ``in1``, ``ex2``, ..., by first appearance (STUDY_B)."""
    known = placed.where(F.col("place") > 0)
    number = F.col("place")
    if study == STUDY_B:
        prefix = F.regexp_extract("source_var", r"^(?:in|ex)[0-9]+", 0)
        own = Window.partitionBy("source_form", "domain", F.when(prefix != "", prefix).otherwise(F.col("source_var")))
        known = known.withColumn("first_place", F.min("place").over(own))
        number = F.dense_rank().over(Window.partitionBy("source_form", "domain").orderBy("first_place"))
    return known.withColumn("ie_seq", F.when(F.col("domain") == "IE", number)).drop("first_place", "place")


def number_rows(packed: DataFrame) -> DataFrame:
    """``cells_before``: cells of the domain ahead of this row (forms in dictionary order)."""
    return sequence_within(
        packed, keys=["domain"], order=["form_order", ROW], before={"cells_before": F.size("cells")})


def visit_order(visit: Column) -> list[Column]:
    """Visits by number, then (should a study label them) by text, missing ones last."""
    return [visit.isNull(), *nulls_last(F.expr("try_cast(visitnum AS decimal(20,6))")), visit]


def assign_seqnum(packed: DataFrame) -> DataFrame:
    """Running event number per domain and subject: by visit, then form, then source row.

    An event is a packed row, so nothing is deduplicated or joined back, and a missing
    subject identifier is one (possibly very large) group like any other.
    """
    return sequence_within(
        packed, keys=["domain", "subjid"], order=[*visit_order(F.col("visitnum")), "source_form", ROW],
        before={"seqnum": F.lit(1)},
    ).withColumn("seqnum", (F.col("seqnum") + 1).cast("int"))


def explode_cells(packed: DataFrame, mapping: DataFrame) -> DataFrame:
    """One row per cell; the join side is as small as the dictionary."""
    described = set(mapping.columns)
    return packed.select(
        *[c for c in packed.columns if c != "cells" and c not in described],
        F.posexplode("cells").alias("cell_no", "cell"),
    ).select("*", "cell.mapping", "cell.value").drop("cell").join(mapping, "mapping")


def placed_entries(forms: Mapping[str, DataFrame], mapping: DataFrame) -> DataFrame:
    """The entries of these forms, staged: their keys stay the same in both joins, and the planner
    knows their size, so that it broadcasts a dictionary and shuffles what is too large to be one."""
    return cut_lineage(place_entries(mapping, {form: header(df) for form, df in forms.items()}))


def pack_forms(forms: Mapping[str, DataFrame], mapping: DataFrame, study: str) -> DataFrame:
    """The packed rows of all mapped forms that exist; enough to see which domains have any."""
    return _packed(forms, placed_entries(forms, mapping), study)


def _packed(forms: Mapping[str, DataFrame], placed: DataFrame, study: str) -> DataFrame:
    """One row per source row and domain that has at least one cell, from one scan of each form the
    dictionary names whatever number of domains it feeds. ``placed``, grouped to one row per form
    and domain, is joined by form and part of the form, broadcast or not."""
    fed = fed_columns(placed)
    if not fed:
        raise ValueError(f"no form of {study} is named in the dictionary")
    rows = reduce(DataFrame.unionByName, [form_rows(forms[form], form, fed[form], study) for form in sorted(fed)])
    wanted = placed.groupBy("source_form", "domain").agg(
        F.min("mapping").alias("form_order"),
        F.sort_array(F.collect_list(F.when(F.col("place") > 0, F.struct("mapping", "place")))).alias("wanted"),
    ).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(FORM_PARTS - 1))))
    cells = F.filter(
        F.transform("wanted", lambda w: F.struct(
            w["mapping"].alias("mapping"), F.get("values", w["place"] - 1).alias("value"))),
        lambda c: has_text(c["value"]))
    visit = F.col("visitnum")
    if study == STUDY_B:
        visit = F.when(F.col("domain").isin(*sorted(STUDY_B_VISIT_DOMAINS)), visit)
    part = F.pmod(F.xxhash64(ROW), F.lit(FORM_PARTS)).cast("int")
    return rows.withColumn("part", part).join(wanted, ["source_form", "part"]).select(
        "studyid", "subjid", "scrno", "source_form", ROW, "domain", "form_order",
        visit.alias("visitnum"), cells.alias("cells"),
    ).where(F.size("cells") > 0)


def unpivot_forms(forms: Mapping[str, DataFrame], mapping: DataFrame, study: str) -> DataFrame:
    """All mapped forms that exist to numbered rows, one per recorded cell."""
    placed = placed_entries(forms, mapping)
    packed = _packed(forms, placed, study)
    rows = explode_cells(assign_seqnum(number_rows(packed)), ie_sequence(placed, study))
    return rows.select(
        (F.col("cells_before") + F.col("cell_no") + 1).alias("row_id"),
        "studyid", "subjid", "scrno", "domain", "standard_var", "standard_label", "value",
        "source_form", "source_var", "visitnum", F.coalesce("ie_seq", "seqnum").alias("seqnum"))
