"""The data dictionary: which source column of which form feeds which standard variable.

It is cleaned as a DataFrame and stays one where forms are unpivoted. Only the record export,
whose slots depend on single entries, reads it on the driver, behind a size check.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.functions.text import has_text
from cohortweave.schema import STUDY_A, STUDY_C

MAX_ENTRIES = 200_000
COLUMNS = ["domain", "standard_var", "standard_label", "source_form", "source_var", "dict_row"]

# Eligibility reasons the STUDY_A dictionary leaves out.
STUDY_A_IE_EXTRAS = (
    ("IE", "SUPPIE", "Screening Failure Reason", "IE", "iesfreason"),
    ("IE", "SUPPIE", "Eligibility Reason", "IE", "ieeligreason"),
)


@dataclass(frozen=True)
class Entry:
    ordinal: int
    domain: str
    standard_var: str
    standard_label: str
    source_form: str
    source_var: str


def normalise_dictionary(raw: DataFrame, study: str) -> DataFrame:
    """Project one study's crosswalk and clean it: trimmed texts, lower-case source
    variables, upper-case forms (lower-case in STUDY_C), rows without a source variable
    dropped. ``dict_row`` keeps the order of the file and tells its rows apart."""
    form, var = f"{study}_FORM", f"{study}_VAR"
    needed = ["Standard_Domain", "Standard_VAR", "Standard_LABEL", form, var]
    missing = [c for c in needed if c not in raw.columns]
    if missing:
        raise KeyError(f"dictionary lacks the columns {missing}")
    if "dict_row" not in raw.columns:
        raw = raw.withColumn("dict_row", F.monotonically_increasing_id())

    def text(name: str):
        return F.trim(F.coalesce(F.col(name), F.lit("")))

    fold = F.lower if study == STUDY_C else F.upper
    return raw.select(
        text("Standard_Domain").alias("domain"), text("Standard_VAR").alias("standard_var"),
        text("Standard_LABEL").alias("standard_label"), fold(text(form)).alias("source_form"),
        F.lower(text(var)).alias("source_var"), "dict_row",
    ).where(has_text(F.col("source_var")))


def dedupe_dictionary(mapping: DataFrame) -> DataFrame:
    """First row per (domain, variable, label, source variable); its form survives."""
    return mapping.groupBy("domain", "standard_var", "standard_label", "source_var").agg(
        F.min_by("source_form", "dict_row").alias("source_form"), F.min("dict_row").alias("dict_row"),
    ).select(*COLUMNS)


def with_extra_mappings(mapping: DataFrame) -> DataFrame:
    """Append the hand mappings to a dictionary that has the IE domain."""
    spark: SparkSession = mapping.sparkSession
    after_all = 1 << 60
    extra = spark.createDataFrame(
        [(*row, after_all + i) for i, row in enumerate(STUDY_A_IE_EXTRAS)],
        "domain string, standard_var string, standard_label string, source_form string, "
        "source_var string, dict_row long")
    return mapping.unionByName(extra.join(mapping.select("domain"), "domain", "left_semi"))


def study_dictionary(raw: DataFrame, study: str) -> DataFrame:
    mapping = normalise_dictionary(raw, study)
    if study == STUDY_A:
        return with_extra_mappings(mapping)
    if study == STUDY_C:
        return dedupe_dictionary(mapping)
    return mapping


def entries(mapping: DataFrame, most: int = MAX_ENTRIES) -> list[Entry]:
    """The dictionary on the driver, in file order; one of more than ``most`` rows is refused."""
    rows = mapping.select(*COLUMNS).orderBy("dict_row").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a dictionary of more than {most} rows is not a dictionary")
    return [Entry(i, r.domain, r.standard_var, r.standard_label, r.source_form, r.source_var)
            for i, r in enumerate(rows)]


def first_mapping(mapping: Iterable[Entry], source_var: str, domain: str | None = None,
                  standard_var: str | None = None) -> Entry | None:
    return next(
        (m for m in mapping if m.source_var == source_var
         and domain in (None, m.domain) and standard_var in (None, m.standard_var)), None)


def entries_frame(spark: SparkSession, mapping: Iterable[Entry]) -> DataFrame:
    """Entries as a (dictionary-sized) frame keyed by ``mapping``."""
    return spark.createDataFrame(
        [(m.ordinal, m.domain, m.standard_var, m.standard_label, m.source_form, m.source_var) for m in mapping],
        "mapping int, domain string, standard_var string, standard_label string, source_form string, source_var string")


def place_entries(mapping: DataFrame, headers: Mapping[str, Sequence[str]]) -> DataFrame:
    """The entries of the given forms, keyed by ``mapping``; ``place`` is where the form has the
    source column (from 1), 0 where it lacks it. The expression grows with the headers only."""
    columns = F.create_map(*[
        c for form, names in headers.items() for c in (F.lit(form), F.lit(list(names)).cast("array<string>"))])
    return mapping.select(
        F.col("dict_row").cast("bigint").alias("mapping"), *COLUMNS[:-1],
        F.array_position(F.try_element_at(columns, F.col("source_form")), F.col("source_var")).cast("int").alias("place"),
    ).where(F.col("place").isNotNull())


def fed_columns(placed: DataFrame) -> dict[str, set[str]]:
    """Forms the dictionary names, each with the columns it maps: at most what the headers hold."""
    found: dict[str, set[str]] = {}
    for form, name in placed.select("source_form", F.when(F.col("place") > 0, F.col("source_var"))).distinct().collect():
        found.setdefault(form, set()).update([name] if name is not None else [])
    return found


def form_coverage(forms: Iterable[str], mapping: DataFrame) -> DataFrame:
    """Forms no entry mentions (``unmapped``) and mentioned forms that do not exist
    (``missing``); names compare in any case, README is not a form."""
    have = mapping.sparkSession.createDataFrame([(n.upper(),) for n in forms], "form string").distinct()
    have, want = have.where(F.col("form") != "README"), mapping.select(F.upper("source_form").alias("form")).distinct()
    return have.join(want, "form", "left_anti").withColumn("status", F.lit("unmapped")).unionByName(
        want.join(have, "form", "left_anti").withColumn("status", F.lit("missing")))


def empty_domains(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Domains the dictionary names but the unpivoted rows lack."""
    return mapping.select("domain").distinct().join(rows.select("domain").distinct(), "domain", "left_anti")
