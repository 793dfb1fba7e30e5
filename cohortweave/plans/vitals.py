"""Vital-sign trends over three different encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.numbers import plain_number, rounded
from cohortweave.functions.text import substring_from
from cohortweave.operators.pivot import domain, eav_pivot
from cohortweave.operators.sequence import sequence_within
from cohortweave.schema import STUDIES, STUDY_A, STUDY_B, STUDY_C

# Name patterns in order of precedence, and the test each one shows as.
TEST_PATTERNS = (
    ("%HEART%RATE%", "Heart rate"),
    ("%TEMP%", "Body temperature"),
    ("%HEIGHT%", "Height"),
    ("%WEIGHT%", "Weight"),
)


def test_display(name: Column) -> Column:
    shown = F.lit(None).cast("string")
    for pattern, test in reversed(TEST_PATTERNS):
        shown = F.when(F.upper(name).like(pattern), test).otherwise(shown)
    return shown


def positional_measurements(facts: DataFrame) -> DataFrame:
    """STUDY_A keeps test, result and unit in separate facts: the n-th of each kind
    within a subject's visit (null visit included) belong together; the unit may be
    missing. One numbering and one pivot, no join; both where the visit's facts lie, after one shuffle."""
    kinds = domain(facts, "vs", STUDY_A, ["VSTEST", "VSORRES", "VSORRESU"])
    numbered = sequence_within(
        kinds.select("subject_key", "visitnum", "standard_var", "value", "fact_id"),
        keys=["subject_key", "visitnum", "standard_var"],
        order=["fact_id"],
        before={"position": F.lit(1)},
        together=["subject_key", "visitnum"])
    return eav_pivot(
        numbered, ["subject_key", "visitnum", "position"],
        {"test_name": "VSTEST", "result": "VSORRES", "unit": "VSORRESU"},
    ).where(F.col("test_name").isNotNull() & F.col("result").isNotNull()).drop("position")


SUMS = ("n", "total", "squares", "wide_total", "wide_squares")


def _moments(rows: DataFrame) -> list[Column]:
    """Count and sums, which merge and can be weighted: exact decimals for readings of up to
    nine digits before and six after the point, doubles beside them for all others."""
    exact = F.col("result").rlike(r"\A\s*[0-9]{1,9}(\.[0-9]{1,6})?\s*\z")
    x = F.when(exact, F.expr("try_cast(trim(result) AS decimal(15,6))"))
    wide = F.when(~exact, F.expr("try_cast(trim(result) AS double)"))
    none, nothing = F.lit(0).cast("decimal(15,6)"), F.lit(0.0)
    return [F.count("*").alias("n"),
            F.coalesce(F.sum(x), none).alias("total"), F.coalesce(F.sum(x * x), none).alias("squares"),
            F.coalesce(F.sum(wide), nothing).alias("wide_total"),
            F.coalesce(F.sum(wide * wide), nothing).alias("wide_squares")]


def _labelled_moments(facts: DataFrame, studies: list[str]) -> DataFrame:
    """STUDY_B and STUDY_C: the label names the test; the unit is a fact labelled
    '<test> unit' at the same visit, else the part in brackets.

    Every unit fact counts the measurement once, so several of them weight it. The
    facts are summed up per label before the match: no pair of rows is ever emitted.
    """
    keys = ["source_study", "subject_key", "visitnum", "label_key"]
    vitals = domain(facts, "vs").where(F.col("source_study").isin(*studies))
    label = F.col("standard_label")
    results = vitals.where(F.col("standard_var") == "VSORRES").withColumn(
        "result", F.col("value")
    ).withColumn("test_display", test_display(label)).where(
        F.col("test_display").isNotNull() & plain_number(F.col("result")))
    readings = results.withColumn("label_key", F.upper(label)).groupBy(
        *keys, "standard_label", "test_display").agg(*_moments(results))
    units = vitals.where(F.col("standard_var") == "VSORRESU").groupBy(
        "source_study", "subject_key", "visitnum",
        F.upper(F.regexp_replace(label, r"(?i)\s+unit\z", "")).alias("label_key"),
        F.col("value").alias("unit_value"),
    ).agg(F.count("*").alias("weight"))

    r, u = readings.alias("r"), units.alias("u")
    same = (
        (F.col("r.source_study") == F.col("u.source_study"))
        & (F.col("r.subject_key") == F.col("u.subject_key"))
        & F.col("r.visitnum").eqNullSafe(F.col("u.visitnum"))
        & (F.col("r.label_key") == F.col("u.label_key")))
    weight = F.coalesce(F.col("u.weight"), F.lit(1)).cast("decimal(10,0)")
    return r.join(u, same, "left").select(
        "r.source_study", "r.subject_key", "r.visitnum", "r.test_display",
        F.coalesce(F.col("u.unit_value"),
                   substring_from(F.col("r.standard_label"), r"\(([^)]+)\)")).alias("unit"),
        *[(F.col(f"r.{name}") * weight).alias(name) for name in SUMS])


def vital_trends(subjects: DataFrame | None, facts: DataFrame, *, study: str | None = None) -> DataFrame:
    """Per study, visit, test and unit: measurements, subjects, mean and spread.

    Only unsigned plain decimals count. ``study=None`` means all three; an unknown study
    has no rows.
    """
    if study is not None and study not in STUDIES:
        return vital_trends(subjects, facts.where(F.lit(False)))
    keys = ["source_study", "visitnum", "test_display", "unit"]
    parts = []
    if study in (None, STUDY_A):
        paired = positional_measurements(facts).withColumn(
            "test_display", test_display(F.col("test_name"))
        ).where(F.col("test_display").isNotNull() & plain_number(F.col("result")))
        parts.append(paired.withColumn("source_study", F.lit(STUDY_A)).groupBy(
            *keys, "subject_key").agg(*_moments(paired)))
    labelled = [s for s in (STUDY_B, STUDY_C) if study in (None, s)]
    if labelled:
        parts.append(_labelled_moments(facts, labelled))

    per_subject = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if labelled:  # a subject's rows of one label each; STUDY_A's are one already
        per_subject = per_subject.groupBy(*keys, "subject_key").agg(*[F.sum(c).alias(c) for c in SUMS])
    sums = per_subject.groupBy(*keys).agg(
        F.sum("n").cast("bigint").alias("n_measurements"),
        F.count("subject_key").alias("n_subjects"),
        *[F.sum(c).alias(c) for c in SUMS[1:]])

    n, total, squares, wide_total, wide_squares = (
        F.col(c).cast("double") for c in ("n_measurements", *SUMS[1:]))
    total, squares = total + wide_total, squares + wide_squares
    exact_mean = F.col("total").cast("decimal(24,6)") / F.col("n_measurements").cast("decimal(14,0)")
    variance = F.greatest((squares - total * total / n) / (n - 1), F.lit(0.0))

    def shown(value: Column, places: int) -> Column:
        # a double of 10^15 or more has no decimal places to round
        return F.when(value < 1e15, rounded(value, places)).otherwise(value)

    mean = F.when(wide_total == 0, rounded(exact_mean, 1)).otherwise(shown(total / n, 1))
    return sums.select(
        "source_study", F.col("visitnum").cast("double").alias("visitnum"), "test_display", "unit",
        "n_measurements", "n_subjects",
        mean.alias("avg_value"),
        F.when(n > 1, shown(F.sqrt(variance), 2)).alias("sd"),
    ).orderBy("source_study", "test_display", F.asc_nulls_last("visitnum"))
