"""Enrolment counts and harmonised eligibility answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.text import substring_from
from cohortweave.operators.pivot import domain, eav_pivot
from cohortweave.schema import STUDY_A, STUDY_B, STUDY_C

# Phrases that mark a STUDY_C criterion as an exclusion (case matters).
EXCLUSION_PHRASES = ("immunized with any typhoid", "Acute illnesses")


def enrollment_summary(subjects: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    return subjects.groupBy("source_study").agg(
        F.count("*").alias("subject_count"),
        F.count("subjid").alias("subjects_with_subjid"),
        F.count_if(F.col("subjid").isNull() & F.col("scrno").isNotNull()).alias("scrno_only_subjects"),
    ).orderBy("source_study")


def enrolled_count(subjects: DataFrame, facts: DataFrame | None = None, *, study: str) -> DataFrame:
    return subjects.where((F.col("source_study") == study) & F.col("subjid").isNotNull()).agg(
        F.count("*").alias("n"))


def _answers(facts: DataFrame, study: str) -> DataFrame:
    no_text = F.lit(None).cast("string")
    if study == STUDY_A:
        return domain(facts, "ie", STUDY_A, ["IEORRES"]).select(
            "subject_key", F.lit("OVERALL").alias("category"), no_text.alias("criterion_id"),
            F.lit("Met all eligibility criteria").alias("criterion"),
            F.col("value").alias("answer"), "visitnum")
    if study == STUDY_B:
        wide = eav_pivot(
            domain(facts, "ie", STUDY_B, ["IECAT", "IETESTCD", "IETEST", "IEORRES"]),
            ["subject_key", "seqnum"],
            {"category": "IECAT", "criterion_id": "IETESTCD", "criterion": "IETEST",
             "answer": "IEORRES"},
            visitnum=F.max("visitnum"))
        return wide.where(F.col("criterion_id").isNotNull()).drop("seqnum")
    if study == STUDY_C:
        label, value = F.col("standard_label"), F.col("value")
        exclusion = F.coalesce(
            label.contains(EXCLUSION_PHRASES[0]) | label.contains(EXCLUSION_PHRASES[1]), F.lit(False))
        return domain(facts, "ie", STUDY_C, ["IETEST"]).select(
            "subject_key",
            F.when(exclusion, "EXCLUSION").otherwise("INCLUSION").alias("category"),
            no_text.alias("criterion_id"),
            F.trim(substring_from(label, r"(?s)<(.*)>")).alias("criterion"),
            F.when(value == "1", "Yes").when(value == "2", "No").otherwise(value).alias("answer"),
            "visitnum")
    return _answers(facts, STUDY_A).where(F.lit(False))  # a study without data


def eligibility_rows(subjects: DataFrame, facts: DataFrame, study: str) -> DataFrame:
    """One row per subject and criterion, with STUDY_A's screening-failure reasons.

    A null answer leaves ``criterion_met`` null.
    """
    answer = F.col("answer")
    out = _answers(facts, study).join(
        subjects.select("subject_key", "subjid", "scrno"), "subject_key")
    # Reasons come from STUDY_A facts only and subject keys do not cross studies.
    if study == STUDY_A:
        reasons = domain(facts, "ie", STUDY_A, ["SUPPIE"]).where(
            F.col("standard_label") == "Screening Failure Reason"
        ).select("subject_key", F.col("value").alias("reason"))
        out = out.join(reasons, "subject_key", "left")
    else:
        out = out.withColumn("reason", F.lit(None).cast("string"))
    return out.withColumn(
        "criterion_met",
        F.when(F.col("category") == "EXCLUSION", answer.isin("N", "No"))
         .otherwise(answer.isin("Y", "Yes"))
    ).withColumn("visitnum", F.col("visitnum").cast("double"))


ELIGIBILITY = ["subjid", "scrno", "category", "criterion", "answer", "criterion_met", "reason", "visitnum"]


def eligibility(subjects: DataFrame, facts: DataFrame, *, study: str) -> DataFrame:
    return eligibility_rows(subjects, facts, study).orderBy(
        F.asc_nulls_last("subjid"), F.desc_nulls_first("category"),
        F.asc_nulls_last("criterion_id"), F.asc_nulls_last("visitnum"),
    ).select(*ELIGIBILITY)
