"""Concomitant medication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.text import is_no, is_yes, ordered_list
from cohortweave.operators.pivot import domain
from cohortweave.schema import STUDY_B, STUDY_C

# Bucket labels in display order.
BUCKETS = ("0", "1-3", "4-6", "7+")


def _treatments(facts: DataFrame, study: str | None = None) -> DataFrame:
    return domain(facts, "cm", study, ["CMTRT"])


def cm_coverage(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    """Studies with medication facts but no treatment rows are listed with zeros."""
    given = F.col("standard_var") == "CMTRT"
    return domain(facts, "cm").groupBy("source_study").agg(
        F.count_distinct(F.when(given, F.col("subject_key"))).alias("subjects_with_cm"),
        F.count_if(given).alias("cm_records"),
        F.count_distinct(F.when(given, F.col("value"))).alias("distinct_meds"),
    ).orderBy("source_study")


def cm_freq(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    return _treatments(facts).groupBy("source_study", F.col("value").alias("medication")).agg(
        F.count("*").alias("records"), F.count_distinct("subject_key").alias("subjects"),
    ).orderBy("source_study", F.desc_nulls_first("subjects"), F.asc_nulls_last("medication"))


def cm_sae(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    """Medications of subjects with a serious adverse event; no medication gives 0."""
    serious = domain(facts, "ae", variables=["AESER"]).where(is_yes(F.col("value"))).select(
        "subject_key").distinct()
    meds = _treatments(facts).select("subject_key", F.col("value").alias("medication")).distinct()
    return serious.join(subjects.select("subject_key", "subjid"), "subject_key").join(
        meds, "subject_key", "left"
    ).select("subjid", "medication").distinct().groupBy("subjid").agg(
        F.count("medication").alias("n_distinct_meds"),
        ordered_list("medication").alias("medications"),
    ).orderBy(F.asc_nulls_last("subjid"))


def cm_typhoid_meds(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    return domain(facts, "cm", STUDY_C, ["CMYN"]).groupBy("subject_key").agg(
        F.bool_or(is_yes(F.col("value"))).alias("took_med")
    ).groupBy("took_med").agg(F.count("*").alias("subjects")).orderBy(F.desc_nulls_first("took_med"))


def _distinct_meds(facts: DataFrame, keys: list[str], study: str | None = None) -> DataFrame:
    """Number of distinct medications per key, from a deduplicated pair set."""
    return _treatments(facts, study).where(F.col("value").isNotNull()).select(
        *keys, "value").distinct()


def cm_med_count_buckets(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    keys = ["source_study", "subject_key"]
    counted = _distinct_meds(facts, keys).groupBy(*keys).agg(F.count("*").alias("n_meds"))
    n = F.coalesce(F.col("n_meds"), F.lit(0))
    bucket = (F.when(n == 0, BUCKETS[0]).when(n <= 3, BUCKETS[1])
              .when(n <= 6, BUCKETS[2]).otherwise(BUCKETS[3]))
    rank = F.array_position(F.array(*[F.lit(b) for b in BUCKETS]), F.col("med_bucket"))
    return subjects.select(*keys).join(counted, keys, "left").groupBy(
        "source_study", bucket.alias("med_bucket")
    ).agg(F.count("*").alias("n_subjects")).orderBy("source_study", rank)


def cm_typhoid_med_list(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    meds = _treatments(facts, STUDY_C).select("subject_key", "value").distinct()
    return meds.join(subjects.select("subject_key", "subjid"), "subject_key").select(
        "subjid", "value").distinct().groupBy("subjid").agg(
        ordered_list("value").alias("medications"), F.count("value").alias("n_meds"),
    ).orderBy(F.asc_nulls_last("subjid"))


def cm_study_b_detail(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    """STUDY_B subjects with any medication evidence and what that evidence is."""
    value = F.col("value")
    meds = _distinct_meds(facts, ["subject_key"], STUDY_B).groupBy("subject_key").agg(
        ordered_list("value").alias("medications"), F.count("*").alias("n_meds"))
    screen = domain(facts, "cm", STUDY_B, ["CMYN"]).groupBy("subject_key").agg(
        F.bool_or(is_yes(value)).alias("answered_yes"), F.bool_or(is_no(value)).alias("answered_no"))
    taken = F.col("n_meds") > 0
    return subjects.where(F.col("source_study") == STUDY_B).select("subject_key", "subjid").join(
        meds, "subject_key", "left").join(screen, "subject_key", "left").where(
        taken | F.col("answered_yes") | F.col("answered_no")
    ).select(
        "subjid",
        F.coalesce("medications", F.lit("-")).alias("medications"),
        F.coalesce("n_meds", F.lit(0)).alias("n_meds"),
        F.when(taken, "Medication recorded")
         .when(F.col("answered_no"), "No medication (confirmed)")
         .when(F.col("answered_yes"), "Yes (unspecified)")
         .otherwise("Not recorded").alias("status"),
    ).orderBy(F.asc_nulls_last("subjid"))
