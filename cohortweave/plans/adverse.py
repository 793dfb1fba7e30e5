"""Adverse events, and their relation to dosing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions.dates import day_month_year
from cohortweave.functions.numbers import ratio, rounded
from cohortweave.operators.pivot import domain, eav_pivot, value_of
from cohortweave.schema import DOSE_OF_VISIT, STUDY_A

EVENT = ["subject_key", "seqnum"]


def dose_number(visit: Column) -> Column:
    return reduce(lambda whens, vd: whens.when(visit == vd[0], vd[1]),
                  DOSE_OF_VISIT.items(), F).cast("int")


def standalone(events: DataFrame) -> DataFrame:
    """Keep events that refer to no other report. ``referred`` is computed in the same
    grouping as the event itself, so no second scan or anti-join is needed. A missing
    sequence number never matches another, so those events stay."""
    return events.where(~F.col("referred") | F.col("seqnum").isNull()).drop("referred")


def referred() -> Column:
    return F.coalesce(F.bool_or(F.col("standard_var") == "AEREFID"), F.lit(False))


def ae_by_subject(subjects: DataFrame, facts: DataFrame, *, study: str) -> DataFrame:
    events = standalone(eav_pivot(
        domain(facts, "ae", study), EVENT, {},
        serious=F.coalesce(
            F.bool_or((F.col("standard_var") == "AESER") & (F.col("value") == "Y")), F.lit(False)),
        referred=referred()))
    return events.groupBy("subject_key").agg(
        F.count("seqnum").alias("num_ae"),
        F.count_if(F.col("serious") & F.col("seqnum").isNotNull()).alias("num_sae"),
    ).join(subjects.select("subject_key", "subjid"), "subject_key").select(
        "subject_key", "subjid", "num_ae", "num_sae"
    ).orderBy(F.desc_nulls_first("num_ae"), F.asc_nulls_last("subjid"))


def ae_severity(subjects: DataFrame | None, facts: DataFrame, *, study: str) -> DataFrame:
    graded = domain(facts, "ae", study, ["AESEV"])
    refers = domain(facts, "ae", study, ["AEREFID"]).select(*EVENT)
    return graded.join(refers, EVENT, "left_anti").groupBy("value").agg(
        F.count_distinct("subject_key").alias("num_subjects"))


def ae_events(subjects: DataFrame, facts: DataFrame, *, study: str) -> DataFrame:
    events = standalone(eav_pivot(
        domain(facts, "ae", study), EVENT,
        {"ae_term": "AETERM", "ae_start": "AESTDTC", "severity": "AESEV",
         "relation": "AEREL", "serious": "AESER"},
        referred=referred()))
    return events.join(subjects.select("subject_key", "subjid"), "subject_key").select(
        "subject_key", "subjid", "seqnum", "ae_term", "ae_start", "severity", "relation", "serious",
    ).orderBy(F.asc_nulls_last("subjid"), F.asc_nulls_last("seqnum"))


def ae_dose_response(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    """Events per dose window ``[dose, next dose)``, the last window open-ended.

    Doses and events of a subject are laid on one timeline of distinct days (at most a
    calendar's worth of rows per subject) and each event day takes the latest dose at
    or before it. That is the interval join without the join: one window by subject.
    A dose number given twice to a subject counts that subject's events twice, as a
    join on (subject, dose number) would.
    """
    doses = eav_pivot(
        domain(facts, "ex", STUDY_A, ["EXSTDTC"]).where(F.col("visitnum").isin(*DOSE_OF_VISIT)),
        ["subject_key", "seqnum", "visitnum"], {"text": "EXSTDTC"},
    ).select(
        "subject_key", day_month_year(F.col("text")).alias("day"),
        dose_number(F.col("visitnum")).alias("dose_n"),
    ).where(F.col("day").isNotNull()).groupBy("subject_key", "day", "dose_n").agg(
        F.count("*").alias("n_windows"))

    events = standalone(eav_pivot(
        domain(facts, "ae", STUDY_A, ["AESTDTC", "AEREFID"]), EVENT, {},
        day=day_month_year(value_of("AESTDTC")), referred=referred(),
    )).where(F.col("day").isNotNull()).groupBy("subject_key", "day").agg(F.count("*").alias("n_aes"))

    # On one day: doses in order of number, then events.
    timeline = doses.select(
        "subject_key", "day", "dose_n", "n_windows", F.lit(0).cast("bigint").alias("n_aes"),
        F.struct("dose_n", "day").alias("dose"),
    ).unionByName(events.select("subject_key", "day", "n_aes"), allowMissingColumns=True)
    so_far = Window.partitionBy("subject_key").orderBy("day", F.asc_nulls_last("dose_n")).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    per_dose = timeline.withColumn("dose", F.last("dose", ignorenulls=True).over(so_far)).where(
        F.col("dose").isNotNull()
    ).groupBy("subject_key", F.coalesce("dose_n", "dose.dose_n").alias("dose_n")).agg(
        F.sum("n_windows").alias("n_windows"), F.sum("n_aes").alias("n_aes"),
        F.min(F.when(F.col("n_aes") > 0, F.datediff("day", "dose.day"))).alias("first_day"))

    total, dosed = F.sum(F.col("n_windows") * F.col("n_aes")), F.count("*")
    return per_dose.groupBy("dose_n").agg(
        dosed.alias("subjects_dosed"),
        F.count_if(F.col("n_aes") > 0).alias("subjects_with_ae"),
        total.alias("total_aes"),
        ratio(total, dosed, 2).alias("avg_aes_per_subject"),
        F.expr("percentile_cont(0.5) WITHIN GROUP (ORDER BY first_day)").alias("median_days_to_first_ae"),
        ratio(F.sum("first_day"), F.count("first_day"), 1).alias("mean_days_to_first_ae"),
    ).orderBy("dose_n")
