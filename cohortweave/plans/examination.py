"""Abnormal physical-examination findings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.text import ordered_list, substring_from
from cohortweave.operators.pivot import domain, eav_pivot
from cohortweave.schema import STUDY_A, STUDY_B, STUDY_C


def pe_abnormal(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    """Per study and visit: the abnormal body systems and the subjects showing any."""
    paired = eav_pivot(
        domain(facts, "pe", STUDY_A, ["PETEST", "PEORRES"]),
        ["subject_key", "seqnum", "visitnum"], {"body_system": "PETEST", "result": "PEORRES"},
    ).where(F.col("result") == "Abnormal").select(
        F.lit(STUDY_A).alias("source_study"), "subject_key", "visitnum", "body_system")

    label = F.col("standard_label")
    labelled = domain(facts, "pe", variables=["PEORRES"]).where(
        F.col("source_study").isin(STUDY_B, STUDY_C) & (F.col("value") == "Abnormal")
    ).select(
        "source_study", "subject_key", "visitnum",
        F.when(F.col("source_study") == STUDY_B, substring_from(label, r"<([^>]+)>"))
         .otherwise(label).alias("body_system"))

    # Systems and subjects are made distinct side by side in one pass; the list aggregate
    # then sees each body system once per visit.
    abnormal = paired.unionByName(labelled)
    keys = ["source_study", "visitnum"]
    no_subject, no_system = F.lit(None).cast("bigint"), F.lit(None).cast("string")
    items = abnormal.select(*keys, F.inline(F.array(
        F.struct(F.col("body_system"), no_subject.alias("subject_key")),
        F.struct(no_system.alias("body_system"), F.col("subject_key"))))).distinct()
    return items.groupBy(*keys).agg(
        ordered_list("body_system").alias("abnormal_systems"),
        F.count("subject_key").alias("subjects_with_abnormal"),
    ).withColumn("visitnum", F.col("visitnum").cast("double")).orderBy(
        "source_study", F.asc_nulls_last("visitnum"))
