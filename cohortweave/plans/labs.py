"""Laboratory results outside their reference range."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.numbers import share
from cohortweave.operators.pivot import domain, eav_pivot

# Output column and the variable it shows.
LAB_COLUMNS = {
    "test_name": "LBTEST", "result": "LBORRES", "unit": "LBORRESU", "flag": "LBNRIND",
    "ref_low": "LBORNRLO", "ref_high": "LBORNRHI", "assessed": "LBDTC",
}
FLAGGED = ("Low", "High")


def out_of_range_lb(subjects: DataFrame | None, facts: DataFrame, *, study: str) -> DataFrame:
    draws = eav_pivot(
        domain(facts, "lb", study, LAB_COLUMNS.values()),
        ["subject_key", "seqnum", "visitnum"], LAB_COLUMNS)
    return draws.where(F.col("flag").isin(*FLAGGED)).orderBy(
        "subject_key", F.asc_nulls_last("visitnum"), F.asc_nulls_last("seqnum")
    ).select("subject_key", F.col("visitnum").cast("double").alias("visitnum"), *LAB_COLUMNS)


def dq_lab_flags(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    flagged = F.count_if(F.col("value").isin(*FLAGGED))
    return domain(facts, "lb", variables=["LBNRIND"]).groupBy("source_study").agg(
        F.count("*").alias("results_assessed"), flagged.alias("flagged"),
        share(flagged, F.count("*")).alias("flag_pct"),
    ).orderBy("source_study")
