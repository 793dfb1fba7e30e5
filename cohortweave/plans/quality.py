"""Data-quality measures over all domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.plans.labs import dq_lab_flags  # noqa: F401  (part of this page)
from cohortweave.schema import DOMAINS, EXPECTED_VISITS, FACTS
from cohortweave.sources.store import BATCH, batch_folder


def domain_counts(facts: DataFrame) -> DataFrame:
    """(source_study, domain, total_rows, empty_rows): counts that add up over batches."""
    value = F.col("value")
    return facts.where(F.col("domain").isin(*DOMAINS)).groupBy("source_study", "domain").agg(
        F.count("*").alias("total_rows"),
        F.count_if(value.isNull() | (F.trim(value) == "")).alias("empty_rows"))


def subject_visits(facts: DataFrame) -> DataFrame:
    """Distinct (source_study, subject_key, visitnum) over all domains: what batches have in common counts once."""
    return facts.where(
        F.col("domain").isin(*DOMAINS) & F.col("visitnum").isNotNull()
        & F.col("source_study").isin(*EXPECTED_VISITS)).select("source_study", "subject_key", "visitnum").distinct()


def missingness_of(counts: DataFrame) -> DataFrame:
    """``dq_missingness`` from the ``domain_counts`` of any number of batches."""
    return counts.groupBy("source_study", "domain").agg(
        F.sum("total_rows").alias("total_rows"), F.sum("empty_rows").alias("empty_rows")).orderBy("source_study", "domain")


def dq_missingness(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    """One aggregate over the whole fact table; a domain is a column, not a table."""
    return domain_counts(facts).orderBy("source_study", "domain")


def dq_visit_completeness(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    """Distinct visits per subject over all domains against the study's schedule."""
    return visit_completeness_of(facts.where(F.col("domain").isin(*DOMAINS) & F.col("visitnum").isNotNull()))


def visit_completeness_of(visits: DataFrame) -> DataFrame:
    """``dq_visit_completeness`` from the ``subject_visits`` of any number of batches."""
    expected = F.lit(None).cast("int")
    for study, scheduled in EXPECTED_VISITS.items():
        expected = F.when(F.col("source_study") == study, scheduled).otherwise(expected)
    per_subject = visits.where(F.col("source_study").isin(*EXPECTED_VISITS)).groupBy("source_study", "subject_key").agg(F.count_distinct("visitnum").alias("visits"))
    return per_subject.groupBy("source_study").agg(
        F.count("*").alias("subjects_with_data"),
        F.count_if(F.col("visits") >= expected).alias("complete"),
        F.count_if(F.col("visits") < expected).alias("incomplete"),
    ).orderBy("source_study")


#: Summaries kept with each batch, by name: what to compute of its facts.
SUMMARIES = {"counts": domain_counts, "visits": subject_visits}


def write_summaries(spark: SparkSession, path: str, batch: str = "first") -> None:
    """Summaries of a stored batch, beside the store (``{path}-counts``, ``{path}-visits``). They are replaced with
    the batch and merge over batches, so that data quality is read without the facts."""
    facts = spark.read.schema(FACTS).parquet(batch_folder(path, batch))
    for name, summary in SUMMARIES.items():
        summary(facts).write.mode("overwrite").parquet(batch_folder(f"{path}-{name}", batch))


def read_summary(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}-{name}").drop(BATCH)
