"""Constraints of the stored tables as queries that return the offending rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.schema import REQUIRED

SUBJECT_KEYS = (("source_study", "subjid"), ("source_study", "scrno"), ("source_study", "record_id"))


def check_registry(facts: DataFrame, registry: DataFrame) -> DataFrame:
    """(domain, study) pairs present in the facts that the registry does not allow."""
    allowed = registry.select(
        F.col("table_name").alias("domain"),
        F.explode(F.split(F.regexp_replace("applies_to", " only$", ""), ",")).alias("source_study"))
    present = facts.groupBy("domain", "source_study").agg(F.count("*").alias("n_rows"))
    return present.join(allowed, ["domain", "source_study"], "left_anti")


def check_not_null(facts: DataFrame) -> DataFrame:
    """Per domain, how many rows lack each required column."""
    return facts.groupBy("domain").agg(
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in REQUIRED])


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys used more than once; as in SQL, a key with a null part is never a duplicate."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def check_subject_ids(subjects: DataFrame) -> DataFrame:
    """All three identifier rules of the subjects table at once: (rule, study, id, n_rows)."""
    pairs = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).alias("id")) for _, name in SUBJECT_KEYS])
    return check_unique(subjects.select("source_study", F.inline(pairs)), ["rule", "source_study", "id"])


def check_fk(facts: DataFrame, subjects: DataFrame) -> DataFrame:
    """Subject keys the facts use but the subjects table lacks, by domain."""
    used = facts.where(F.col("subject_key").isNotNull()).groupBy("domain", "subject_key").agg(
        F.count("*").alias("n_rows"))
    return used.join(subjects.select("subject_key"), "subject_key", "left_anti")
