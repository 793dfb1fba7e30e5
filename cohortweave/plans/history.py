"""Medical history: coverage, screening questions, onset records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.text import is_no, is_yes, ordered_list, syn_suffix
from cohortweave.operators.pivot import domain
from cohortweave.schema import STUDIES


def mh_coverage(subjects: DataFrame | None, facts: DataFrame) -> DataFrame:
    """A record is a distinct (subject, seqnum) row; one with a null seqnum counts."""
    records = domain(facts, "mh").select("source_study", "subject_key", "seqnum").distinct()
    return records.groupBy("source_study", "subject_key").agg(F.count("*").alias("n")).groupBy(
        "source_study"
    ).agg(
        F.count("subject_key").alias("subjects_with_mh"), F.sum("n").alias("mh_records"),
    ).orderBy("source_study")


def mh_questions(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    """Answers per question, one per subject (Yes, then No, then any other), plus the
    enrolled subjects with no answer row at all."""
    value, response = F.col("value"), F.col("response")
    answers = domain(facts, "mh", variables=["MHOCCUR"]).select(
        "source_study", F.col("standard_label").alias("question"), "subject_key",
        F.when(is_yes(value), "Yes").when(is_no(value), "No")
         .when(value == "9", "Don't Know").otherwise(value).alias("response"))
    per_subject = answers.groupBy("source_study", "question", "subject_key").agg(
        F.when(F.bool_or(response == "Yes"), "Yes")
         .when(F.bool_or(response == "No"), "No")
         .otherwise(F.max(response)).alias("response"))
    # Counts per response and, in the same pass, per question.
    keys = ["source_study", "question", "response"]
    counts = per_subject.groupingSets([keys, keys[:2]], *keys).agg(
        F.count("*").alias("n"), F.grouping("response").alias("over_all"))
    enrolled = subjects.groupBy("source_study").agg(F.count("*").alias("n_subjects"))
    unanswered = F.col("over_all") == 1
    return counts.join(enrolled, "source_study", "left").select(
        "source_study", "question",
        F.when(unanswered, "Not recorded").otherwise(F.col("response")).alias("response"),
        F.when(unanswered, F.col("n_subjects") - F.col("n")).otherwise(F.col("n")).alias("n"),
        unanswered.alias("unanswered"),
    ).where(~F.col("unanswered") | (F.col("n") > 0)).drop("unanswered").orderBy(
        "source_study", F.asc_nulls_last("question"), F.asc_nulls_last("response"))


def mh_onset(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    """Dated conditions with the visits that reported them (visits sort as text)."""
    keys = ["source_study", "subject_key", "seqnum"]
    history = domain(facts, "mh").where(F.col("source_study").isin(*STUDIES))
    # Only distinct rows matter below, so repeats are dropped before they can multiply.
    starts = history.where(F.col("standard_var") == "MHSTDTC").select(
        *keys, F.col("value").alias("start_raw")).distinct()
    terms = history.where(F.col("standard_var") == "MHTERM").select(
        *keys,
        F.when(F.col("source_study") == STUDIES[0], F.col("value"))
         .otherwise(F.col("standard_label")).alias("term"),
        F.round("visitnum").cast("int").cast("string").alias("visit")).distinct()
    group = ["source_study", "subjid", "person_id", "term", "start_raw"]
    return terms.join(starts, keys).join(
        subjects.select("subject_key", "subjid"), "subject_key"
    ).withColumn("person_id", F.coalesce(syn_suffix(F.col("subjid")), F.col("subjid"))).select(
        *group, "visit").distinct().groupBy(*group).agg(
        ordered_list("visit").alias("visits")
    ).orderBy(F.asc_nulls_last("person_id"), "source_study", F.asc_nulls_last("start_raw"))
