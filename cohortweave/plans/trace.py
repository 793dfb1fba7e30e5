"""One participant across studies: linkage, profile, timeline, demographics.

Every function takes ``subjid=None`` for all participants at once, which is the form to
use on a cluster, or one identifier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.dates import day_month_year
from cohortweave.functions.text import ordered_list, syn_suffix
from cohortweave.operators.pivot import domain, eav_pivot, value_of
from cohortweave.plans.adverse import EVENT, dose_number
from cohortweave.schema import DOSE_OF_VISIT, STUDY_A, STUDY_C

ARROW = " → "


def _linked(subjects: DataFrame, subjid: str | None = None) -> DataFrame:
    first = subjects.where(F.col("source_study") == STUDY_A)
    if subjid is not None:
        first = first.where(F.col("subjid") == subjid)
    later = subjects.where(F.col("source_study") == STUDY_C)
    syn = syn_suffix(F.col("subjid")).alias("syn")
    return first.select(
        syn, F.col("subject_key").alias("study_a_subject_key"), F.col("subjid").alias("study_a_subjid"),
    ).join(later.select(syn, F.col("subject_key").alias("study_c_subject_key"), "record_id"), "syn")


def linkage(subjects: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """STUDY_A subjects that continue in STUDY_C under the same trailing identifier."""
    return _linked(subjects).select("study_a_subject_key", "study_a_subjid").orderBy("study_a_subjid")


def _participants(subjects: DataFrame, subjid: str | None, study: str | None = None) -> DataFrame:
    who = subjects.where(F.col("subjid").isNotNull() if subjid is None else F.col("subjid") == subjid)
    if study is not None:
        who = who.where(F.col("source_study") == study)
    return who.select("subject_key", "subjid")


#: An identifier has one key a study; so many are read as a pushed filter.
KEYS_PUSHED = 10


def _of(facts: DataFrame, who: DataFrame, subjid: str | None) -> DataFrame:
    """For one participant, only that participant's facts: the few keys are looked up first and reach the scan as a filter,
    which skips files and row groups (more keys than one participant can have would be joined)."""
    if subjid is None:
        return facts
    keys = [r["subject_key"] for r in who.select("subject_key").limit(KEYS_PUSHED + 1).collect()]
    if len(keys) > KEYS_PUSHED:
        return facts.join(who.select("subject_key"), "subject_key", "left_semi")
    return facts.where(F.col("subject_key").isin(*keys))


def _dose_days(facts: DataFrame) -> DataFrame:
    return eav_pivot(
        domain(facts, "ex", STUDY_A, ["EXSTDTC"]).where(F.col("visitnum").isin(*DOSE_OF_VISIT)),
        ["subject_key", "seqnum", "visitnum"], {}, event_date=day_month_year(value_of("EXSTDTC")),
    ).select("subject_key", dose_number(F.col("visitnum")).alias("dose_n"), "event_date")


def _ae_wide(facts: DataFrame) -> DataFrame:
    """Reports that refer to another one are part of a profile, unlike in the summaries."""
    return eav_pivot(
        domain(facts, "ae", STUDY_A), EVENT,
        {"ae_name": "AETERM", "severity": "AESEV", "relation": "AEREL", "serious": "AESER"},
        ae_start=day_month_year(value_of("AESTDTC")))


def _serious_mark():
    return F.when(F.col("serious") == "Y", " [SAE]").otherwise("")


def subject_profile(subjects: DataFrame, facts: DataFrame, *, subjid: str | None = None) -> DataFrame:
    """Dose dates and the adverse-event story of linked participants."""
    linked = _linked(subjects, subjid)
    facts = _of(facts, _participants(subjects, subjid, STUDY_A), subjid)
    doses = _dose_days(facts).groupBy("subject_key").agg(*[
        F.max(F.when(F.col("dose_n") == n, F.col("event_date"))).alias(f"dose_{n}_date")
        for n in DOSE_OF_VISIT.values()])
    story = F.concat(
        F.upper(F.date_format("ae_start", "dd-MMM-yyyy")), F.lit(": "), F.col("ae_name"),
        F.lit(" ("), F.col("severity"), F.lit(", "), F.col("relation"), F.lit(")"), _serious_mark())
    events = _ae_wide(facts).withColumn("story", story).groupBy("subject_key").agg(
        F.count("*").alias("ae_count"),
        F.count_if(F.col("serious") == "Y").alias("sae_count"),
        ordered_list("story", "ae_start, seqnum NULLS LAST", ARROW).alias("ae_list"))
    key = "study_a_subject_key"
    return linked.join(doses.withColumnRenamed("subject_key", key), key, "left").join(
        events.withColumnRenamed("subject_key", key), key, "left"
    ).select(
        "study_a_subject_key", "study_c_subject_key", "record_id",
        *[f"dose_{n}_date" for n in DOSE_OF_VISIT.values()],
        F.coalesce("ae_count", F.lit(0)).alias("ae_count"),
        F.coalesce("sae_count", F.lit(0)).alias("sae_count"), "ae_list")


def subject_events(subjects: DataFrame, facts: DataFrame, *, subjid: str | None = None) -> DataFrame:
    """Dated doses and adverse events."""
    who = _participants(subjects, subjid, STUDY_A)
    facts = _of(facts, who, subjid)
    doses = _dose_days(facts).select(
        "subject_key", F.lit("dose").alias("event_type"),
        F.concat(F.lit("Dose "), F.col("dose_n")).alias("event_label"), "event_date",
        F.lit(None).cast("string").alias("detail"))
    events = _ae_wide(facts).select(
        "subject_key", F.lit("ae").alias("event_type"), F.col("ae_name").alias("event_label"),
        F.col("ae_start").alias("event_date"),
        F.concat(F.col("severity"), F.lit(", "), F.col("relation"), _serious_mark()).alias("detail"))
    return doses.unionByName(events).where(F.col("event_date").isNotNull()).join(
        who, "subject_key"
    ).select("subjid", "event_type", "event_label", "event_date", "detail").orderBy(
        F.asc_nulls_last("subjid"), "event_date")


def subject_demographics(subjects: DataFrame, facts: DataFrame, *, subjid: str | None = None) -> DataFrame:
    who = _participants(subjects, subjid)
    wide = eav_pivot(domain(_of(facts, who, subjid), "dm", STUDY_A), ["subject_key"],
                     {"age": "AGE", "age_unit": "AGEU", "sex": "SEX"})
    return wide.join(who, "subject_key").groupBy("subjid").agg(
        *[F.max(c).alias(c) for c in ("age", "age_unit", "sex")])
