"""What a dashboard computes on top of the named queries, as DataFrame transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions.dates import day_month_year, study_date
from cohortweave.functions.numbers import share
from cohortweave.functions.text import substring_from
from cohortweave.plans.adverse import ae_by_subject
from cohortweave.plans.enrollment import ELIGIBILITY, eligibility_rows, enrolled_count
from cohortweave.plans.medication import BUCKETS
from cohortweave.schema import STUDIES, STUDY_A

# Funnel stages in order.
STAGES = ("Screened", "Passed Inclusion", "Passed Exclusion", "Enrolled")


# ------------------------------------------------------------------ enrolment, eligibility
def eligibility_all(subjects: DataFrame, facts: DataFrame) -> DataFrame:
    """Eligibility answers of every study, with the study named."""
    out = None
    for study in STUDIES:
        part = eligibility_rows(subjects, facts, study).select(*ELIGIBILITY, F.lit(study).alias("study"))
        out = part if out is None else out.unionByName(part)
    return out


def eligibility_funnel(answers: DataFrame) -> DataFrame:
    """Subjects left at each stage per study.

    A subject passes a category when none of its answers fails; an unanswered criterion
    neither passes nor fails. STUDY_A counts screening numbers, the others subjects.
    """
    def passed(category: str) -> Column:
        return F.coalesce(F.bool_and(F.when(
            F.col("category") == category, F.col("criterion_met"))), F.lit(True)) & F.bool_or(
            F.col("category") == category)

    subjects = answers.where(F.col("subjid").isNotNull()).groupBy("study", "subjid").agg(
        passed("INCLUSION").alias("inclusion"), passed("EXCLUSION").alias("exclusion"))
    passes = subjects.groupBy("study").agg(
        F.count_if("inclusion").alias(STAGES[1]), F.count_if("exclusion").alias(STAGES[2]),
        F.count("*").alias(STAGES[3]))
    screened = answers.select(
        "study", F.when(F.col("study") == STUDY_A, F.col("scrno")).otherwise(F.col("subjid")).alias("id")
    ).groupBy("study").agg(F.count_distinct("id").alias(STAGES[0]))
    return screened.join(passes, "study", "left").na.fill(0).unpivot(
        ["study"], list(STAGES), "stage", "count")


def eligibility_slice(answers: DataFrame, category: str) -> DataFrame:
    """One category with ``criterion_met`` strict (unanswered is false) and failures marked."""
    met = F.coalesce(F.col("criterion_met"), F.lit(False))
    return answers.where(F.col("category") == category).drop("category").withColumns(
        {"criterion_met": met, "highlight": ~met, "visitnum": F.col("visitnum").cast("bigint")})


# ------------------------------------------------------------------ examination
def pe_by_visit(findings: DataFrame, study: str | None = None) -> DataFrame:
    rows = findings if study is None else findings.where(F.col("source_study") == study)
    return rows.withColumn("visitnum", F.col("visitnum").cast("bigint")).orderBy(
        "source_study", F.asc_nulls_last("visitnum"))


# ------------------------------------------------------------------ medical history
def question_ids(counts: DataFrame) -> DataFrame:
    """``Q1``, ``Q2``, ... per study in question order (the input has one row per study,
    question and response)."""
    place = F.dense_rank().over(Window.partitionBy("source_study").orderBy(F.asc_nulls_last("question")))
    return counts.withColumn("qid", F.concat(F.lit("Q"), place))


def response_share(counts: DataFrame) -> DataFrame:
    whole = F.sum("n").over(Window.partitionBy("source_study", "question"))
    return counts.withColumn("_whole", whole).withColumn("pct", share(F.col("n"), F.col("_whole"))).drop("_whole")


def onset_dated(onset: DataFrame) -> DataFrame:
    """Onsets with a readable date, in person, study and date order."""
    number = substring_from(F.col("person_id"), r"([0-9]+)\z")
    return onset.withColumn("date", study_date(F.col("start_raw"))).where(F.col("date").isNotNull()).select(
        "*", F.date_format("date", "yyyy-MM-dd").alias("date_iso"),
        number.try_cast("bigint").alias("person_num"),
    ).orderBy(F.asc_nulls_last("person_num"), "source_study", "date")


def onset_unparsed(onset: DataFrame) -> DataFrame:
    return onset.agg(F.count_if(study_date(F.col("start_raw")).isNull()).alias("n_unparsed"))


def studies_without_onset(onset: DataFrame) -> DataFrame:
    known = onset.sparkSession.createDataFrame([(s,) for s in STUDIES], "source_study string")
    return known.join(onset_dated(onset).select("source_study").distinct(), "source_study", "left_anti")


# ------------------------------------------------------------------ medication
def bucket_table(buckets: DataFrame) -> DataFrame:
    """One row per study, one column per bucket, zero where nobody falls in."""
    return buckets.groupBy("source_study").pivot("med_bucket", list(BUCKETS)).agg(
        F.sum("n_subjects")).na.fill(0)


def med_frequency(freq: DataFrame, measure: str) -> DataFrame:
    """Frequency by ``subjects`` or ``records``."""
    measure = measure.lower()
    if measure not in ("subjects", "records"):
        raise ValueError(f"count by subjects or records, not {measure!r}")
    return freq.select("source_study", "medication", F.col(measure).alias("n")).orderBy(
        F.desc("n"), "source_study", F.asc_nulls_last("medication"))


def sae_totals(sae: DataFrame) -> DataFrame:
    return sae.agg(F.count("*").alias("subjects_with_sae"),
                   F.count_if(F.col("n_distinct_meds") > 0).alias("on_medication"))


def took_med_share(typhoid: DataFrame) -> DataFrame:
    """Yes/No label and share; subjects without an answer have no label and no share."""
    response = F.when(F.col("took_med"), "Yes").when(~F.col("took_med"), "No")
    answered = F.when(F.col("took_med").isNotNull(), F.col("subjects"))
    return typhoid.select(
        response.alias("response"), "subjects",
        share(answered, F.sum(answered).over(Window.partitionBy())).alias("pct"))


# ------------------------------------------------------------------ vital signs
def vital_headline(trends: DataFrame) -> DataFrame:
    return trends.agg(
        F.max("n_subjects").alias("n_subjects"), F.count_distinct("visitnum").alias("n_visits"),
        F.sum("n_measurements").alias("n_measurements"), F.count_distinct("test_display").alias("n_tests"))


def vital_series(trends: DataFrame) -> DataFrame:
    """Points per test with the axis label, the test's first unit by visit in brackets."""
    first = F.min(F.when(F.col("unit").isNotNull(), F.struct(F.col("visitnum").isNull(), "visitnum", "unit")))
    unit = first.over(Window.partitionBy("source_study", "test_display"))["unit"]
    label = F.concat(F.lit("Average "), F.col("test_display"),
                     F.coalesce(F.concat(F.lit(" ("), F.col("_unit"), F.lit(")")), F.lit("")))
    return trends.withColumn("_unit", unit).withColumn("axis_label", label).drop("_unit").orderBy(
        "source_study", "test_display", F.asc_nulls_last("visitnum"))


# ------------------------------------------------------------------ laboratory
def lab_flag_totals(out_of_range: DataFrame) -> DataFrame:
    flag = F.lower(F.trim("flag"))
    columns = [F.count("*").alias("n_out_of_range")]
    for level in ("high", "low"):
        columns += [F.count_if(flag == level).alias(f"n_{level}"),
                    F.count_distinct(F.when(flag == level, F.col("subject_key"))).alias(f"{level}_subjects")]
    return out_of_range.agg(*columns)


def number_or_null(name: str) -> Column:
    col = F.trim(F.col(name))
    written = col.rlike(r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z")
    return F.when(written, col.cast("double"))


def lab_trend(out_of_range: DataFrame) -> DataFrame:
    """Numeric results with a visit, per test, subject by subject."""
    return out_of_range.withColumn("result", number_or_null("result")).where(
        F.col("result").isNotNull() & F.col("visitnum").isNotNull()
    ).orderBy(F.asc_nulls_last("test_name"), "subject_key", "visitnum")


def lab_reference_band(out_of_range: DataFrame) -> DataFrame:
    """Widest reference range per test, and the unit of the test's first row."""
    rows = lab_trend(out_of_range).where(F.col("test_name").isNotNull())
    return rows.groupBy("test_name").agg(
        F.min(number_or_null("ref_low")).alias("ref_low"),
        F.max(number_or_null("ref_high")).alias("ref_high"),
        F.expr("min_by(unit, struct(subject_key, visitnum, unit)) FILTER (WHERE unit IS NOT NULL)").alias("unit"))


# ------------------------------------------------------------------ adverse events
def ae_headline(subjects: DataFrame, facts: DataFrame, *, study: str) -> DataFrame:
    """Subjects with events, their share of the enrolled (0 when none is), event totals."""
    totals = ae_by_subject(subjects, facts, study=study).agg(
        F.count("*").alias("subjects_with_ae"), F.sum("num_ae").alias("total_ae"),
        F.sum("num_sae").alias("total_sae"))
    enrolled = enrolled_count(subjects, study=study)
    one = F.lit(1).alias("_one")  # two single-row results side by side
    return totals.select("*", one).join(enrolled.select("*", one), "_one").select(
        "subjects_with_ae",
        F.when(F.col("n") > 0, share(F.col("subjects_with_ae"), F.col("n"))).otherwise(0.0).alias("pct_enrolled"),
        "total_ae", "total_sae")


def ae_lines(events: DataFrame) -> DataFrame:
    """One readable line per event, by subject and date (unreadable dates last)."""
    def shown(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("None"))

    line = F.concat(
        F.lit("**"), F.when(F.col("ae_term") != "", F.col("ae_term")).otherwise("AE"),
        F.lit("** — started "), shown("ae_start"), F.lit(", severity "), shown("severity"),
        F.lit(", "), shown("relation"), F.when(F.col("serious") == "Y", " **[SAE]**").otherwise(""))
    return events.select("subjid", "seqnum", day_month_year(F.col("ae_start")).alias("ae_date"),
                         line.alias("line")).orderBy(
        F.asc_nulls_last("subjid"), F.asc_nulls_last("ae_date"), F.asc_nulls_last("seqnum"))


def timeline_points(events: DataFrame) -> DataFrame:
    """Timeline markers: what to show and whether the event is serious."""
    detail = F.coalesce(F.col("detail"), F.lit(""))
    ae = F.col("event_type") == "ae"
    hover = F.concat(F.coalesce(F.col("event_label"), F.lit("AE")), F.lit(" ("), detail, F.lit(")"))
    return events.select(
        "subjid", "event_type", "event_date",
        F.when(ae, hover).otherwise(F.col("event_label")).alias("text"),
        F.when(ae & detail.endswith("[SAE]"), "serious").when(ae, "non-serious")
         .otherwise("dose").alias("severity_class"))


def timeline_span(events: DataFrame) -> DataFrame:
    return events.groupBy("subjid").agg(
        F.min("event_date").alias("first_date"), F.max("event_date").alias("last_date"))


# ------------------------------------------------------------------ data quality
def empty_share(missingness: DataFrame) -> DataFrame:
    return missingness.withColumn("empty_pct", share(F.col("empty_rows"), F.col("total_rows")))


def completeness_long(completeness: DataFrame) -> DataFrame:
    return completeness.unpivot(["source_study"], ["complete", "incomplete"], "status", "subjects")
