"""Post-processing queries on the fixture, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.plans import (
    adverse, examination, history, labs, medication, quality, shaping, trace, vitals,
)
from fixtures.oracle_queries import (
    AE_BY_SUBJECT, AE_EVENTS, CM_BUCKETS, CM_SAE, COMPLETENESS, ELIGIBILITY, MH_ONSET, MH_QUESTIONS,
    MISSINGNESS, OUT_OF_RANGE, PE_ABNORMAL, QUERIES as NAMED, SUBJECT_EVENTS, dmy, num, vital_trends,
)
from fixtures.study_data import spark_facts, spark_subjects

_LABS = OUT_OF_RANGE.replace("$STUDY", "STUDY_A")
_ANSWERS = " UNION ALL ".join(
    f"SELECT *, '{study}' AS study FROM ({sql})" for study, sql in ELIGIBILITY.items())
_DATE = f"coalesce({dmy('start_raw')}, CAST(try_strptime(start_raw, '%Y-%m-%d') AS DATE))"
_NUMBER = "CASE WHEN regexp_matches(trim({0}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') THEN CAST(trim({0}) AS DOUBLE) END"
_TREND = f"""SELECT * REPLACE ({_NUMBER.format('result')} AS result) FROM ({_LABS})
WHERE {_NUMBER.format('result')} IS NOT NULL AND visitnum IS NOT NULL"""
# STUDY_B loses its onset dates here, so that one study is left without any.
_UNDATED = "CASE WHEN source_study = 'STUDY_B' THEN 'UNK' ELSE start_raw END"


def _on(plan, reader=None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        out = plan(spark_subjects(spark, sf), spark_facts(spark, sf))
        return reader(out) if reader else out
    return run


def _lab_rows(subjects, facts):
    return labs.out_of_range_lb(subjects, facts, study="STUDY_A")


def _vitals(subjects, facts):
    return vitals.vital_trends(subjects, facts, study="STUDY_A")


def _ae_rows(subjects, facts):
    return adverse.ae_events(subjects, facts, study="STUDY_A")


def _no_dates_in_b(onset: DataFrame) -> DataFrame:
    return onset.withColumn("start_raw", F.expr(_UNDATED))


def _slice(study: str, category: str):
    return _on(shaping.eligibility_all, lambda a: shaping.eligibility_slice(
        a.where(F.col("study") == study), category))


def _slice_sql(study: str, category: str) -> str:
    return f"""
SELECT subjid, scrno, criterion, answer, coalesce(criterion_met, false) AS criterion_met, reason,
       CAST(visitnum AS BIGINT) AS visitnum, study, NOT coalesce(criterion_met, false) AS highlight
FROM ({_ANSWERS}) WHERE study = '{study}' AND category = '{category}'"""


# name -> (query, tables, SQL)
PAGES = {
    "p_eligibility_funnel": (
        _on(shaping.eligibility_all, shaping.eligibility_funnel), ("subjects", "ie"), f"""
WITH a AS ({_ANSWERS}),
per AS (SELECT study, subjid, category, coalesce(bool_and(criterion_met), true) AS ok
        FROM a WHERE subjid IS NOT NULL GROUP BY ALL)
SELECT study, 'Screened' AS stage, count(DISTINCT CASE study WHEN 'STUDY_A' THEN scrno ELSE subjid END) AS count
FROM a GROUP BY study
UNION ALL SELECT study, 'Passed Inclusion', count(*) FILTER (WHERE category = 'INCLUSION' AND ok) FROM per GROUP BY study
UNION ALL SELECT study, 'Passed Exclusion', count(*) FILTER (WHERE category = 'EXCLUSION' AND ok) FROM per GROUP BY study
UNION ALL SELECT study, 'Enrolled', count(DISTINCT subjid) FROM a GROUP BY study"""),
    "p_eligibility_overall_a": (_slice("STUDY_A", "OVERALL"), ("subjects", "ie"), _slice_sql("STUDY_A", "OVERALL")),
    "p_eligibility_inclusion_b": (_slice("STUDY_B", "INCLUSION"), ("subjects", "ie"), _slice_sql("STUDY_B", "INCLUSION")),
    "p_eligibility_exclusion_b": (_slice("STUDY_B", "EXCLUSION"), ("subjects", "ie"), _slice_sql("STUDY_B", "EXCLUSION")),
    "p_eligibility_inclusion_c": (_slice("STUDY_C", "INCLUSION"), ("subjects", "ie"), _slice_sql("STUDY_C", "INCLUSION")),
    "p_eligibility_exclusion_c": (_slice("STUDY_C", "EXCLUSION"), ("subjects", "ie"), _slice_sql("STUDY_C", "EXCLUSION")),
    "p_pe_by_visit": (_on(examination.pe_abnormal, shaping.pe_by_visit), ("pe",),
                      f"SELECT * REPLACE (CAST(visitnum AS BIGINT) AS visitnum) FROM ({PE_ABNORMAL})"),
    "p_question_ids": (_on(history.mh_questions, shaping.question_ids), ("subjects", "mh"), f"""
SELECT *, 'Q' || dense_rank() OVER (PARTITION BY source_study ORDER BY question NULLS LAST) AS qid
FROM ({MH_QUESTIONS})"""),
    "p_response_share": (_on(history.mh_questions, shaping.response_share), ("subjects", "mh"), f"""
SELECT *, {num('100.0 * n / sum(n) OVER (PARTITION BY source_study, question)', 1)} AS pct
FROM ({MH_QUESTIONS})"""),
    "p_onset_dated": (_on(history.mh_onset, shaping.onset_dated), ("subjects", "mh"), f"""
SELECT *, {_DATE} AS date, strftime({_DATE}, '%Y-%m-%d') AS date_iso,
       TRY_CAST(regexp_extract(person_id, '([0-9]+)$', 1) AS BIGINT) AS person_num
FROM ({MH_ONSET}) WHERE {_DATE} IS NOT NULL"""),
    "p_onset_unparsed": (_on(history.mh_onset, shaping.onset_unparsed), ("subjects", "mh"),
                         f"SELECT count(*) FILTER (WHERE {_DATE} IS NULL) AS n_unparsed FROM ({MH_ONSET})"),
    "p_studies_without_onset": (
        _on(history.mh_onset, lambda o: shaping.studies_without_onset(_no_dates_in_b(o))), ("subjects", "mh"), f"""
SELECT x.s AS source_study FROM (VALUES ('STUDY_A'), ('STUDY_B'), ('STUDY_C')) x(s)
WHERE x.s NOT IN (SELECT source_study FROM (SELECT source_study, {_UNDATED} AS start_raw FROM ({MH_ONSET}))
                  WHERE {_DATE} IS NOT NULL)"""),
    "p_bucket_table": (_on(medication.cm_med_count_buckets, shaping.bucket_table), ("subjects", "cm"), f"""
SELECT source_study, """ + ", ".join(
        f"CAST(coalesce(sum(n_subjects) FILTER (WHERE med_bucket = '{b}'), 0) AS BIGINT) AS \"{b}\""
        for b in medication.BUCKETS) + f" FROM ({CM_BUCKETS}) GROUP BY source_study"),
    "p_med_frequency_subjects": (
        _on(medication.cm_freq, lambda f: shaping.med_frequency(f, "Subjects")), ("cm",),
        f"SELECT source_study, medication, subjects AS n FROM ({NAMED['q_cm_freq'][1]})"),
    "p_med_frequency_records": (
        _on(medication.cm_freq, lambda f: shaping.med_frequency(f, "Records")), ("cm",),
        f"SELECT source_study, medication, records AS n FROM ({NAMED['q_cm_freq'][1]})"),
    "p_sae_totals": (_on(medication.cm_sae, shaping.sae_totals), ("subjects", "ae", "cm"), f"""
SELECT count(*) AS subjects_with_sae, count(*) FILTER (WHERE n_distinct_meds > 0) AS on_medication
FROM ({CM_SAE})"""),
    "p_took_med_share": (_on(medication.cm_typhoid_meds, shaping.took_med_share), ("cm",), f"""
SELECT CASE took_med WHEN true THEN 'Yes' WHEN false THEN 'No' END AS response, subjects,
       CASE WHEN took_med IS NOT NULL THEN
         {num('100.0 * subjects / sum(subjects) FILTER (WHERE took_med IS NOT NULL) OVER ()', 1)} END AS pct
FROM ({NAMED['q_cm_typhoid_meds'][1]})"""),
    "p_vital_headline": (_on(_vitals, shaping.vital_headline), ("vs",), f"""
SELECT max(n_subjects) AS n_subjects, count(DISTINCT visitnum) AS n_visits,
       CAST(sum(n_measurements) AS BIGINT) AS n_measurements, count(DISTINCT test_display) AS n_tests
FROM ({vital_trends('STUDY_A')})"""),
    "p_vital_series": (_on(vitals.vital_trends, shaping.vital_series), ("vs",), f"""
WITH t AS ({vital_trends(None)})
SELECT t.*, 'Average ' || test_display || coalesce(' (' || (
         SELECT u.unit FROM t u WHERE u.source_study = t.source_study AND u.test_display = t.test_display
           AND u.unit IS NOT NULL ORDER BY u.visitnum NULLS LAST, u.unit LIMIT 1) || ')', '') AS axis_label
FROM t"""),
    "p_lab_flag_totals": (_on(_lab_rows, shaping.lab_flag_totals), ("lb",), f"""
SELECT count(*) AS n_out_of_range, count(*) FILTER (WHERE lower(trim(flag)) = 'high') AS n_high,
       count(DISTINCT CASE WHEN lower(trim(flag)) = 'high' THEN subject_key END) AS high_subjects,
       count(*) FILTER (WHERE lower(trim(flag)) = 'low') AS n_low,
       count(DISTINCT CASE WHEN lower(trim(flag)) = 'low' THEN subject_key END) AS low_subjects
FROM ({_LABS})"""),
    "p_lab_trend": (_on(_lab_rows, shaping.lab_trend), ("lb",), _TREND),
    "p_lab_reference_band": (_on(_lab_rows, shaping.lab_reference_band), ("lb",), f"""
SELECT test_name, min({_NUMBER.format('ref_low')}) AS ref_low, max({_NUMBER.format('ref_high')}) AS ref_high,
       first(unit ORDER BY subject_key, visitnum, unit) FILTER (WHERE unit IS NOT NULL) AS unit
FROM ({_TREND}) WHERE test_name IS NOT NULL GROUP BY test_name"""),
    "p_ae_headline": (
        _on(lambda s, f: shaping.ae_headline(s, f, study="STUDY_A")), ("subjects", "ae"), f"""
SELECT count(*) AS subjects_with_ae,
       {num("100.0 * count(*) / (SELECT count(*) FROM subjects WHERE source_study = 'STUDY_A' AND subjid IS NOT NULL)", 1)} AS pct_enrolled,
       CAST(sum(num_ae) AS BIGINT) AS total_ae, CAST(sum(num_sae) AS BIGINT) AS total_sae
FROM ({AE_BY_SUBJECT})"""),
    "p_ae_lines": (_on(_ae_rows, shaping.ae_lines), ("subjects", "ae"), f"""
SELECT subjid, seqnum, {dmy('ae_start')} AS ae_date,
       '**' || coalesce(nullif(ae_term, ''), 'AE') || '** — started ' || coalesce(ae_start, 'None')
       || ', severity ' || coalesce(severity, 'None') || ', ' || coalesce(relation, 'None')
       || CASE WHEN serious = 'Y' THEN ' **[SAE]**' ELSE '' END AS line
FROM ({AE_EVENTS})"""),
    "p_timeline_points": (_on(trace.subject_events, shaping.timeline_points), ("subjects", "ex", "ae"), f"""
SELECT subjid, event_type, event_date,
       CASE event_type WHEN 'ae' THEN coalesce(event_label, 'AE') || ' (' || coalesce(detail, '') || ')'
            ELSE event_label END AS text,
       CASE WHEN event_type = 'dose' THEN 'dose' WHEN detail LIKE '%[SAE]' THEN 'serious'
            ELSE 'non-serious' END AS severity_class
FROM ({SUBJECT_EVENTS})"""),
    "p_timeline_span": (_on(trace.subject_events, shaping.timeline_span), ("subjects", "ex", "ae"), f"""
SELECT subjid, min(event_date) AS first_date, max(event_date) AS last_date
FROM ({SUBJECT_EVENTS}) GROUP BY subjid"""),
    "p_empty_share": (_on(quality.dq_missingness, shaping.empty_share), ("facts",), f"""
SELECT *, {num('100.0 * empty_rows / total_rows', 1)} AS empty_pct FROM ({MISSINGNESS})"""),
    "p_completeness_long": (_on(quality.dq_visit_completeness, shaping.completeness_long), ("facts",), f"""
WITH c AS ({COMPLETENESS})
SELECT source_study, 'complete' AS status, complete AS subjects FROM c
UNION ALL SELECT source_study, 'incomplete', incomplete FROM c"""),
}
