"""Named queries, callable by the endpoint name a dashboard uses."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame

from cohortweave.plans import (
    adverse, enrollment, examination, history, labs, medication, quality, trace, vitals,
)

QUERIES: dict[str, Callable[..., DataFrame]] = {
    "enrollment-summary": enrollment.enrollment_summary,
    "eligibility": enrollment.eligibility,
    "enrolled-count": enrollment.enrolled_count,
    "pe-abnormal": examination.pe_abnormal,
    "mh-coverage": history.mh_coverage,
    "mh-questions": history.mh_questions,
    "mh-onset": history.mh_onset,
    "cm-coverage": medication.cm_coverage,
    "cm-freq": medication.cm_freq,
    "cm-sae": medication.cm_sae,
    "cm-typhoid-meds": medication.cm_typhoid_meds,
    "cm-med-count-buckets": medication.cm_med_count_buckets,
    "cm-typhoid-med-list": medication.cm_typhoid_med_list,
    "cm-STUDY_B-detail": medication.cm_study_b_detail,
    "vital-trends": vitals.vital_trends,
    "subject-demographics": trace.subject_demographics,
    "out-of-range-lb": labs.out_of_range_lb,
    "ae-by-subject": adverse.ae_by_subject,
    "ae-severity": adverse.ae_severity,
    "ae-events": adverse.ae_events,
    "ae-dose-response": adverse.ae_dose_response,
    "linkage": trace.linkage,
    "subject-profile": trace.subject_profile,
    "subject-events": trace.subject_events,
    "dq-missingness": quality.dq_missingness,
    "dq-visit-completeness": quality.dq_visit_completeness,
    "dq-lab-flags": quality.dq_lab_flags,
}


def run_query(name: str, subjects: DataFrame, facts: DataFrame,
              params: Mapping[str, Any] | None = None) -> DataFrame:
    if name not in QUERIES:
        raise KeyError(f"no query named {name!r}; known: {', '.join(sorted(QUERIES))}")
    return QUERIES[name](subjects, facts, **(params or {}))
