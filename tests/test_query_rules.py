"""The null, ordering and encoding rules, one small frame each."""

import datetime as dt

import pytest

from cohortweave import catalog
from cohortweave.plans import adverse, enrollment, examination, history, medication, shaping, trace, vitals
from tests.helpers import event, facts, rows, subjects


def test_mh_record_is_a_distinct_row(spark):
    df = facts(spark, *event("mh", 1, None, MHTERM="a"), *event("mh", 1, None, MHTERM="b"),
               *event("mh", 1, 4, MHTERM="c"))
    assert rows(history.mh_coverage(None, df)) == [("STUDY_A", 1, 2)]


def test_answer_precedence_and_not_recorded(spark):
    def said(subject, value):
        return dict(domain="mh", subject_key=subject, standard_var="MHOCCUR", standard_label="Q", value=value)

    df = facts(spark, said(1, "Y"), said(1, "N"), said(2, "9"), said(3, None), said(4, "2"), said(4, "9"))
    people = subjects(spark, *[dict(subject_key=i) for i in range(1, 7)])
    assert rows(history.mh_questions(people, df)) == sorted([
        ("STUDY_A", "Q", "Yes", 1), ("STUDY_A", "Q", "Don't Know", 1), ("STUDY_A", "Q", None, 1),
        ("STUDY_A", "Q", "No", 1), ("STUDY_A", "Q", "Not recorded", 2)], key=repr)
    assert "Not recorded" not in {r.response for r in history.mh_questions(
        subjects(spark, *[dict(subject_key=i) for i in range(1, 5)]), df).collect()}


def test_visits_sort_as_text(spark):
    df = facts(spark, *[f for seq, visit in ((1, "2"), (2, "10"), (3, "2"), (4, None))
                        for f in event("mh", 1, seq, visit, MHTERM="Fever", MHSTDTC="01/JAN/2000")])
    people = subjects(spark, dict(subject_key=1, subjid="A-SYN-7"))
    assert rows(history.mh_onset(people, df), "person_id", "visits") == [("SYN-7", "10, 2")]


def test_sae_subject_without_medication(spark):
    df = facts(spark, *event("ae", 1, 1, AESER="1"), *event("ae", 2, 1, AESER="N"))
    people = subjects(spark, dict(subject_key=1, subjid="S1"), dict(subject_key=2, subjid="S2"))
    assert rows(medication.cm_sae(people, df)) == [("S1", 0, None)]


def test_anti_join_ignores_null_sequence(spark):
    df = facts(spark, *event("ae", 1, None, AETERM="kept", AEREFID="R1"),
               *event("ae", 1, 2, AETERM="dropped", AEREFID="R2"), *event("ae", 1, 3, AETERM="kept too"))
    people = subjects(spark, dict(subject_key=1, subjid="S1"))
    assert rows(adverse.ae_events(people, df, study="STUDY_A"), "ae_term") == [("kept",), ("kept too",)]
    assert rows(adverse.ae_by_subject(people, df, study="STUDY_A")) == [(1, "S1", 1, 0)]


def _doses(*days):
    return [f for i, (visit, day) in enumerate(days, start=1)
            for f in event("ex", 1, i, visit, EXSTDTC=day)]


def test_dose_window_edges(spark):
    df = facts(spark, *_doses(("2", "10/JAN/2020"), ("6", "20/JAN/2020")),
               *[f for i, day in enumerate(["09/JAN/2020", "10/JAN/2020", "19/JAN/2020", "20/JAN/2020",
                                            "31/DEC/2020", "UNK"])
                 for f in event("ae", 1, i, AESTDTC=day)])
    got = rows(adverse.ae_dose_response(None, df))
    # before the first dose: none; dose day: that dose; next dose day: the next one
    assert got == [(1, 1, 1, 2, 2.0, 0.0, 0.0), (2, 1, 1, 2, 2.0, 0.0, 0.0)]


def test_same_day_and_repeated_doses(spark):
    df = facts(spark, *_doses(("2", "10/JAN/2020"), ("6", "10/JAN/2020"), ("2", "12/JAN/2020")),
               *event("ae", 1, 1, AESTDTC="11/JAN/2020"), *event("ae", 1, 2, AESTDTC="15/JAN/2020"))
    # dose 1's first window is empty, its second holds one event, counted once per dose-1 row
    assert rows(adverse.ae_dose_response(None, df), "dose_n", "subjects_with_ae", "total_aes") == [
        (1, 1, 2), (2, 1, 1)]


def test_dose_without_events(spark):
    df = facts(spark, *_doses(("2", "10/JAN/2020")))
    assert rows(adverse.ae_dose_response(None, df)) == [(1, 1, 0, 0, 0.0, None, None)]


def _reading(study, subject, visit, label, value, var="VSORRES", **extra):
    return dict(domain="vs", source_study=study, subject_key=subject, visitnum=visit, standard_var=var,
                standard_label=label, value=value, **extra)


def test_positional_pairing(spark):
    """Three tests, two results, one unit; the null visit pairs with itself."""
    df = facts(spark, *[_reading("STUDY_A", 1, None, "t", t, "VSTEST") for t in ("Weight", "Height", "Temp")],
               _reading("STUDY_A", 1, None, "r", "60"), _reading("STUDY_A", 1, None, "r", "170"),
               _reading("STUDY_A", 1, None, "u", "kg", "VSORRESU"))
    assert rows(vitals.vital_trends(None, df, study="STUDY_A"), "visitnum", "test_display", "unit",
                "n_measurements", "avg_value", "sd") == [
        (None, "Height", None, 1, 170.0, None), (None, "Weight", "kg", 1, 60.0, None)]


def test_unit_facts_weight_a_measurement(spark):
    df = facts(spark, _reading("STUDY_B", 1, None, "Weight", "60"), _reading("STUDY_B", 2, None, "Weight", "63"),
               _reading("STUDY_B", 1, None, "WEIGHT  unit", "kg", "VSORRESU"),
               _reading("STUDY_B", 1, None, "Weight Unit", "kg", "VSORRESU"),
               _reading("STUDY_B", 2, None, "Weight unit", "kg", "VSORRESU"),
               _reading("STUDY_C", 3, "1", "Weight (kg)", "50"), _reading("STUDY_C", 3, "1", "Pulse", "50"))
    assert rows(vitals.vital_trends(None, df), "source_study", "unit", "n_measurements", "n_subjects",
                "avg_value", "sd") == [("STUDY_B", "kg", 3, 2, 61.0, 1.73), ("STUDY_C", "kg", 1, 1, 50.0, None)]


@pytest.mark.parametrize("value,counts", [("60", True), (" 60.5 ", True), ("-1", False), ("1e2", False),
                                          ("60.", False), ("ND", False), (None, False)])
def test_only_unsigned_plain_decimals(spark, value, counts):
    df = facts(spark, _reading("STUDY_C", 1, "1", "Weight (kg)", value))
    assert vitals.vital_trends(None, df, study="STUDY_C").count() == int(counts)


def test_large_and_fine_readings_keep_their_value(spark):
    def trend(*values):
        df = facts(spark, *[_reading("STUDY_C", i, "1", "Weight (kg)", v) for i, v in enumerate(values)])
        return rows(vitals.vital_trends(None, df), "n_measurements", "avg_value", "sd")

    assert trend("70", "80", "1000000000000") == [(3, 333333333383.3, 577350269146.32)]
    assert trend("1" + "0" * 40, "3" + "0" * 40) == [(2, 2e40, pytest.approx(1.4142135623730951e40))]
    assert trend("0.04999999", "0.05000001") == [(2, 0.1, 0.0)]


def test_eligibility_labels(spark):
    def asked(label, value):
        return dict(domain="ie", source_study="STUDY_C", subject_key=1, standard_var="IETEST",
                    standard_label=label, value=value)

    df = facts(spark, asked("no brackets", "1"), asked("<>", "2"), asked("a <x <y> z> b", None),
               asked("Acute illnesses <fever>", "2"), asked("acute illnesses <fever>", "2"))
    people = subjects(spark, dict(subject_key=1, source_study="STUDY_C", subjid="C1"))
    assert rows(enrollment.eligibility(people, df, study="STUDY_C"), "category", "criterion", "answer",
                "criterion_met") == sorted([
        ("INCLUSION", None, "Yes", True), ("INCLUSION", "", "No", False), ("INCLUSION", "x <y> z", None, None),
        ("EXCLUSION", "fever", "No", True), ("INCLUSION", "fever", "No", False)], key=repr)


def test_unknown_study_is_empty(spark):
    people = subjects(spark, dict(subject_key=1, subjid="A1"))
    df = facts(spark, *event("ie", 1, 1, IEORRES="Y"), _reading("STUDY_C", 1, "1", "Weight (kg)", "50"))
    assert enrollment.eligibility(people, df, study="STUDY_X").count() == 0
    assert vitals.vital_trends(people, df, study="STUDY_X").count() == 0


def test_eligibility_order(spark):
    df = facts(spark, *[dict(domain="ie", source_study="STUDY_C", subject_key=s, standard_var="IETEST",
                             standard_label=label, value="1", visitnum=v)
                        for s, label, v in ((1, "<a>", None), (1, "<b>", "2"), (1, "Acute illnesses <c>", "1"), (2, "<d>", "1"))])
    people = subjects(spark, dict(subject_key=1, source_study="STUDY_C"),
                      dict(subject_key=2, source_study="STUDY_C", subjid="C2"))
    assert [r.criterion for r in enrollment.eligibility(people, df, study="STUDY_C").collect()] == ["d", "b", "a", "c"]


def test_bucket_edges(spark):
    df = facts(spark, *[dict(domain="cm", subject_key=s, standard_var="CMTRT", value=f"M{i}")
                        for s, n in ((1, 1), (2, 3), (3, 4), (4, 6), (5, 7)) for i in range(n)])
    people = subjects(spark, *[dict(subject_key=i) for i in range(6)])
    got = medication.cm_med_count_buckets(people, df).collect()
    assert [(r.med_bucket, r.n_subjects) for r in got] == [("0", 1), ("1-3", 2), ("4-6", 2), ("7+", 1)]


def test_pe_null_visit_keeps_its_row(spark):
    df = facts(spark, *event("pe", 1, 1, None, PETEST="Skin", PEORRES="Abnormal"),
               *event("pe", 2, 1, None, PETEST="Heart", PEORRES="Abnormal"))
    assert rows(examination.pe_abnormal(None, df)) == [("STUDY_A", None, "Heart, Skin", 2)]


def _linked_case(spark):
    people = subjects(
        spark, dict(subject_key=1, subjid="A-SYN-1"), dict(subject_key=2, subjid="A-SYN-2"),
        dict(subject_key=3, source_study="STUDY_C", subjid="C-SYN-1", record_id="R3"))
    df = facts(
        spark, *event("ex", 1, 1, "2", EXSTDTC="05/FEB/2020"), *event("ex", 1, 2, "5", EXSTDTC="06/FEB/2020"),
        *event("ae", 1, 2, AETERM="Rash", AESTDTC="02/MAR/2020", AESEV="Mild", AEREL="Related", AESER="Y"),
        *event("ae", 1, 1, AETERM="Fever", AESTDTC="02/MAR/2020", AESEV="Severe", AEREL="Related", AESER="N"),
        *event("ae", 1, 3, AETERM="Ache", AESTDTC="UNK", AESEV="Mild", AEREL="Related", AESER="N"),
        *event("ae", 2, 1, AETERM="Other", AESTDTC="02/MAR/2020", AESEV="Mild", AEREL="Related", AESER="1"))
    return people, df


def test_profile(spark):
    people, df = _linked_case(spark)
    (row,) = trace.subject_profile(people, df).collect()
    assert (row.study_c_subject_key, row.record_id, row.dose_1_date, row.dose_2_date) == (
        3, "R3", dt.date(2020, 2, 5), None)
    assert (row.ae_count, row.sae_count) == (3, 1)
    assert row.ae_list == ("02-MAR-2020: Fever (Severe, Related) → 02-MAR-2020: Rash (Mild, Related) [SAE]")


@pytest.mark.parametrize("name", ["subject-profile", "subject-events", "subject-demographics"])
def test_one_subject_equals_its_part_of_all(spark, sf_dir, name):
    from fixtures.study_data import spark_facts, spark_subjects

    people, df = spark_subjects(spark, sf_dir), spark_facts(spark, sf_dir)
    key, subjid = people.where("source_study = 'STUDY_A' AND subject_key = 6").select(
        "subject_key", "subjid").first()
    whole = catalog.run_query(name, people, df)
    column = "study_a_subject_key" if name == "subject-profile" else "subjid"
    part = whole.where(whole[column] == (key if name == "subject-profile" else subjid))
    one = catalog.run_query(name, people, df, {"subjid": subjid})
    assert rows(one) == rows(part) and one.count() > 0


def test_unknown_query_name(spark):
    with pytest.raises(KeyError):
        catalog.run_query("nothing", None, None)


def test_funnel_skips_unanswered(spark):
    answers = spark.createDataFrame([
        ("STUDY_B", "S1", None, "INCLUSION", True), ("STUDY_B", "S1", None, "INCLUSION", None),
        ("STUDY_B", "S2", None, "INCLUSION", False), ("STUDY_B", "S2", None, "EXCLUSION", True),
        ("STUDY_A", None, "X1", "OVERALL", False), ("STUDY_A", "A1", "X2", "OVERALL", True),
    ], "study string, subjid string, scrno string, category string, criterion_met boolean")
    got = {(r.study, r.stage): r["count"] for r in shaping.eligibility_funnel(answers).collect()}
    assert got == {
        ("STUDY_A", "Screened"): 2, ("STUDY_A", "Passed Inclusion"): 0, ("STUDY_A", "Passed Exclusion"): 0,
        ("STUDY_A", "Enrolled"): 1, ("STUDY_B", "Screened"): 2, ("STUDY_B", "Passed Inclusion"): 1,
        ("STUDY_B", "Passed Exclusion"): 1, ("STUDY_B", "Enrolled"): 2}


def test_share_rounds_half_up(spark):
    df = spark.createDataFrame([("S", "d", 400, 1)], "source_study string, domain string, total_rows long, empty_rows long")
    assert shaping.empty_share(df).first().empty_pct == 0.3


def test_headline_without_enrolled_subjects(spark):
    people = subjects(spark, dict(subject_key=1))
    df = facts(spark, *event("ae", 1, 1, AETERM="x"))
    assert rows(shaping.ae_headline(people, df, study="STUDY_A")) == [(1, 0.0, 1, 0)]


def test_paired_vitals_move_once(spark, monkeypatch):
    from cohortweave.operators import sequence

    df = facts(spark, *[row for s in range(1, 41) for row in event("vs", s, 1, "1", VSTEST="Weight", VSORRES=str(s), VSORRESU="kg")])
    want = rows(vitals.vital_trends(None, df, study="STUDY_A"))
    monkeypatch.setattr(sequence, "TASK_ROWS", 10)  # 120 facts: 12 tasks, whatever the session's number
    pairs = vitals.positional_measurements(df)
    assert pairs.rdd.getNumPartitions() == 12
    assert pairs._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1
    assert rows(vitals.vital_trends(None, df, study="STUDY_A")) == want
