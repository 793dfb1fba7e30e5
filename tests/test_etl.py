"""Dictionary, unpivoting, loading and checks on small frames."""

import re

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import checks
from cohortweave.operators.dictionary import (
    dedupe_dictionary, empty_domains, entries, first_mapping, form_coverage, normalise_dictionary,
    place_entries, study_dictionary,
)
from cohortweave.operators.load import (
    normalise_columns, route_domain, route_rows, skipped_sheets, to_facts, usable,
)
from cohortweave.operators.pivot import eav_pivot
from cohortweave.operators.unpivot import ie_sequence, pack_forms
from cohortweave.plans import etl
from cohortweave.schema import STUDIES, domain_registry
from fixtures.wide_data import DICTIONARY_COLUMNS, spark_dictionary, spark_form
from tests.helpers import event, facts, rows, subjects


def dictionary(spark, study, *lines):
    """Lines of (domain, variable, label, form, source variable)."""
    schema = ("Standard_Domain string, Standard_VAR string, Standard_LABEL string, "
              f"{study}_FORM string, {study}_VAR string, dict_row long")
    return spark.createDataFrame([(*line, i) for i, line in enumerate(lines)], schema)


def form(spark, columns, *lines):
    names = ["source_row_number", *columns]
    schema = ", ".join(f"`{n}` {'long' if n == 'source_row_number' else 'string'}" for n in names)
    return spark.createDataFrame([(i, *line) for i, line in enumerate(lines)], schema)


def test_dictionary_is_cleaned(spark):
    raw = spark_dictionary(spark)
    a = entries(study_dictionary(raw, "STUDY_A"))
    assert (a[0].domain, a[0].source_form, a[0].source_var) == ("AE", "AE", "aeterm")
    assert [m.source_var for m in a if m.domain == "IE"] == ["ieorres", "iesfreason", "ieeligreason"]
    assert "" not in {m.source_var for m in a}
    assert all(m.source_form == m.source_form.lower() for m in entries(study_dictionary(raw, "STUDY_C")))


def test_dictionary_needs_its_columns(spark):
    raw = spark_dictionary(spark)
    with pytest.raises(KeyError, match="STUDY_B_VAR"):
        normalise_dictionary(raw.drop("STUDY_B_VAR"), "STUDY_B")


def test_dictionary_keeps_the_first_of_equal_rows(spark):
    raw = dictionary(spark, "STUDY_C", ("CM", "CMTRT", "Med", "one", "x"), ("CM", "CMTRT", "Med", "two", "X "),
                     ("CM", "CMTRT", "Other", "three", "x"))
    kept = entries(dedupe_dictionary(normalise_dictionary(raw, "STUDY_C")))
    assert [(m.source_form, m.standard_label) for m in kept] == [("one", "Med"), ("three", "Other")]
    assert first_mapping(kept, "x", "CM").standard_label == "Med"
    assert first_mapping(kept, "x", "VS") is None


def test_extras_need_the_domain(spark):
    raw = dictionary(spark, "STUDY_A", ("AE", "AETERM", "Term", "AE", "aeterm"))
    assert [m.domain for m in entries(study_dictionary(raw, "STUDY_A"))] == ["AE"]


def test_form_coverage(spark):
    mapping = study_dictionary(spark_dictionary(spark), "STUDY_A")
    assert rows(form_coverage(["ae", "Sae", "readme", "spare"], mapping), "form", "status") == [
        ("SPARE", "unmapped"), ("IE", "missing"), ("GONE", "missing")]


def test_sequence_of_events(spark):
    """Null subjects are one group; one visit on two forms orders by form; visits order
    as numbers with missing ones last."""
    raw = dictionary(spark, "STUDY_A", ("AE", "T", "t", "zz", "t"), ("AE", "T", "t", "aa", "t"), ("AE", "U", "u", "aa", "t"))
    columns = ["subjid", "visit", "t"]
    forms = {
        "zz": form(spark, columns, ("s", "10", "z0"), ("s", "2", "z1"), (None, "1", "z2"), ("s", "2", "")),
        "AA": form(spark, columns, ("s", "2", "a0"), (None, None, "a1"), ("s", None, "a2"), (None, "1", None))}
    got = etl.process_forms("STUDY_A", raw, forms)
    assert rows(got.where("standard_var = 'T'"), "value", "seqnum", "row_id") == [
        ("a0", 1, 4), ("z1", 2, 2), ("z0", 3, 1), ("a2", 4, 8), ("z2", 1, 3), ("a1", 2, 6)]
    assert rows(got.where("standard_var = 'U'"), "value", "seqnum", "row_id") == [
        ("a0", 1, 5), ("a1", 2, 7), ("a2", 4, 9)]


def test_numbering_keeps_the_row_count(spark, sf_dir):
    wide = spark_form(spark, sf_dir, "a_ae")
    n_cells = sum(wide.where(f"{c} <> ''").count() for c in ("aeterm", "aestdt", "aesev", "aeser"))
    raw = spark_dictionary(spark)
    assert etl.process_forms("STUDY_A", raw, {"AE": wide}).where("domain = 'AE'").count() == n_cells


def test_pivot_undoes_unpivot(spark, sf_dir):
    wide = spark_form(spark, sf_dir, "a_ae")
    raw = spark_dictionary(spark)
    back = eav_pivot(
        etl.process_forms("STUDY_A", raw, {"AE": wide}).where("domain = 'AE'"), ["scrno", "seqnum"],
        {"aeterm": "AETERM", "aestdt": "AESTDTC", "aesev": "AESEV", "aeser": "AESER"})
    columns = ["scrno", "aeterm", "aestdt", "aesev", "aeser"]
    blank = wide.withColumn("aesev", F.when(F.col("aesev") != "", F.col("aesev")))
    # rows without a subjid share one numbering, so there (scrno, seqnum) is still unique
    assert rows(back, *columns) == rows(blank, *columns)


def test_ie_sequences(spark):
    lines = [("IE", "V", "v", "F", v) for v in ("b", "ex1", "in1x", "in1", "gone", "in12")] + [("DM", "V", "v", "F", "ex1")]
    columns = ["studyid", "in1", "b", "in1x", "in12", "ex1"]

    def numbers(study):
        placed = place_entries(study_dictionary(dictionary(spark, study, *lines), study), {"F": columns})
        return {r.mapping: r.ie_seq for r in ie_sequence(placed, study).collect() if r.mapping < 100}

    assert numbers("STUDY_A") == {3: 2, 0: 3, 2: 4, 5: 5, 1: 6, 6: None}
    assert numbers("STUDY_B") == {3: 1, 0: 2, 2: 1, 5: 3, 1: 4, 6: None}


def test_forms_without_mapped_columns_or_names(spark):
    raw = dictionary(spark, "STUDY_A", ("AE", "T", "t", "aa", "t"), ("AE", "T", "t", "bb", "t"))
    forms = {"aa": form(spark, ["subjid", "t", "u"], ("s", "x", "y")), "bb": form(spark, ["subjid"], ("s",)),
             "cc": form(spark, ["subjid", "t"], ("s", "z"))}
    assert rows(etl.process_forms("STUDY_A", raw, forms), "source_form", "value") == [("AA", "x")]
    with pytest.raises(ValueError, match="no form"):
        etl.process_forms("STUDY_A", raw, {"cc": forms["cc"]})


def test_one_scan_a_form_and_no_plan_that_grows_with_the_dictionary(spark, tmp_path):
    """A thousand entries for two columns: the plan holds one scan, the two columns and one join."""
    path = str(tmp_path / "wide")
    form(spark, ["subjid", "t", "u", "spare"], ("s", "x", "y", "z")).write.parquet(path)
    packed = {n: pack_forms({"AA": spark.read.parquet(path)}, study_dictionary(dictionary(spark, "STUDY_A", *[
        (f"D{i % 7}", f"V{i}", "l", "aa", "tu"[i % 2]) for i in range(n)]), "STUDY_A"), "STUDY_A") for n in (10, 1000)}
    plans = {n: df._jdf.queryExecution().executedPlan() for n, df in packed.items()}
    for plan in plans.values():
        read = [re.sub(r"#\d+L?", "", scan) for scan in re.findall(r"FileScan parquet \[(.*?)\]", plan.toString())]
        assert read == ["source_row_number,subjid,t,u", "mapping,domain,source_form,place"]
        assert plan.toString().count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan.toString()
    assert plans[10].toString().count("\n") == plans[1000].toString().count("\n")
    assert packed[1000].select(F.sum(F.size("cells"))).first()[0] == 1000


def record_dictionary(spark):
    return dictionary(spark, "STUDY_C", ("PE", "PEYN", "Examined", "exam", "peyn"),
                      ("CM", "CMTRT", "Med", "meds", "cmtrt"))


def test_backfill_and_visits(spark):
    wide = form(spark, [" Record_ID", "SUBJID", "RedcapEventName", "cmtrt"],
                ("1", None, "visit_2_arm_1", "b"), ("1", "", "Visit1arm1 ", "a"), ("1", "S1", "visit3_arm_1", "c"),
                ("1", None, "bad", "d"), ("2", None, "visit_1_arm_1", "e"), (None, "S9", None, "f"))
    got = etl.process_record_export("STUDY_C", record_dictionary(spark), wide)
    assert rows(got, "value", "record_id", "subjid", "visitnum", "seqnum") == [
        ("a", "1", "S1", 1, 1), ("b", "1", "S1", 2, 2), ("c", "1", "S1", 3, 3), ("d", "1", "S1", None, 4),
        ("e", "2", None, 1, 1), ("f", None, "S9", None, 1)]


def test_record_export_needs_columns(spark):
    with pytest.raises(ValueError, match="event"):
        etl.process_record_export("STUDY_C", record_dictionary(spark), form(spark, ["record_id"], ("1",)))
    with pytest.raises(ValueError, match="subject"):
        etl.process_record_export(
            "STUDY_C", record_dictionary(spark), form(spark, ["redcap_event_name"], ("visit1arm1",)))


def test_decoding(spark):
    columns = ["record_id", "redcap_event_name", "petest1", "peres1", "peres2", "pedesc1"]
    wide = form(spark, columns, ("1", "x", " Skin ", "2", "1", "red"), ("1", "x", "Skin", "5", None, None),
                ("1", "x", None, "1", None, None), ("1", "x", "Skin", "", None, None), ("1", "x", "Skin", "9.0", None, None))
    got = etl.process_record_export("STUDY_C", record_dictionary(spark), wide)
    assert rows(got, "standard_label", "value", "value_code", "pedesc", "source_form") == [
        ("Skin", "Abnormal", "2", "red", "physical_examination"),
        ("Skin", "UNMAPPED_CODE_5", "5", None, "physical_examination"),
        ("Skin", "Not assessed", "9.0", None, "physical_examination")]


def test_positional_findings_replace_scalar_ones(spark):
    columns = ["record_id", "redcap_event_name", "peyn", "petest1", "peres1"]
    with_finding = form(spark, columns, ("1", "x", "Yes", "Skin", "1"))
    without = form(spark, columns, ("1", "x", "Yes", "Skin", None))
    d = record_dictionary(spark)
    assert rows(etl.process_record_export("STUDY_C", d, with_finding), "standard_var") == [("PEORRES",)]
    assert rows(etl.process_record_export("STUDY_C", d, with_finding, keep_scalar=True), "standard_var") == [
        ("PEORRES",), ("PEYN",)]
    assert rows(etl.process_record_export("STUDY_C", d, without), "standard_var") == [("PEYN",)]


def test_three_studies_load_cleanly(spark, sf_dir):
    """Every unpivoted row becomes a fact of a known subject, and no identifier repeats."""
    raw = spark_dictionary(spark)
    parts = {
        "STUDY_A": etl.process_forms("STUDY_A", raw, {"AE": spark_form(spark, sf_dir, "a_ae")}),
        "STUDY_B": etl.process_forms("STUDY_B", raw, {"MH": spark_form(spark, sf_dir, "b_mh")}),
        "STUDY_C": etl.process_record_export("STUDY_C", raw, spark_form(spark, sf_dir, "c_main"))}
    loaded = etl.load_checkpoints(parts)
    people = loaded.resolution.subjects
    assert loaded.facts.count() == sum(p.count() for p in parts.values())
    assert loaded.resolution.rejected.count() == 0
    assert checks.check_subject_ids(people).count() == 0
    assert checks.check_fk(loaded.facts, people).count() == 0
    assert checks.check_unique(loaded.facts, ["domain", "fact_id"]).count() == 0
    n_records = spark_form(spark, sf_dir, "c_main").select("record_id").distinct().count()
    assert people.where("source_study = 'STUDY_C'").count() == n_records
    again = etl.load_checkpoints(parts, existing=people)
    assert again.resolution.subjects.count() == people.count()


def test_manual_form(spark, sf_dir):
    wide = spark_form(spark, sf_dir, "linkage")
    assert etl.unmapped_manual_columns(wide) == ["reviewer"]


def test_header_spellings_and_duplicates(spark):
    df = spark.createDataFrame([("a", None, "x", 1, "no"), (None, "b", "y", 2, "no")],
                               "Standard_VAR string, StandardVAR string, VALUE string, SeqNum int, extra string")
    out = normalise_columns(df)
    assert out.columns == ["standard_var", "value", "seqnum"]
    assert rows(out) == [("a", "x", 1), ("b", "y", 2)]
    assert usable(out) and not usable(normalise_columns(df.select("VALUE")))


def test_routes(spark):
    assert [route_domain(s) for s in ("DM", "Comment", "CO", "identifier", "XX")] == ["dm", "co", "co", None, None]
    df = spark.createDataFrame([("Comment",), ("AE",), ("identifier",), ("XX",), ("XX",)], "domain string")
    assert rows(route_rows(df)) == [("co",), ("ae",)]
    assert rows(skipped_sheets(df)) == [("identifier", 1), ("XX", 2)]


def test_fact_types(spark):
    df = spark.createDataFrame([("ae", "STUDY_A", 5, 1, "V", "3.0", "2"), ("ae", "STUDY_B", 5, 1, "V", None, "first")],
                               "domain string, source_study string, row_id long, subject_key long, standard_var string, seqnum string, visitnum string")
    got = to_facts(df).orderBy("source_study").collect()
    assert [(r.seqnum, r.visitnum and float(r.visitnum), r.value) for r in got] == [(3, 2.0, None), (None, None, None)]
    assert got[0].fact_id < got[1].fact_id


def test_checks_find_nothing_in_good_data(spark):
    df = facts(spark, *event("ae", 1, 1, AETERM="x"))
    people = subjects(spark, dict(subject_key=1, subjid="S"), dict(subject_key=2), dict(subject_key=3))
    assert checks.check_registry(df, domain_registry(spark)).count() == 0
    assert checks.check_fk(df, people).count() == 0
    assert checks.check_subject_ids(people).count() == 0
    assert rows(checks.check_not_null(df)) == [("ae", 0, 0, 0)]


def test_checks_find_violations(spark):
    df = facts(spark, *event("ae", 9, 1, study="STUDY_C", AETERM="x"), dict(domain="dm", standard_var=None))
    people = subjects(spark, dict(subject_key=1, subjid="S"), dict(subject_key=2, subjid="S"))
    assert rows(checks.check_registry(df, domain_registry(spark))) == [("ae", "STUDY_C", 1)]
    assert rows(checks.check_fk(df, people), "domain", "subject_key") == [("ae", 9)]
    assert rows(checks.check_subject_ids(people)) == [("subjid", "STUDY_A", "S", 2)]
    pair = spark.createDataFrame([(1, 2), (1, 2), (1, None), (1, None)], "a long, c long")
    assert rows(checks.check_unique(pair, ["a", "c"])) == [(1, 2, 2)]


def test_empty_domain_report(spark):
    mapping = study_dictionary(spark_dictionary(spark), "STUDY_B")
    got = spark.createDataFrame([("MH",)], "domain string")
    assert rows(empty_domains(got, mapping)) == [("IE",), ("DM",)]


def test_dictionary_covers_all_studies():
    assert all(f"{s}_VAR" in DICTIONARY_COLUMNS for s in STUDIES)
