"""Readers and the fact store."""

import pytest

from cohortweave.operators.dictionary import entries, normalise_dictionary
from cohortweave.plans import quality
from cohortweave.sources import store
from cohortweave.sources.forms import read_dictionary, read_forms, read_markdown
from cohortweave.sources.store import (
    after_stored, cut_lineage, read_domains, read_facts, read_linkage, write_domains, write_facts, write_linkage,
)
from tests.helpers import event, facts, rows


def test_dictionary_csv_with_encoding(spark, tmp_path):
    path = tmp_path / "dict.csv"
    path.write_bytes("Standard_Domain,Standard_VAR,Standard_LABEL,STUDY_B_FORM,STUDY_B_VAR\n"
                     'AE,AETERM,"Événement, ""grave""",ae,AeTerm\nAE,AESEV,,ae,\n'.encode("latin1"))
    (m,) = entries(normalise_dictionary(read_dictionary(spark, str(path), "ISO-8859-1"), "STUDY_B"))
    assert (m.standard_label, m.source_form, m.source_var) == ('Événement, "grave"', "AE", "aeterm")


def test_forms_are_text(spark, tmp_path):
    (tmp_path / "ae.csv").write_text("source_row_number,subjid,dose\n0,001,1\n1,002,\n")
    forms = read_forms(spark, {"ae": str(tmp_path / "ae.csv")}, fmt="csv")
    assert rows(forms["AE"]) == [(0, "001", "1"), (1, "002", None)]
    spark.range(2).selectExpr("id AS source_row_number", "id + 1 AS dose").write.parquet(str(tmp_path / "ex"))
    assert rows(read_forms(spark, {"ex": str(tmp_path / "ex")})["EX"]) == [(0, "1"), (1, "2")]
    (tmp_path / "bad.csv").write_text("subjid\n1\n")
    with pytest.raises(KeyError, match="source_row_number"):
        read_forms(spark, {"bad": str(tmp_path / "bad.csv")}, fmt="csv")


def test_markdown_is_found_below(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "top.md").write_text("# Top\n\nline")
    (tmp_path / "a" / "b" / "deep.md").write_text("deep")
    (tmp_path / "a" / "skip.txt").write_text("no")
    assert rows(read_markdown(spark, str(tmp_path)), "text") == [("# Top\n\nline",), ("deep",)]


def test_store_round_trip_and_batches(spark, tmp_path):
    path = str(tmp_path / "facts")
    first = facts(spark, *event("ae", 1, 1, "2", AETERM="x"), *event("lb", 1, 1, None, LBTEST="y"))
    write_facts(first, path)
    assert rows(read_facts(spark, path)) == rows(first)
    second = facts(spark, *event("ae", 2, 1, AETERM="z"))
    for _ in range(2):  # a repeated load of one batch changes nothing
        write_facts(after_stored(second, read_facts(spark, path, without="b2")), path, "b2")
        stored = read_facts(spark, path)
        assert rows(stored, "domain", "value") == [("ae", "x"), ("ae", "z"), ("lb", "y")]
        assert rows(stored.where("domain = 'ae'"), "fact_id") == [(1,), (2,)]
    write_facts(facts(spark, *event("ae", 1, 1, AETERM="new")), path)
    assert rows(read_facts(spark, path), "domain", "value") == [("ae", "new"), ("ae", "z")]  # a batch is replaced as a whole
    write_facts(first.limit(0), path)
    assert rows(read_facts(spark, path), "value") == [("z",)]
    with pytest.raises(ValueError):
        write_facts(first, path, "../other")


def test_stored_ids_join_the_facts_without_moving_them(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_facts(facts(spark, *event("ae", 1, 1, AETERM="x")), path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as where the planner knows the size of neither side
    try:
        moved = after_stored(facts(spark, *event("ae", 2, 1, AETERM="z")), read_facts(spark, path))
        plan = moved._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert rows(moved, "fact_id") == [(2,)]


def test_a_large_domain_is_written_by_many_small_tasks(spark, tmp_path, monkeypatch):
    size = store.TASK_BYTES
    many = spark.range(0, 40_000, 1, 8).selectExpr(
        "'ae' AS domain", "id AS fact_id", "id % 1000 AS subject_key", "'STUDY_A' AS source_study", "'AETERM' AS standard_var",
        "'Term' AS standard_label", "uuid() AS value", "CAST(NULL AS STRING) AS value_code", "1 AS seqnum", "CAST(1 AS DECIMAL(10,2)) AS visitnum")
    monkeypatch.setattr(store, "WRITE_BYTES", 200_000)
    own = spark.conf.get(size, None)
    assert write_facts(many, str(tmp_path / "facts"))["n_rows"] == 40_000
    assert spark.conf.get(size, None) == own
    assert read_facts(spark, str(tmp_path / "facts")).select("fact_id").distinct().count() == 40_000
    assert len(list((tmp_path / "facts").rglob("*.parquet"))) >= 4


def test_writing_a_batch_tells_what_breaks_the_rules(spark, tmp_path):
    df = facts(spark, *event("ae", 9, 1, study="STUDY_C", AETERM="x"), dict(domain="dm", standard_var=None), *event("ae", 1, 1, AETERM="y"))
    seen = write_facts(df, str(tmp_path / "facts"))
    assert seen == {"n_rows": 3, "null_subject_key": 1, "null_source_study": 0, "null_standard_var": 1, "not_in_registry": 1}


def test_linkage_batches(spark, tmp_path):
    path = str(tmp_path / "links")
    pairs = spark.createDataFrame([(1, 10, 20, "exact"), (2, None, 21, None)],
                                  "linkage_id long, study_a_subject_key long, study_c_subject_key long, linkage_type string")
    write_linkage(pairs, path)
    write_linkage(pairs.where("linkage_id = 2"), path, "b2")
    write_linkage(pairs.where("linkage_id = 1"), path, "b2")
    assert rows(read_linkage(spark, path), "linkage_id") == [(1,), (1,), (2,)]
    assert rows(read_linkage(spark, path, without="b2"), "linkage_id") == [(1,), (2,)]


def test_large_domain_is_split_over_files(spark, tmp_path):
    path = tmp_path / "facts"
    many = spark.range(0, 60000, numPartitions=6).selectExpr(
        "'ae' AS domain", "id AS fact_id", "7L AS subject_key", "'STUDY_A' AS source_study",
        "'AETERM' AS standard_var", "'Term' AS standard_label", "uuid() AS value",
        "CAST(NULL AS STRING) AS value_code", "1 AS seqnum", "CAST(1 AS DECIMAL(10,2)) AS visitnum")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        write_facts(many, str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((path / "batch=first" / "domain=ae" / "source_study=STUDY_A").glob("*.parquet"))) >= 4
    assert read_facts(spark, str(path)).count() == 60000


def test_domain_checkpoint(spark, tmp_path):
    path = str(tmp_path / "audit")
    write_domains(facts(spark, *event("ae", 1, 1, AETERM="x")).drop("fact_id"), path)
    assert (tmp_path / "audit" / "domain=ae" / "source_study=STUDY_A").is_dir()
    assert rows(read_domains(spark, path), "domain", "source_study", "value") == [("ae", "STUDY_A", "x")]


def test_lineage_is_cut(spark):
    cut = cut_lineage(spark.range(5).selectExpr("id * 2 AS x"))
    plan = cut._jdf.queryExecution().toString()
    assert "Range" not in plan and "stage-" in plan and cut.count() == 5


def test_summaries_merge_over_batches(spark, tmp_path):
    """Counts add up, a visit that two batches know counts once, and a batch written again replaces its summary."""
    path = str(tmp_path / "facts")
    one = facts(spark, *event("ae", 1, 1, "1", AETERM="x", AESEV=" "), *event("vs", 2, 1, "2", VSTEST=None))
    two = facts(spark, *event("ae", 1, 2, "1", AETERM="y"), *event("ae", 1, 3, "2", AETERM=""))
    for batch, rows_ in (("one", one), ("two", one), ("two", two)):
        write_facts(rows_, path, batch)
        quality.write_summaries(spark, path, batch)
    both = one.unionByName(two)
    assert rows(quality.missingness_of(quality.read_summary(spark, path, "counts"))) == rows(quality.dq_missingness(None, both))
    visits = quality.read_summary(spark, path, "visits")
    assert rows(quality.visit_completeness_of(visits)) == rows(quality.dq_visit_completeness(None, both))
    assert visits.count() == 4 and visits.distinct().count() == 3
