"""What the plans must and must not contain, on a written store."""

import pytest

from cohortweave import catalog
from cohortweave.sources.store import read_facts, write_facts
from fixtures.study_data import spark_facts, spark_subjects


@pytest.fixture(scope="module")
def store(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("store")
    write_facts(spark_facts(spark, sf_dir), f"{folder}/facts")
    spark_subjects(spark, sf_dir).write.parquet(f"{folder}/subjects")
    return spark.read.parquet(f"{folder}/subjects"), read_facts(spark, f"{folder}/facts")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


PARAMS = {name: {"study": "STUDY_A"} for name in (
    "eligibility", "enrolled-count", "vital-trends", "out-of-range-lb", "ae-by-subject", "ae-severity", "ae-events")}


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_no_pair_joins_and_no_python(store, name):
    plan = plan_of(catalog.run_query(name, *store, PARAMS.get(name)))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert unwanted not in plan


@pytest.mark.parametrize("name,domain", [("cm-freq", "cm"), ("out-of-range-lb", "lb"), ("mh-onset", "mh")])
def test_only_the_domain_is_read(store, name, domain):
    plan = plan_of(catalog.run_query(name, *store, PARAMS.get(name)))
    assert f"(domain#" in plan and f" = {domain})" in plan and "PartitionFilters" in plan


def test_variables_reach_the_scan(store):
    plan = plan_of(catalog.run_query("cm-freq", *store))
    assert "PushedFilters: [IsNotNull(standard_var), EqualTo(standard_var,CMTRT)]" in plan
    assert "standard_label" not in plan


def test_all_domains_in_one_scan(store):
    assert plan_of(catalog.run_query("dq-missingness", *store)).count("FileScan") == 1


def test_dose_windows_need_no_join(store):
    plan = plan_of(catalog.run_query("ae-dose-response", *store))
    assert "Join" not in plan


def test_topk_rank_is_cut_before_the_shuffle(spark, sf_dir):
    from __spark_entry__ import queries

    assert "WindowGroupLimit" in plan_of(queries()["r_topk"](spark, sf_dir))


def test_one_subject_reads_few_row_groups(spark, tmp_path):
    """The subject's key reaches the scan, and row groups without the subject are skipped by their Bloom filters."""
    from cohortweave.plans.trace import subject_demographics
    from cohortweave.sources.store import read_facts, write_facts

    path, n = str(tmp_path / "facts"), 40_000
    facts = spark.range(n).selectExpr(
        "'dm' AS domain", "id AS fact_id", "xxhash64(id div 3) AS subject_key", "'STUDY_A' AS source_study",
        "element_at(array('AGE', 'AGEU', 'SEX'), CAST(id % 3 + 1 AS INT)) AS standard_var", "'x' AS standard_label",
        "concat('v', id) AS value", "CAST(NULL AS STRING) AS value_code", "1 AS seqnum", "CAST(1 AS DECIMAL(10,2)) AS visitnum")
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("parquet.block.size", "20000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_facts(facts, path)
        people = spark.range(n // 3).selectExpr("xxhash64(id) AS subject_key", "'STUDY_A' AS source_study", "concat('S', id) AS subjid")
        one = subject_demographics(people, read_facts(spark, path), subjid="S77")
        assert [tuple(r) for r in one.collect()] == [("S77", "v231", "v232", "v233")]
        leaves = one._jdf.queryExecution().executedPlan().collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size()) if "subject_key" in leaves.apply(i).simpleString(500) and "PushedFilters" in leaves.apply(i).simpleString(5000)]
        assert scans and any("EqualTo(subject_key" in s.simpleString(5000) or "In(subject_key" in s.simpleString(5000) for s in scans)
        assert min(s.metrics().apply("numOutputRows").value() for s in scans) < n / 10
    finally:
        hadoop.unset("parquet.block.size")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
