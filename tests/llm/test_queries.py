"""Registered queries with SQL against it, and the pipeline's stages by what they must keep and drop."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from cohortweave.llm import decontamination, jaccard_join, quality_rules, secrets
from cohortweave.llm.common import staged
from tests.llm import brute
from tools.compare import compare, connect

ORACLES = {k: v for k, v in entry_points.oracle_sql().items() if k.startswith("op")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, sf_dir, name):
    n_rows, difference = compare(spark, connect(sf_dir), sf_dir, entry_points.queries()[name], ORACLES[name])
    assert n_rows > 0 and not difference


def test_every_operator_has_a_query():
    names = [n for n in entry_points.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def test_pipeline(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = source.unionByName(source.limit(5)).unionByName(source.limit(1).selectExpr(
        "doc_id", "CAST(NULL AS STRING) text", "lang", "source", "n_chars"))
    stages = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir))
        stages[name] = docs
    for name in list(stages)[:-1]:
        assert stages[name].columns == source.columns
    kept = quality_rules.judge(source).filter("kept")
    assert stages["quality_rules"].select("doc_id").distinct().count() == kept.count()
    rows = [tuple(r) for r in stages["quality_rules"].select("doc_id", "text").collect()]
    assert {r.doc_id for r in stages["jaccard_join"].collect()} == {c for _, c, _ in brute.classes(rows)}
    assert stages["jaccard_join"].count() == len({c for _, c, _ in brute.classes(rows)})
    assert jaccard_join.join_classes(stages["jaccard_join"]).filter("n_links > 0").count() == 0
    clean = decontamination.find_contamination(stages["jaccard_join"], spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    same = stages["decontamination"].join(stages["jaccard_join"].withColumnRenamed("text", "before"), "doc_id").filter("text = before")
    assert same.count() == clean.filter("NOT contaminated").count()
    found = secrets.find_secrets(stages["secret_scans"], "doc_id").filter("size(base) > 0")
    assert found.count() == 0
    assert stages["packing"].select("doc_id").distinct().count() == stages["secret_scans"].count()


def test_pipeline_cuts_the_union_of_all_blocks(spark, sf_dir, monkeypatch):
    words = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([("i1", words), ("i2", "zeta"), ("i3", "ten eleven"), ("i4", "x y")], "item_id string, text string")
    docs = spark.createDataFrame([(1, f"a {words} b"), (2, "Zeta, c"), (None, None), (1, "d ten eleven e"), (1, "d ten eleven e"),
                                  (3, f"x {words} y")], "doc_id long, text string")
    blocks = decontamination.window_blocks
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: items)
    got = {}
    for block in (1, 2, 200_000):
        monkeypatch.setattr(decontamination, "window_blocks", lambda b, n=None, k=block: blocks(b, k))
        got[block] = brute.order(map(tuple, corpus_pipeline.decontaminate(spark, docs, sf_dir).collect()))
    assert got[1] == got[2] == got[200_000] == brute.order([(1, "a  b"), (2, ", c"), (1, "d  e"), (1, "d  e"), (3, "x  y")])


CLASHING = ("_own", "_id", "_row", "_spans", "id", "own", "row", "base", "runs", "spans", "kept", "n_words", "content", "node", "hubs")


@pytest.mark.parametrize("block", [1, 200_000])
def test_stages_with_clashing_columns_nulls_and_no_rows(spark, sf_dir, monkeypatch, block):
    """Extra columns of any name come back as they were, whatever a stage does; no rows give no rows."""
    blocks = decontamination.window_blocks
    monkeypatch.setattr(decontamination, "window_blocks", lambda b, n=None: blocks(b, block))
    items = spark.createDataFrame([("i1", "one two three"), ("i2", "zeta eta")], "item_id string, text string")
    monkeypatch.setattr(corpus_pipeline, "table", lambda *a: items)
    words = " ".join(f"w{i} of the and to" for i in range(40))
    rows = [(1, f"{words} one two three zeta eta token: abcdefgh1", "en", None, 5), (1, words, None, "s", None), (None, None, None, None, None),
            (2, "", "en", "s", 0), (3, words + " x" * 3, "en", "s", 9), (3, words + " x" * 3, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for k, name in enumerate(CLASHING):
        docs = docs.withColumn(name, F.lit(f"mine{k}"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, sf_dir)
        assert got.columns == docs.columns
        kept = got.collect()
        assert all(r[c] == f"mine{k}" for r in kept for k, c in enumerate(CLASHING)), name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        if name == "decontamination":
            assert all("zeta" not in (r.text or "") for r in kept)
        if name == "secret_scans":
            assert len(kept) == len(rows) and any("[secret]" in (r.text or "") for r in kept)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == len(rows)
