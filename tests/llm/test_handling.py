"""All operators alike: no rows, nulls in any column, empty and very long texts, repeated rows, columns of clashing names."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortweave.llm import (common, decontamination, jaccard_join, language_id, packing, quality_classifier, quality_rules, ranked_search,
                             scoring, secrets, sharding, spelling, substring_dedup)
from tests.llm import brute

BENCHMARK = [("i1", "w1 w2 w3"), ("i2", None), (None, "w7"), ("i3", "zzz w10 w11"), ("i3", "zzz w10 w11")]
LABELS = [(i, i % 2) for i in range(1, 9)] + [(None, 1), (2, None), (99, 1)]

#: Names that the operators use inside or return; no operator takes them from its input.
CLASHING = ("row", "n", "word", "node", "hub", "band", "bands", "content", "copies", "size", "key", "digest", "bucket", "term", "slots",
            "curve", "shard", "law", "slot", "number", "anchor", "doc", "tag", "verify", "windows", "repeats", "start", "length", "ids_crc32",
            "sequence_id", "offset", "score", "held_out", "lang_pred", "n_words", "kept", "spans", "items", "base", "runs", "class_id",
            "class_root", "n_links", "label", "view", "id", "run", "name", "h", "form", "rank", "block", "item", "own", "at")


def held(docs):
    return language_id.remainder() == 2


#: name to (what it does, the columns that are compared, whether it gives one row a document)
OPERATORS = {
    "op1": (lambda d, b, k: substring_dedup.remove_repeats(d, keep_text=False), ("doc_id", "n_words", "n_removed", "kept_sha256"), True),
    "op2": (lambda d, b, k: packing.pack(d), ("doc_id", "start", "length", "ids_crc32", "doc_tokens"), False),
    "op3": (lambda d, b, k: decontamination.find_contamination(d, b), ("doc_id", "n_words", "n_hit", "items_sha256"), True),
    "op4": (lambda d, b, k: sharding.shard(d), ("doc_id", "size", "text_crc32", "curve"), True),
    "op5": (lambda d, b, k: scoring.score(d, language_id.remainder("doc_id", 5) == 1), ("doc_id", "n_tokens", "n_known", "train_tokens"), True),
    "op6": (lambda d, b, k: quality_classifier.classify(d, k), ("doc_id", "quality"), True),
    "op7": (lambda d, b, k: secrets.find_secrets(d, "doc_id").select("doc_id", secrets.listed("spans").alias("found")), ("doc_id", "found"), True),
    "op8": (lambda d, b, k: language_id.identify(d, d.filter(~held(d)), held(d)), ("doc_id", "lang_pred"), True),
    "op9": (lambda d, b, k: quality_rules.judge(d).select("doc_id", "n_words", "n_repeat_words", "kept"), ("doc_id", "n_words", "n_repeat_words", "kept"), True),
    "op10": (lambda d, b, k: jaccard_join.join_classes(d), ("doc_id", "class_id", "n_links"), True),
    "op11": (lambda d, b, k: ranked_search.search(d, b), ("item_id", "rank", "doc_id", "score"), False),
    "op13": (lambda d, b, k: spelling.group_variants(d, spelling.DELETED), ("word", "form", "root", "n", "n_near", "form_n"), False),
}


def frames(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs, spark.createDataFrame(BENCHMARK, "item_id string, text string"), spark.createDataFrame(LABELS, "doc_id long, quality int")


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(12)
    text = lambda n: " ".join(f"w{draw.randint(0, 60)}" for _ in range(n))
    out = [(i, f"{text(60)} token: abcdefgh{i}", draw.choice(["en", "de", None]), draw.choice(["s1", None])) for i in range(1, 25)]
    out += [(None, None, None, None)] * 4 + [(3, "", "en", "s1"), (30, " \n\t", None, "s2"), (None, text(50), "en", None)]
    out += [(40, " ".join(f"v{draw.randint(0, 4000)}" for _ in range(120_000)), "en", "s3")]
    return out + out[:3]


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_and_clashing_columns(spark, rows, name):
    operator, columns, each = OPERATORS[name]
    docs, benchmark, labels = frames(spark, rows)
    plain = [tuple(r) for r in operator(docs, benchmark, labels).select(*columns).collect()]
    for k, c in enumerate(CLASHING):
        docs = docs.withColumn(c, F.lit(k) if k % 2 else F.lit("mine"))
    benchmark = benchmark.withColumn("block", F.lit(1)).withColumn("window", F.lit("x")).withColumn("term", F.lit(2))
    labels = labels.withColumn("label", F.lit("x")).withColumn("id", F.lit(1))
    got = [tuple(r) for r in operator(docs, benchmark, labels).select(*columns).collect()]
    assert brute.order(got) == brute.order(plain) and got
    if each:
        assert len(got) == len(rows)


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_no_rows(spark, rows, name):
    operator, columns, each = OPERATORS[name]
    docs, benchmark, labels = frames(spark, rows[:12])
    assert operator(docs.limit(0), benchmark.limit(0), labels.limit(0)).select(*columns).count() == 0
    if each:  # nothing to look for or to learn from
        assert operator(docs, benchmark.limit(0), labels.limit(0)).select(*columns).count() == 12


def test_texts_pass_python_in_small_batches(spark):
    own = spark.conf.get(common.ARROW_ROWS, None)
    sizes = common.staged(spark.range(0, 50, 1, 2).mapInArrow(_batch_sizes, "n long"), 10)
    assert sorted(r[0] for r in sizes.collect()) == [5, 5] + [10] * 4
    assert spark.conf.get(common.ARROW_ROWS, None) == own


def _batch_sizes(batches):
    for batch in batches:
        yield pa.RecordBatch.from_pydict({"n": [batch.num_rows]})
