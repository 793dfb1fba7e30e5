"""Ranked search, embedding near duplicates and spelling variants against plain versions, with nulls, empties, ties, repeats."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortweave.llm import common, embedding_dedup, ranked_search, spelling
from tests.llm import brute

DOCS = "doc_id long, text string"
ITEMS = "item_id string, text string"
VECTORS = "vec_id long, embedding array<float>, label int"


def same(got, want):
    assert brute.order(map(tuple, got)) == brute.order(want)


@pytest.fixture(scope="module")
def corpus():
    draw, rows = random.Random(11), []
    words = [f"w{i}" for i in range(60)] + ["Ärger", "ÉTÉ", "été", "x-ray", "don't", "\x00", "..."]
    for i in range(150):
        text = " ".join(draw.choices(words, weights=range(len(words), 0, -1), k=draw.choice([0, 1, 5, 40])))
        rows.append((draw.choice([None, i, i, i // 2]), draw.choice([None, text, text, text])))
    return rows + rows[:5]


@pytest.fixture
def small_groups(monkeypatch):
    monkeypatch.setattr(ranked_search, "BUCKET", 7)
    monkeypatch.setattr(ranked_search, "ITEMS", 3)


def test_search(spark, corpus, small_groups):
    items = [("a", "w0 w1 w1 W2"), ("b", "x ray w9 unknown"), ("c", None), ("d", ""), (None, "Ärger w3"), ("a", "w50"), ("a", "w50"),
             ("e", "été ÉTÉ"), ("f", "nothing known"), *((f"g{i}", f"w{i} w{i + 1} w0") for i in range(8))]
    docs = spark.createDataFrame(corpus, DOCS).withColumn("bucket", F.lit("x")).withColumn("term", F.lit(1)).repartition(4)
    asked = spark.createDataFrame(items, ITEMS).withColumn("block", F.lit(0)).withColumn("score", F.lit("s"))
    same(ranked_search.search(docs, asked).collect(), brute.search(corpus, items))
    same(ranked_search.search(docs, asked, best=2).collect(), brute.search(corpus, items, 2))


def test_search_of_nothing(spark, corpus):
    docs, items = spark.createDataFrame(corpus, DOCS), spark.createDataFrame([("a", "w1")], ITEMS)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (spark.createDataFrame([(1, None), (2, "..")], DOCS), items)):
        got = ranked_search.search(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and not got.collect()


def test_search_with_a_very_long_text_and_one_common_term(spark, small_groups):
    rows = [(1, "alpha beta " * 200_000), *((i, "alpha beta") for i in range(2, 40)), (40, "gamma alpha")]
    items = [("a", "beta gamma"), ("b", "alpha")]
    same(ranked_search.search(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)).collect(), brute.search(rows, items))


def vectors_around(seed, n, dims=16):
    """Vectors in clumps whose cosines lie on both sides of the threshold, and strays."""
    draw, rows = np.random.default_rng(seed), []
    centres = draw.normal(size=(6, dims))
    for i in range(n):
        v = draw.normal(size=dims) if i % 3 == 0 else centres[i % 6] + draw.normal(size=dims) * draw.choice([0.02, 0.1, 0.2])
        rows.append((i, [float(x) for x in (v * 10 ** float(draw.integers(-3, 4))).astype(np.float32)], int(i % 4 == 1)))
    return rows


ODD = [(1000, None, 0), (1001, [], 0), (1002, [0.0] * 16, 0), (1003, [1.0, None] * 8, 0), (1004, [math.nan] * 16, 0),
       (1005, [math.inf] * 16, 1), (1006, [1.0] * 16, None), (1007, [1.0] * 16, None), (1008, [1.0] * 3, 0), (1009, [2.0] * 3, 0),
       (1010, [1.0], 0), (1011, [5.0], 0), (1012, [-5.0], 0), (None, [1.0, 2.0] * 8, 0), (None, [1.0, 2.0] * 8, 0), (1013, [-0.0, 1.0], 0),
       (1014, [0.0, 1.0], 0), (1014, [0.0, 1.0], 0), (1015, [0.0, 3.0], 1)]


@pytest.mark.parametrize("block, visitors", [(2048, 16_384), (3, 5)])
def test_vectors(spark, monkeypatch, block, visitors):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    monkeypatch.setattr(embedding_dedup, "VISITORS", visitors)
    monkeypatch.setattr(embedding_dedup, "CELL", 4)
    rows = vectors_around(3, 240) + ODD
    rows += rows[:7]
    df = spark.createDataFrame(rows, VECTORS).withColumn("key", F.lit("k")).withColumn("node", F.lit(1)).repartition(3)
    want = brute.linked_vectors(rows)
    assert sum(r[1] for r in want) > 500
    same(embedding_dedup.link_vectors(df).collect(), want)
    doubles = df.withColumn("embedding", F.col("embedding").cast("array<double>")).withColumn("label", F.col("label").cast("string"))
    same(embedding_dedup.link_vectors(doubles).collect(), want)


def test_vectors_one_hot_group(spark, monkeypatch):
    """A third of all rows one clump of near copies, another third one vector."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 20)
    monkeypatch.setattr(embedding_dedup, "VISITORS", 30)
    draw = np.random.default_rng(4)
    centre = draw.normal(size=8)
    rows = [(i, [float(x) for x in (centre + draw.normal(size=8) * 0.03).astype(np.float32)], 5) for i in range(120)]
    rows += [(200 + i, [1.0] * 8, 5) for i in range(120)] + [(400 + i, [float(x) for x in draw.normal(size=8)], 5) for i in range(120)]
    rows = [(i, [float(np.float32(x)) for x in v], k) for i, v, k in rows]
    same(embedding_dedup.link_vectors(spark.createDataFrame(rows, VECTORS)).collect(), brute.linked_vectors(rows))


def test_vectors_recall_and_nothing(spark):
    rows = vectors_around(5, 300)
    want = {r[0]: r[1] for r in brute.linked_vectors(rows)}
    got = {r.vec_id: r.n_links for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, VECTORS), recall=0.9).collect()}
    assert sum(got.values()) >= 0.9 * sum(want.values()) and all(got[i] <= want[i] for i in want)
    empty = embedding_dedup.link_vectors(spark.createDataFrame([], VECTORS))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and not empty.collect()
    only_odd = [r for r in ODD if r[0] in (1000, 1001, 1002, 1006)]
    same(embedding_dedup.link_vectors(spark.createDataFrame(only_odd, VECTORS)).collect(), brute.linked_vectors(only_odd))


def test_visits_reach_every_link():
    """The traversal's bound never exceeds the distance: each pair at the threshold is visited."""
    rows = [r[1] for r in vectors_around(6, 400)]
    vectors = [np.array(v, "<f4").tobytes() for v in rows]
    z = embedding_dedup.halves(vectors, "<f4", 16)
    books = [embedding_dedup.fit(h, 16) for h in z]
    found = [embedding_dedup.bounds(h, b) for h, b in zip(z, books)]
    x = np.concatenate(z, axis=1)
    far = found[0][1][:, found[0][0]] + found[1][1][:, found[1][0]]
    distance = ((x[:, None] - x[None]) ** 2).sum(-1)
    assert (far <= distance + 1e-9).all() and ((distance < 0.04) & (far > 0)).any()


@pytest.mark.parametrize("levels", [1, 2, 16])
def test_variants(spark, levels):
    draw, rows = random.Random(13), []
    for i in range(90):
        words = ["".join(draw.choice("abÉ") for _ in range(draw.choice([4, 5, 5, 6, 7, 13]))) for _ in range(draw.choice([0, 3, 30]))]
        text = draw.choice([" ", "1", ", "]).join(w.upper() if draw.random() < 0.1 else w for w in words)
        rows.append((draw.choice([None, i, i]), draw.choice([None, text, text, text])))
    rows += rows[:9] + [(500, "Ärger arger árger " * 3), (501, "aaaaa aaaaaa aaaaaaa " * 4), (501, "aaaaaa " * 9)]
    df = spark.createDataFrame(rows, DOCS).withColumn("word", F.lit("w")).withColumn("id", F.lit(1)).repartition(4)
    same(spelling.group_variants(df, levels=levels).select("word", "form", "root", "n", "n_near", "form_n").collect(), brute.variants(rows))
    same(spelling.group_variants(df, 3, levels).select("word", "form", "root", "n", "n_near", "form_n").collect(), brute.variants(rows, 3))


def test_variants_of_very_long_words_and_of_nothing(spark):
    long = "xy" * 40_000
    rows = [(1, f"{long} " * 9), (2, f"{long[:30_000]}Q{long[30_000:]} " * 4), (3, f"{long[:-1]}Z " * 3), (4, "short words only")]
    want = [(w, f, r, n, k, m) for w, f, r, n, k, m in (
        (long, None, long, 9, 2, None), (f"{long[:30_000]}q{long[30_000:]}", long, long, 4, 1, 9), (f"{long[:-1]}z", long, long, 3, 1, 9))]
    got = spelling.group_variants(spark.createDataFrame(rows, DOCS)).select("word", "form", "root", "n", "n_near", "form_n")
    same(got.collect(), want)
    for none in ([], [(1, None), (None, ""), (2, "a b c")]):
        assert not spelling.group_variants(spark.createDataFrame(none, DOCS)).collect()


@pytest.mark.parametrize("deleted", [None, 3])
@pytest.mark.parametrize("limit, characters", [(2, 10**9), (1000, 100), (1000, 10**9)])
def test_words_are_counted_in_the_tasks(monkeypatch, deleted, limit, characters):
    """A task hands on its different words, not a row for each run; pieces of a text end between words."""
    monkeypatch.setattr(spelling, "SLICE", 40)
    rows = [(i if i % 3 else None, "Ünder\u00d7 unde\u00ff\u0100alpha\U0001f600BETAS\u00a0gamma\u0085gamma\x1cgamma ſtraße İstanb " * 5) for i in range(40)]
    rows += [(7, None), (8, ""), (9, " \n"), (10, "abcd efg")]
    batch = pa.RecordBatch.from_arrays([pa.array(["" if d is None else str(d) for d, _ in rows]), pa.array([t for _, t in rows])], ["name", "text"])
    got, made = Counter(), 0
    for out in spelling.count_words(deleted, limit, characters)(iter([batch, batch])):
        words = out.column(0).to_pylist()
        assert len(words) == len(set(words))
        got.update(dict(zip(words, out.column(1).to_pylist())))
        made += len(words)
    assert dict(got) == {w: n for w, _, _, n, _, _ in brute.variants(rows + rows, deleted)}
    assert made == len(got) if limit > 2 and characters > 100 else made > len(got)


def ddl(schema):
    return ", ".join(f"{f.name} {({'int64': 'long', 'int32': 'int'}).get(str(f.type), 'string')}" for f in schema)


def test_words_and_states_in_plans(spark):
    """No row for a run, no lambda for a state's edges, and the trie stays where it lies."""
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    docs = spark.createDataFrame([(1, "alpha alphas alpine " * 3)], DOCS)
    assert "Generate" not in plan(spelling.words_of(docs, 3))
    words = spark.createDataFrame([(0, "alpha"), (1, "alphas"), (2, "alpine")], "id long, word string")
    own = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(own, ("-1", "false")):
            spark.conf.set(k, v)
        with common.Buckets(spark) as buckets:
            trie = buckets.staged(words.mapInArrow(spelling.edges, ddl(spelling.EDGES)), "node", distinct=True)
            assert trie.count() == trie.distinct().count()
            live = words.mapInArrow(spelling.starts_of(2), ddl(spelling.STARTS))
            for joined in (spelling._edited(live, trie), spelling._stepped(spelling._edited(live, trie), trie)):
                text = plan(joined)
                assert "lambdafunction" not in text
                assert text.count("Exchange") == len(re.findall(r"SortMergeJoin \[node#\d+L\], \[node#\d+L\], Inner", text)) > 0
    finally:
        for k, v in own.items():
            spark.conf.set(k, v)


def test_variants_on_the_documents(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = spelling.op13_spelling_variants(spark, sf_dir).select("word", "form", "root", "n", "n_near", "form_n")
    same(got.collect(), brute.variants(rows, spelling.DELETED))
