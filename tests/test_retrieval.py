"""Chunking and vector search."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortweave.operators import chunking, retrieval
from tests.helpers import rows
from tests.splitter import split_text


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


@pytest.mark.parametrize("size,overlap", [(10, 3), (10, 0), (10, 5), (10, 8), (1, 0)])
def test_fixed_chunks(spark, size, overlap):
    texts = ["", None, "abc", "a" * 10, "abcdefghijklm", "é" * 25, "line\nbreak\r\n" * 3, "𝄞x" * 12]
    out = chunking.explode_chunks(chunking.chunk(docs(spark, *texts), size, overlap, by_separator=False))
    want = []
    for i, text in enumerate(texts):
        start = 0
        while text:
            want.append((i, text[start:start + size]))
            if start + size >= len(text):
                break
            start += size - overlap
    assert rows(out, "doc_id", "text") == want


def test_overlap_must_fit(spark):
    for by_separator in (True, False):
        with pytest.raises(ValueError):
            chunking.chunk(docs(spark, "x"), 10, 10, by_separator)


def split(text, size=20, overlap=5):
    return list(split_text(text, size, overlap))


def test_paragraphs_come_first():
    # the first two paragraphs fit together (19 characters); the third (22) is cut at its
    # line breaks first, then at blanks
    assert split("one two\n\nthree four\n\nfive six seven eight") == [
        "one two\n\nthree four", "\n", "\nfive six seven", " eight"]


def test_small_pieces_are_joined_and_overlap():
    assert split("aa bb cc dd ee ff gg hh") == ["aa bb cc dd ee ff gg", " gg hh"]


def test_one_unbroken_word():
    word = "".join(chr(97 + i % 26) for i in range(50))
    assert split(word) == [word[0:20], word[15:35], word[30:50]]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n", max_size=400), st.integers(5, 40), st.integers(0, 4))
def test_chunks_cover_the_text(text, size, overlap):
    chunks = list(split_text(text, size, overlap))
    assert all(0 < len(c) <= size for c in chunks)
    at = 0
    for c in chunks:  # each chunk starts no later than the text covered so far, at most `overlap` before
        start = next((s for s in range(max(0, at - overlap), at + 1) if text.startswith(c, s) and s + len(c) > at), None)
        assert start is not None
        at = start + len(c)
    assert at == len(text)


def test_separator_chunks_on_spark(spark):
    text = "word " * 700
    out = chunking.explode_chunks(chunking.chunk(docs(spark, text, "", None, "short", " \n\n\u3000\x1f")))
    by_doc = {}
    for r in out.collect():
        by_doc.setdefault(r.doc_id, []).append((r.chunk_no, r.text, r.chunk_id))
    assert set(by_doc) == {0, 3}
    assert [t for _, t, _ in sorted(by_doc[0])] == [c.strip() for c in split_text(text) if c.strip()]
    assert by_doc[3] == [(0, "short", "3:0")]


@pytest.mark.parametrize("size,overlap", [(20, 5), (7, 0), (12, 11), (9, 3)])
def test_separator_chunks_equal_the_plain_splitter(spark, size, overlap):
    draw = random.Random(size)
    texts = [None, "", "\n", "\n\n\n\n", "a" * 50, "é𝄞" * 30, "x" * size, " " * 60, "\n\n" + "y" * (size - 2)]
    texts += ["".join(draw.choices("ab \n𝄞", weights=draw.choice([(9, 9, 2, 1, 1), (2, 2, 3, 3, 0), (30, 9, 1, 0, 1)]), k=draw.randint(0, 300)))
              for _ in range(150)]
    got = docs(spark, *texts).select("doc_id", chunking.separator_chunks(F.col("text"), size, overlap).alias("c")).collect()
    for r in got:
        want = [c.strip() for c in split_text(texts[r.doc_id] or "", size, overlap) if c.strip()]
        assert r.c == want, repr(texts[r.doc_id])


def test_separator_chunks_run_no_python(spark, sf_dir):
    plan = chunking.chunk(docs(spark, "x"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan


def test_separator_chunks_of_a_very_long_text(spark):
    text = "some words\nand lines " * 60_000
    (row,) = chunking.chunk(docs(spark, text)).collect()
    assert row.chunks == [c.strip() for c in split_text(text) if c.strip()]


def test_corpus_wide_ids(spark):
    packed = chunking.chunk(docs(spark, "abcdefghij", "", "klm"), 4, 1, by_separator=False)
    assert rows(chunking.with_chunk_id(packed), "chunk_id", "doc_id", "text") == [
        ("id1", 0, "abcd"), ("id2", 0, "defg"), ("id3", 0, "ghij"), ("id4", 2, "klm")]


def test_corpus_wide_ids_of_named_documents(spark):
    texts = spark.createDataFrame([(f"doc{i}.md", "x" * n) for i, n in enumerate((3, 9, 0, 5))], "doc_id string, text string")
    got = chunking.with_chunk_id(chunking.chunk(texts, 4, 0, by_separator=False)).collect()
    assert sorted(r.chunk_id for r in got) == [f"id{i}" for i in range(1, 7)]
    numbers = {}
    for r in got:
        numbers.setdefault(r.doc_id, []).append((r.chunk_no, int(r.chunk_id[2:])))
    for of_doc in numbers.values():  # consecutive within a document
        first = min(of_doc)[1]
        assert sorted(of_doc) == [(i, first + i) for i in range(len(of_doc))]


def test_topk_with_named_vectors(spark):
    stored = spark.createDataFrame([("id2", [1.0, 0.0]), ("id1", [2.0, 0.0]), ("id3", [0.0, 1.0])],
                                   "vec_id string, embedding array<float>")
    asked = spark.createDataFrame([("id1", [1.0, 0.0])], "query_id string, embedding array<float>")
    assert rows(retrieval.topk(asked, stored, 1)) == [("id1", "id1", 1.0, 1)]
    assert rows(retrieval.topk(asked, stored, 1, skip_same_id=True)) == [("id1", "id2", 1.0, 1)]


def vectors(spark, data, key):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in data], f"{key} long, embedding array<float>")


def brute(queries, stored, k, threshold):
    out = []
    for qi, q in queries:
        scored = []
        for vi, v in stored:
            norm = np.linalg.norm(q) * np.linalg.norm(v)
            if norm and round(float(np.dot(q, v)) / norm, 6) >= threshold:
                scored.append((-round(float(np.dot(q, v)) / norm, 6), vi))
        out += [(qi, vi, -s, r) for r, (s, vi) in enumerate(sorted(scored)[:k], start=1)]
    return out


@pytest.mark.parametrize("k,threshold", [(1, -1.0), (3, 0.5), (5, 0.5)])
def test_topk_is_exact(spark, k, threshold):
    rng = random.Random(5)
    stored = [(i, [rng.randint(-2, 2) for _ in range(3)]) for i in range(120)]  # many ties, some zero vectors
    queries = [(i, [rng.randint(-2, 2) or 1 for _ in range(3)]) for i in range(7)]
    got = retrieval.topk(vectors(spark, queries, "query_id"), vectors(spark, stored, "vec_id").repartition(5), k, threshold)
    assert rows(got, "query_id", "vec_id", "score", "rank") == brute(queries, stored, k, threshold)


@pytest.mark.parametrize("question_block, vector_block, strip", [(2, 16_384, 1024), (4096, 11, 3), (3, 7, 2)])
def test_topk_in_blocks(spark, monkeypatch, question_block, vector_block, strip):
    draw = random.Random(6)
    stored = [(i, [draw.randint(-2, 2) for _ in range(4)]) for i in range(90)]
    queries = [(i, [draw.randint(-2, 2) or 1 for _ in range(4)]) for i in range(13)]
    for name, n in (("QUESTION_BLOCK", question_block), ("VECTOR_BLOCK", vector_block), ("STRIP", strip)):
        monkeypatch.setattr(retrieval, name, n)
    got = retrieval.topk(vectors(spark, queries, "query_id").repartition(3), vectors(spark, stored, "vec_id").repartition(5), 3, 0.4)
    assert rows(got, "query_id", "vec_id", "score", "rank") == brute(queries, stored, 3, 0.4)


def test_topk_of_questions_of_several_sizes(spark):
    stored = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 0.0, 0.0]), ("c", [0.0, 0.0]), (None, [1.0, 0.0]), ("d", [1.0, None]), ("e", [])],
                                   "vec_id string, embedding array<double>")
    asked = spark.createDataFrame([(1, [2.0, 0.0]), (2, [3.0, 0.0, 0.0]), (3, []), (None, [1.0, 0.0]), (4, [1.0])],
                                  "query_id long, embedding array<double>")
    assert rows(retrieval.topk(asked, stored), "query_id", "vec_id", "score") == [(1, "a", 1.0), (2, "b", 1.0)]
    assert retrieval.topk(asked, stored, 0).count() == 0


def test_topk_without_questions_or_hits(spark):
    stored = vectors(spark, [(1, [1, 0])], "vec_id")
    assert retrieval.topk(vectors(spark, [(1, [0, 1])], "query_id"), stored).count() == 0
    assert retrieval.topk(vectors(spark, [(1, [0, 1])], "query_id").limit(0), stored).count() == 0


def test_upsert_last_batch_wins(spark):
    existing = spark.createDataFrame([(1, "old"), (2, "stays")], "id long, text string")
    incoming = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (3, "new", 1)], "id long, text string, batch int")
    assert rows(retrieval.upsert(existing, incoming, "id", "batch")) == [(1, "b"), (2, "stays"), (3, "new")]


def test_context_prompt_and_replay(spark):
    hits = spark.createDataFrame([(1, 10, 0.9, 1), (1, 11, 0.8, 2)], "query_id long, vec_id long, score double, rank int")
    texts = spark.createDataFrame([(10, "first."), (11, "second.")], "vec_id long, text string")
    (row,) = retrieval.fill_prompt(retrieval.assemble_context(hits, texts)).collect()
    assert row.context == "first.second." and row.prompt == retrieval.PROMPT.format(context="first.second.")
    turns = spark.createDataFrame([(1, 2, "assistant", "c"), (1, 0, "system", "a"), (1, 1, "user", "b")],
                                  "conv_id long, turn long, role string, text string")
    assert [r.text for r in retrieval.replay(turns).collect()] == ["b", "c"]


def test_task_functions_need_no_installed_package(tmp_path):
    """Executors get the code with the task, not from their own library folder."""
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    path = tmp_path / "search.pkl"
    path.write_bytes(cloudpickle.dumps(retrieval.best_of_block))
    load = ("import pickle, sys, numpy as np; f = pickle.load(open(sys.argv[1], 'rb')); "
            "print(*f(np.array([1]), np.eye(2)[:1], np.array([5, 6]), np.eye(2), 1, 0.5, False))")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", load, str(path)], cwd="/", env=env, capture_output=True, text=True)
    assert done.stdout.strip() == "[0] [0] [1.]"


def test_upsert_keeps_ids_whose_order_is_null(spark):
    existing = spark.createDataFrame([(1, 10)], "id long, v long")
    incoming = spark.createDataFrame([(2, 20, None), (1, 11, None), (1, 12, 3), (3, 5, 1), (3, 6, 1), (None, 7, 9)],
                                     "id long, v long, o long")
    assert sorted(map(tuple, retrieval.upsert(existing, incoming, "id", "o").collect())) == [(1, 12), (2, 20), (3, 6)]


def test_threshold_meets_raw_scores_and_odd_vectors_are_left_out(spark):
    questions = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "query_id long, embedding array<double>")
    near = [0.4999997, (1 - 0.4999997 ** 2) ** 0.5]
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (2, near), (3, None), (4, [1.0])], "vec_id long, embedding array<double>")
    assert [(r.query_id, r.vec_id) for r in retrieval.topk(questions, vectors, 5, 0.5).collect()] == [(1, 1)]
