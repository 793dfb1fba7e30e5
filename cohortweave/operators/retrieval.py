"""Vector upsert, cosine top-k, and the text assembled from the hits."""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortweave.functions.text import ordered_list
from cohortweave.sources.store import cut_lineage

# The functions below travel to the executors, which need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOP_K, THRESHOLD = 3, 0.5
#: Questions and vectors of a block, and the vectors of one product.
QUESTION_BLOCK, VECTOR_BLOCK, STRIP = 4096, 16_384, 1024

# The instruction the hits are placed in.
PROMPT = """You are an assistant for question-answering tasks.
Use the following pieces of retrieved context to answer the question.
If you don't know the answer, just say that you don't know.
Use three sentences maximum and keep the answer concise.
Context: {context}:"""

# Conversation roles that are replayed.
REPLAYED_ROLES = ("user", "assistant")


def upsert(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``existing`` with those of ``incoming`` added or replaced by ``key``; of
    several incoming rows the one with the greatest ``order`` wins (null: the least; ties: the
    greatest values). Incoming rows without a key are left out. The winner is found
    by aggregation, so a key sent very often is reduced before it is shuffled."""
    columns = existing.columns
    values = F.struct(*[F.col(c) for c in columns if c != key])
    rank = F.struct(F.col(order).isNotNull(), F.col(order), values)  # a null order comes last, ties go by the values
    latest = (incoming.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(values, rank).alias("_row"))
              .select(key, "_row.*").select(*columns))
    return existing.join(latest.select(key), key, "left_anti").select(*columns).unionByName(latest)


def _unit_rows(vectors: pa.ChunkedArray) -> np.ndarray:
    """Unit rows of vectors of one size; a zero vector, or one with a null, gives a row of NaN."""
    flat = vectors.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    rows = flat.astype(np.float64).reshape(len(vectors), -1)
    with np.errstate(invalid="ignore", divide="ignore"):
        return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _ids(values: pa.ChunkedArray) -> np.ndarray:
    """Numbers stay numbers; texts become fixed-width texts, which sort and compare fast."""
    ids = values.to_numpy()
    return ids.astype(str) if ids.dtype == object else ids


def _cut(question: np.ndarray, place: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """The ``k`` best hits of each question: by score, then id."""
    order = np.lexsort((ids[place], -score, question))
    question, place, score = question[order], place[order], score[order]
    keep = np.arange(len(order)) - np.searchsorted(question, question, side="left") < k
    return question[keep], place[keep], score[keep]


def best_of_block(question_ids: np.ndarray, questions: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                  k: int, threshold: float, skip_same_id: bool):
    """(question, vector, score) places of the ``k`` best vectors of a block for each question, not below
    ``threshold``. Both inputs have unit rows; what scores NaN never passes. The product is taken
    ``STRIP`` vectors at a time, the best so far merged with the strip's."""
    best = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    for at in range(0, len(ids), STRIP):
        here = ids[at:at + STRIP]
        raw = vectors[at:at + STRIP] @ questions.T
        scores = np.where(raw >= threshold, np.round(raw, 6), np.nan)
        if skip_same_id:
            scores[here[:, None] == question_ids[None, :]] = np.nan
        floor = np.full(scores.shape[1], -2.0)
        if len(here) > k:  # only scores that reach the strip's k-th can be among the best
            floor = np.maximum(floor, np.partition(np.nan_to_num(scores, nan=-2.0), len(here) - k, axis=0)[len(here) - k])
        vector, question = np.nonzero(scores >= floor)
        found = question, vector + at, scores[vector, question]
        best = _cut(*(np.concatenate(pair) for pair in zip(best, found)), ids, k)
    return best


def _search(k: int, threshold: float, skip_same_id: bool):
    """All pairs of a block of questions and a block of vectors, as one product."""
    def run(asked: pa.Table, stored: pa.Table) -> pa.Table:
        kinds = [asked.schema.field("query_id").type, stored.schema.field("vec_id").type, pa.float64()]
        schema = pa.schema(list(zip(("query_id", "vec_id", "score"), kinds)))
        if k < 1 or not asked.num_rows or not stored.num_rows:
            return schema.empty_table()
        question, vector, score = best_of_block(
            _ids(asked.column("query_id")), _unit_rows(asked.column("embedding")),
            _ids(stored.column("vec_id")), _unit_rows(stored.column("embedding")), k, threshold, skip_same_id)
        return pa.Table.from_arrays([asked.column("query_id").take(pa.array(question)),
                                     stored.column("vec_id").take(pa.array(vector)), pa.array(score)], schema=schema)

    return run


def topk(queries: DataFrame, vectors: DataFrame, k: int = TOP_K, threshold: float = THRESHOLD,
         skip_same_id: bool = False) -> DataFrame:
    """Exact thresholded cosine top-k: (query_id, vec_id, score, rank).

    Any number of questions ``queries(query_id, embedding)`` against all of ``vectors(vec_id, embedding)``; ids are
    numbers or texts, one row each. Questions are staged once and dealt into blocks of about ``QUESTION_BLOCK``,
    vectors into blocks of about ``VECTOR_BLOCK``, both by hash; each pair of blocks is one bounded group with
    one matrix product, which hands on at most ``k`` rows a question; the rank filter cuts those to ``k``
    per task before its shuffle. Nothing is collected, each input is read once for its rows (and counted once), and vectors
    move as many times as there are question blocks (once for up to ``QUESTION_BLOCK`` questions).

    Scores meet the threshold as they are and are ranked rounded to six places, ties by id. Rows without a vector or
    an id are left out; questions meet vectors of their own size only; a vector that is zero or holds a null is no hit.
    """
    asked = cut_lineage(queries.where("embedding IS NOT NULL AND query_id IS NOT NULL").select("query_id", "embedding"))
    stored = vectors.where("embedding IS NOT NULL AND vec_id IS NOT NULL").select("vec_id", "embedding")
    question_blocks = max(1, math.ceil(asked.count() / QUESTION_BLOCK))
    vector_blocks = max(1, math.ceil(stored.count() / VECTOR_BLOCK))
    pair = ["size", "question_block", "vector_block"]

    def dealt(df: DataFrame, key: str, own: str, blocks: int, other: str, copies: int) -> DataFrame:
        return df.where(F.size("embedding") > 0).select(
            key, "embedding", F.size("embedding").alias("size"), F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias(other)).groupBy(*pair)

    kind = {c: df.schema[c].dataType.simpleString() for df, c in ((asked, "query_id"), (stored, "vec_id"))}
    hits = dealt(asked, "query_id", "question_block", question_blocks, "vector_block", vector_blocks).cogroup(
        dealt(stored, "vec_id", "vector_block", vector_blocks, "question_block", question_blocks)).applyInArrow(
        _search(k, threshold, skip_same_id), f"query_id {kind['query_id']}, vec_id {kind['vec_id']}, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def assemble_context(hits: DataFrame, texts: DataFrame) -> DataFrame:
    """Per question, the hits' texts, best first, with nothing between them."""
    return hits.join(texts.select("vec_id", "text"), "vec_id").groupBy("query_id").agg(
        ordered_list("text", "rank", sep="").alias("context"))


def fill_prompt(contexts: DataFrame) -> DataFrame:
    before, after = PROMPT.split("{context}")
    return contexts.withColumn("prompt", F.concat(
        F.lit(before), F.coalesce("context", F.lit("")), F.lit(after)))


def replay(conversations: DataFrame) -> DataFrame:
    """The turns to show again: user and assistant only, in order."""
    return conversations.where(F.col("role").isin(*REPLAYED_ROLES)).orderBy("conv_id", "turn")
