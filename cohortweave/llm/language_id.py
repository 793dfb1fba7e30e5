"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams per (language, bucket) in each task and sums them in Spark; the driver turns the
languages x buckets matrix, whose size does not depend on the number of texts, into
log probabilities and broadcasts it. Scoring looks the matrix up in numpy for slices of texts.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import record_batch, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIZES = (2, 3)
BUCKET_BITS = 14
SMOOTHING = 0.5
#: The most languages that one matrix takes (with 2^14 buckets, 64 MB); more raise an error.
MOST_LANGUAGES = 1000
#: Code points handled at a time.
CHUNK = 1_000_000
UNKNOWN = "und"

LETTER = regex.compile(r"\p{L}")


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points with every ASCII non-letter as a space."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    ascii_other = (points < 128) & ~((points >= 97) & (points <= 122))
    return np.where(ascii_other, 32, points).astype(np.uint64)


def buckets(points: np.ndarray, size: int) -> np.ndarray:
    """A bucket for each n-gram; those that hold a separator (0) or only spaces get the last, unused one."""
    n = len(points) - size + 1
    if n <= 0:
        return np.empty(0, np.int64)
    h = np.full(n, np.uint64(size))
    void = np.zeros(n, bool)
    blank = np.ones(n, bool)
    for j in range(size):
        p = points[j:j + n]
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        void |= p == 0
        blank &= p == 32
    out = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    out[void | blank] = 1 << BUCKET_BITS
    return out


def chunks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, where each begins, bucket of each n-gram) for pieces of about CHUNK code points;
    a longer text comes in several pieces that overlap by what n-grams need."""
    held: list[np.ndarray] = []
    own: list[int] = []
    size = 0
    zero = np.zeros(1, np.uint64)

    def out():
        begins = np.concatenate([[0], np.cumsum([len(h) for h in held])])[:-1]
        points = np.concatenate(held)
        for n in SIZES:
            found = buckets(points, n)
            inside = begins < len(found)
            yield np.array(own)[inside], begins[inside], found

    for i, text in enumerate(texts):
        points = code_points(text)
        for a in range(0, max(len(points), 1), CHUNK):
            piece = points[a:a + CHUNK + max(SIZES) - 1]
            if a and len(piece) < max(SIZES):
                continue
            held.append(np.concatenate([piece, zero]))
            own.append(i)
            size += len(piece)
            if size >= CHUNK:
                yield from out()
                held, own, size = [], [], 0
    if held:
        yield from out()


COUNTS = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])


def count_ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = (c.to_pylist() for c in batch.columns)
        for own, begins, found in chunks(texts):
            ends = np.concatenate([begins[1:], [len(found)]])
            for i, a, b in zip(own.tolist(), begins.tolist(), ends.tolist()):
                held = totals.setdefault(langs[i], np.zeros((1 << BUCKET_BITS) + 1, np.int64))
                held += np.bincount(found[a:b], minlength=len(held))
    for lang, held in totals.items():
        used = np.flatnonzero(held[:-1])
        yield record_batch(COUNTS, ([lang] * len(used), used, held[used]))


def remainder(column: str = "doc_id", by: int = 4) -> Column:
    """crc32 of the id as text (null: of the empty text), modulo ``by``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % by


def train(texts: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in order and log probabilities (language, bucket) from the rows of ``texts`` (lang, text) where neither is
    null. The last column is the log prior of the language: its share of these rows."""
    rows = texts.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    n_rows = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    langs = sorted(n_rows)
    if len(langs) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    counts = np.zeros((len(langs), 1 << BUCKET_BITS))
    at = {lang: i for i, lang in enumerate(langs)}
    summed = (rows.mapInArrow(count_ngrams, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    for r in summed.toLocalIterator():  # at most languages x buckets rows
        counts[at[r["lang"]], r["bucket"]] = r["n"]
    smooth = counts + SMOOTHING
    logs = np.log(smooth / smooth.sum(axis=1, keepdims=True)) if langs else counts
    prior = np.log(np.array([n_rows[lang] for lang in langs], np.float64)) - np.log(max(1, sum(n_rows.values())))
    return langs, np.hstack([logs, prior[:, None]])


PREDICTED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])


def predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, learned = shared.value
        logs, prior = learned.astype(np.float32), learned[:, -1]
        logs[:, -1] = 0  # the bucket of n-grams that are none
        for batch in batches:
            texts = batch.column(2).to_pylist()
            total = np.repeat(prior[:, None], len(texts), axis=1)
            for own, begins, found in chunks([t or "" for t in texts]):
                if not len(begins):
                    continue
                for k in range(len(langs)):
                    np.add.at(total[k], own, np.add.reduceat(logs[k][found], begins, dtype=np.float64))
            names, scores = [], []
            for i, text in enumerate(texts):
                if not langs or not text or not LETTER.search(text):
                    names.append(UNKNOWN), scores.append(0.0)
                    continue
                best = int(total[:, i].argmax())
                names.append(langs[best])
                scores.append(float(1 / np.exp(total[:, i] - total[best, i]).sum()))
            yield record_batch(PREDICTED, (batch.column(0), batch.column(1), names, scores))

    return run


def identify(docs: DataFrame, learn_from: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score (posterior of the language, 0 to 1) per row of ``docs``.

    Learns from ``learn_from`` (lang, text). A text that is null or has no letter gets ``und``
    with score 0, as do all if there is nothing to learn from; ties go to the first language by name. Repeated rows count
    each; no rows give no rows; other columns are not used.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(learn_from))
    return (docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), F.col("text").cast("string"))
            .mapInArrow(predict(shared), "doc_id long, held_out boolean, lang_pred string, score double"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder() == 2
    return identify(docs, docs.filter(~held_out), held_out)


QUERIES = {"op8_language_id": op8_language_id}
ORACLE_SQL: dict[str, str] = {}
