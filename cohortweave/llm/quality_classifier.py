"""Quality classification by co-training a text view and a page-metadata view.

The *text view* sees byte trigrams of the whole text, hashed into buckets (square roots of their shares); the
*metadata view* sees language and source (hashed), size, number of lines and their mean length. Each view is a ridge
logistic regression. In each of a few rounds both views score *all* unlabelled documents in Spark; the ``HANDED`` they are
surest of, per class, after calibration on labelled rows kept aside, are handed to the *other* view with that label. At last
both are calibrated and combined, and every document is scored whole.

Only the labelled rows are a bounded sample, of at most ``LABELLED`` (a parameter): those of the smallest hash of doc_id. What a round
hands on is bounded by the method's own parameter; candidates for it are all rows of all documents.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import binary, mix, record_batch, slices, staged, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LABELLED = 6000
ROUNDS = 4
#: What a view hands on in a round, per class, and how sure it must be.
HANDED = 250
SURE = 0.95
TEXT_BUCKETS = 512
META_BUCKETS = 64
RIDGE = 1e-3


def text_features(texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), TEXT_BUCKETS), np.float32)
    for lo, hi in slices(texts, 1_000_000):
        some = [i for i in range(lo, hi) if len(texts[i]) >= 3]
        if not some:
            continue
        flat = np.frombuffer(b"".join(texts[i] for i in some), np.uint8).astype(np.uint32)
        key = (flat[:-2] << np.uint32(16)) | (flat[1:-1] << np.uint32(8)) | flat[2:]
        bucket = ((key * np.uint32(0x9E3779B1)) >> np.uint32(32 - 9)).astype(np.int64)
        begin = 0
        for i in some:
            n = len(texts[i])
            out[i] = np.bincount(bucket[begin:begin + n - 2], minlength=TEXT_BUCKETS)
            begin += n
    return np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))


def meta_features(langs: list[str | None], sources: list[str | None], texts: list[bytes]) -> np.ndarray:
    out = np.zeros((len(texts), META_BUCKETS + 3), np.float32)
    half = META_BUCKETS // 2
    for i, (lang, source, text) in enumerate(zip(langs, sources, texts)):
        out[i, xxhash.xxh3_64_intdigest((lang or "").encode()) % half] = 1
        out[i, half + xxhash.xxh3_64_intdigest((source or "").encode()) % half] = 1
        lines = text.count(b"\n") + 1
        out[i, META_BUCKETS:] = np.log1p(len(text)) / 10, np.log1p(lines) / 5, np.log1p(len(text) / lines) / 10
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, balanced: bool = False, ridge: float = RIDGE, steps: int = 12) -> np.ndarray:
    """Weights, the intercept last, by Newton steps; ``balanced``: both classes weigh alike."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    share = (y.mean(), 1 - y.mean()) if balanced else (0.5, 0.5)
    w = np.where(y == 1, 0.5 / share[0], 0.5 / share[1]) / len(y)
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-9
    for _ in range(steps):
        p = sigmoid(x @ beta)
        gradient = x.T @ (w * (p - y)) + penalty * beta
        hessian = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-6:
            break
    return beta


def logits(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return x @ beta[:-1] + beta[-1]


@dataclass
class Model:
    """Weights of both views, the calibration of each, and that of both together."""

    text: np.ndarray
    meta: np.ndarray
    calibrations: list[np.ndarray] = field(default_factory=list)

    def score(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, b = logits(text, self.text), logits(meta, self.meta)
        own = [sigmoid(logits(z[:, None], c)) for z, c in zip((a, b), self.calibrations)]
        return own[0], own[1], sigmoid(logits(np.stack([a, b], axis=1), self.calibrations[2]))


#: (view, class) to the features (text, meta) of the documents that the view is surest of.
Handed = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def co_train(text: np.ndarray, meta: np.ndarray, label: np.ndarray,
             surest: Callable[[list[np.ndarray], list[np.ndarray]], Handed], rounds: int = ROUNDS) -> Model | None:
    """Fit on labelled rows (``label`` 0 or 1) and on what ``surest`` hands on, given both views' weights and calibrations.
    Every third labelled row calibrates, the others train. None unless both classes are on both sides."""
    known = np.arange(len(label))
    aside, base = known[2::3], np.setdiff1d(known, known[2::3])
    if any(len(np.unique(label[part])) < 2 for part in (aside, base)):
        return None
    views = (text, meta)
    own = [(x[base], label[base]) for x in views]
    for turn in range(rounds + 1):
        betas = [fit_logistic(x, y, balanced=True) for x, y in own]
        calibrations = [fit_logistic(logits(x[aside], b)[:, None], label[aside]) for x, b in zip(views, betas)]
        if turn == rounds:
            break
        handed = surest(betas, calibrations)
        for (view, kind), features_ in sorted(handed.items()):
            x, y = own[1 - view]
            added = features_[1 - view]
            own[1 - view] = np.concatenate([x, added]), np.concatenate([y, np.full(len(added), kind)])
        if not any(len(x) for x, _ in handed.values()):
            break
    both = np.stack([logits(x[aside], b) for x, b in zip(views, betas)], axis=1)
    return Model(*betas, [*calibrations, fit_logistic(both, label[aside])])


FEATURES = pa.schema([("id", pa.int64()), ("label", pa.int64()), ("text_view", pa.list_(pa.float32())), ("meta_view", pa.list_(pa.float32()))])


def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, text, lang, source) to both views' features."""
    for batch in batches:
        texts = [t or b"" for t in binary(batch.column(2))]
        text = text_features(texts)
        meta = meta_features(batch.column(3).to_pylist(), batch.column(4).to_pylist(), texts)
        yield record_batch(FEATURES, (batch.column(0), batch.column(1), list(text), list(meta)))


SURE_ROWS = pa.schema([("id", pa.int64()), ("view", pa.int32()), ("label", pa.int64()), ("sure", pa.float64())])


def sure_rows(betas: list[np.ndarray], calibrations: list[np.ndarray], taken: set[int], handed: int, least: float):
    """(id, text, lang, source) to the rows each view is surest of, per class: at most ``handed`` a batch and kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            texts = [t or b"" for t in binary(batch.column(1))]
            views = text_features(texts), meta_features(batch.column(2).to_pylist(), batch.column(3).to_pylist(), texts)
            free = np.array([i not in taken for i in ids.tolist()], bool)
            for view, (x, beta, own) in enumerate(zip(views, betas, calibrations)):
                good = sigmoid(logits(logits(x, beta)[:, None], own))
                for label, sure in ((1, good), (0, 1 - good)):
                    some = np.flatnonzero(free & (sure >= least))
                    some = some[np.argsort(-sure[some], kind="stable")]
                    if len(some) > handed:  # ties at the end are decided over all batches
                        some = some[sure[some] >= sure[some[handed - 1]]]
                    yield record_batch(SURE_ROWS, (ids[some], np.full(len(some), view), np.full(len(some), label), sure[some]))

    return run


SCORED = pa.schema([("doc_id", pa.int64()), ("text_score", pa.float64()), ("meta_score", pa.float64()),
                    ("score", pa.float64()), ("quality", pa.int32())])
SCORED_DDL = "doc_id long, text_score double, meta_score double, score double, quality int"


def score_all(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value) if shared.value else None
        for batch in batches:
            texts = [t or b"" for t in binary(batch.column(1))]
            if model is None:
                own = other = both = np.full(len(texts), 0.5)
            else:
                own, other, both = model.score(text_features(texts), meta_features(
                    batch.column(2).to_pylist(), batch.column(3).to_pylist(), texts))
            yield record_batch(SCORED, (batch.column(0), own, other, both, (both >= 0.5).astype(np.int32)))

    return run


def _typed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), *[F.col(c).cast("string") for c in ("text", "lang", "source")])


def rows_of(docs: DataFrame, wanted: DataFrame) -> tuple[np.ndarray, ...]:
    """id, label and both views' features of the documents in ``wanted`` (id, label; few), in the order of the ids' hash. Of rows
    that share an id, one (of the smallest hash) stands for it, chosen before anything is collected."""
    one = (_typed(docs).join(F.broadcast(wanted), "id").groupBy("id", "label")
           .agg(F.min_by(F.struct("text", "lang", "source"), F.struct(F.xxhash64("text"), F.xxhash64("lang", "source"))).alias("row")))
    got = (one.select("id", "label", "row.*").mapInArrow(features, "id long, label long, text_view array<float>, meta_view array<float>").toArrow())

    def matrix(name: str, width: int) -> np.ndarray:
        return got[name].combine_chunks().flatten().to_numpy().reshape(-1, width)

    ids = got["id"].to_numpy()
    order = np.argsort(mix(ids.view(np.uint64)), kind="stable")  # the same fit whatever the order of tasks
    return ids[order], got["label"].to_numpy()[order], matrix("text_view", TEXT_BUCKETS)[order], matrix("meta_view", META_BUCKETS + 3)[order]


def labelled_ids(labels: DataFrame) -> DataFrame:
    """(id, label); a document labelled twice counts as good if one label says so."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("quality").cast("long").alias("label")))


def fit(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, handed: int = HANDED, least: float = SURE,
        rounds: int = ROUNDS) -> Model | None:
    spark, known = docs.sparkSession, staged(labelled_ids(labels))
    _, label, text, meta = rows_of(docs, known.orderBy(F.xxhash64("id"), "id").limit(labelled))
    unlabelled = _typed(docs).filter(F.col("id").isNotNull()).join(known.select("id"), "id", "left_anti")
    taken: set[int] = set()  # at most rounds x 4 x handed ids

    def surest(betas: list[np.ndarray], calibrations: list[np.ndarray]) -> Handed:
        order = Window.partitionBy("view", "label").orderBy(F.desc("sure"), F.xxhash64("id"), "id")
        found = (unlabelled.mapInArrow(sure_rows(betas, calibrations, set(taken), handed, least), "id long, view int, label long, sure double")
                 .groupBy("id", "view", "label").agg(F.max("sure").alias("sure"))
                 .withColumn("place", F.row_number().over(order)).filter(F.col("place") <= handed).collect())
        taken.update(r["id"] for r in found)
        wanted = spark.createDataFrame([(i, 0) for i in sorted({r["id"] for r in found})], "id long, label long")
        ids, _, *views = rows_of(docs, wanted)
        at = {i: k for k, i in enumerate(ids.tolist())}
        out: Handed = {}
        for kind in ((v, c) for v in (0, 1) for c in (0, 1)):
            rows = sorted(at[r["id"]] for r in found if (r["view"], r["label"]) == kind)
            out[kind] = views[0][rows], views[1][rows]
        return out

    return co_train(text, meta, label, surest, rounds)


def classify(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """doc_id, text_score, meta_score, score (calibrated, 0 to 1), quality (1 from 0.5 on) per row of ``docs``
    (doc_id, text, lang, source), fitted on ``labels`` (doc_id, quality).

    Null texts are empty, null metadata are the empty string. Rows with a null id are scored, but no view learns from them; of
    rows that share an id one is learnt from. Without labels of both classes every score is 0.5; no rows give no rows; other
    columns are not used.
    """
    model = fit(docs, labels, labelled)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else (model.text, model.meta, model.calibrations))
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"),
                        F.col("source").cast("string")).mapInArrow(score_all(shared), SCORED_DDL))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op6_quality_classifier": op6_quality_classifier}
ORACLE_SQL: dict[str, str] = {}
