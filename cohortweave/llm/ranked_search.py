"""Ranked lexical search of all documents for many items, by pipelined term partitioning.

1. One scan of the texts makes an inverted index by *buckets* of at most ``BUCKET`` documents of a task: a row for each
   (bucket, term) with the packed places and counts of the term, and one row with the bucket's documents. Only terms whose hash
   is among the items' (a bitmap of ``BITS`` bits, whatever the number of items) are indexed.
2. Items are dealt into blocks of about ``ITEMS``. A *bundle* is a block of items before a bucket of documents; it
   carries sparse accumulators (item, document, score).
3. The terms have ``OWNERS`` owners by weight, heaviest first. Bundles go through them stage by stage: a cogroup of the
   bundles with the postings of the stage's terms adds their integer contributions. Rare terms come first, so
   accumulators stay few until the last stage, which hands on only the best of each item in each bucket.
4. The best of all buckets are the answer.

A bundle holds at most a block of items before a bucket of documents, however common a term is; no group grows with the corpus.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import binary, record_batch, staged, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BEST = 10
OWNERS = 4
#: Documents and bytes of text of a bucket, at most (a longer text is a bucket of its own).
BUCKET = 2048
BUCKET_BYTES = 8_000_000
ITEMS = 128
BITS = 1 << 20

#: Byte by byte: letters lower-cased, digits and bytes beyond ASCII kept, the rest a space.
CLEAN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms_of(text: bytes | None) -> Counter[bytes]:
    return Counter((text or b"").translate(CLEAN).split())


def slot(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) & (BITS - 1)


def item_terms(kind: str):
    """(item_id, text) to (item_id, term, times, slot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(t) for t in binary(batch.column(1))]
            rows = np.repeat(np.arange(len(found)), [len(c) for c in found])
            schema = pa.schema([pa.field("item_id", batch.schema.field(0).type), ("term", pa.string()), ("times", pa.int64()), ("slot", pa.int64())])
            yield record_batch(schema, (batch.column(0).take(pa.array(rows)), [t.decode() for c in found for t in c],
                                        [n for c in found for n in c.values()], [slot(t) for c in found for t in c]))

    return run


INDEX = pa.schema([("bucket", pa.int64()), ("term", pa.string()), ("slots", pa.binary()), ("counts", pa.binary()), ("held", pa.int64()),
                   ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("words", pa.int64())])
INDEX_DDL = ("bucket long, term string, slots binary, counts binary, held long, doc_ids array<long>, "
             "sizes array<long>, words long")


def index(bitmap: bytes):
    """(doc_id, text) to the rows of the inverted index. Documents without a term take no place in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(bitmap, np.uint8)).view(bool)
        number = TaskContext.get().partitionId() << 33
        ids, sizes, postings, held = [], [], {}, 0
        asked: dict[bytes, bool] = {}

        def rows():
            terms = list(postings)
            yield record_batch(INDEX, (
                [number] * (len(terms) + 1), [None, *(t.decode() for t in terms)],
                [None, *(np.array(postings[t][0], "<u2").tobytes() for t in terms)],
                [None, *(np.array(postings[t][1], "<u4").tobytes() for t in terms)],
                [len(ids), *(len(postings[t][0]) for t in terms)],
                [ids, *[None] * len(terms)], [sizes, *[None] * len(terms)], [sum(sizes), *[None] * len(terms)]))

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                found = terms_of(text)
                if not found:
                    continue
                if ids and (len(ids) == BUCKET or held + len(text) > BUCKET_BYTES):
                    yield from rows()
                    number += 1
                    ids, sizes, postings, held = [], [], {}, 0
                place = len(ids)
                for term, n in found.items():
                    known = asked.get(term)
                    if known is None:
                        known = bool(wanted[slot(term)])
                        if len(asked) < 200_000:  # what was asked is remembered, within bounds
                            asked[term] = known
                    if known:
                        at = postings.setdefault(term, ([], []))
                        at[0].append(place)
                        at[1].append(n)
                ids.append(doc_id)
                sizes.append(found.total())
                held += len(text)
        if ids:
            yield from rows()

    return run


BUNDLE = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
                    ("items", pa.binary()), ("places", pa.binary()), ("scores", pa.binary())])
BUNDLE_DDL = "block long, bucket long, doc_ids array<long>, sizes array<long>, items binary, places binary, scores binary"
HITS = pa.schema([("block", pa.int64()), ("item", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def add(bundle: pa.Table, postings: pa.Table, documents: int, words: int) -> np.ndarray:
    """The bundle's accumulators, items by documents, with the contributions of the postings added."""
    sizes = bundle.column("sizes")[0].as_py()
    before = [np.frombuffer(bundle.column(c)[0].as_py() or b"", k) for c, k in (("items", "<u2"), ("places", "<u2"), ("scores", "<i8"))]
    wants = postings.column("wants").to_pylist()
    most = max([int(before[0].max(initial=0)), *(x["item"] for w in wants for x in w)]) + 1
    score = np.zeros((most, len(sizes)), np.int64)
    score[before[0], before[1]] = before[2]
    length = np.array([25 + (75 * n * documents) // words for n in sizes], np.int64)
    for weight, want, places, counts in zip(postings.column("weight").to_pylist(), wants,
                                            postings.column("slots").to_pylist(), postings.column("counts").to_pylist()):
        at = np.frombuffer(places, "<u2")
        tf = np.frombuffer(counts, "<u4").astype(np.int64)
        gain = weight * (1_000_000_000 * tf // (1000 * tf + 8 * length[at]))
        for x in want:
            score[x["item"], at] += x["times"] * gain
    return score


def pass_on(documents: int, words: int):
    """A stage: bundles with the contributions of this owner's terms."""
    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if not bundle.num_rows or not postings.num_rows:
            return bundle.select(BUNDLE.names)
        score = add(bundle, postings, documents, words)
        item, place = np.nonzero(score)
        packed = (item.astype("<u2").tobytes(), place.astype("<u2").tobytes(), score[item, place].astype("<i8").tobytes())
        return pa.Table.from_arrays([*(bundle.column(c) for c in BUNDLE.names[:4]), *(pa.array([x], pa.binary()) for x in packed)], schema=BUNDLE)

    return run


def select_best(documents: int, words: int, best: int):
    """The last stage: the best of each item in this bucket."""
    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        out = []
        if bundle.num_rows:
            score = add(bundle, postings, documents, words)
            ids = bundle.column("doc_ids")[0].as_py()
            for item, row in enumerate(score):
                some = np.flatnonzero(row > 0)
                if len(some) > best:
                    some = some[row[some] >= np.partition(row[some], -best)[-best]]
                ranked = sorted(((-int(row[p]), ids[p] is None, ids[p] or 0, ids[p]) for p in some.tolist()))[:best]
                out += [(bundle.column("block")[0].as_py(), item, r[3], -r[0]) for r in ranked]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * 4)], schema=HITS)

    return run


def search(docs: DataFrame, items: DataFrame, best: int = BEST) -> DataFrame:
    """item_id, rank, doc_id, score: the ``best`` documents of highest score for each item of ``items`` (item_id, text).

    Terms are runs of ASCII letters and digits and of all code points beyond ASCII, A-Z lower-cased. Each row of ``docs`` (doc_id,
    text) with a term is a document of its own, repeated rows too; null and empty texts are none. Rows of ``items`` with one
    item_id (null included) are one item with the terms of its different texts. Equal scores rank by doc_id (null last).
    Items without a scoring document have no rows; other columns are not used.
    """
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType.simpleString()
    asked = staged(items.select("item_id", F.col("text").cast("string")).distinct()
                   .mapInArrow(item_terms(kind), f"item_id {kind}, term string, times long, slot long")
                   .groupBy("item_id", "term").agg(F.sum("times").alias("times"), F.first("slot").alias("slot")))
    bitmap = np.zeros(BITS, bool)
    bitmap[asked.select("slot").distinct().toArrow().column(0).to_numpy()] = True  # BITS rows at most
    indexed = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                     .mapInArrow(index(np.packbits(bitmap).tobytes()), INDEX_DDL))
    buckets, postings = indexed.filter("term IS NULL"), indexed.filter("term IS NOT NULL")
    documents, words = (x or 0 for x in buckets.agg(F.sum("held"), F.sum("words")).first())
    n_items = asked.select("item_id").distinct().count()
    if not documents or not n_items:
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")

    blocks = -(-n_items // ITEMS)
    numbered = staged(asked.select("item_id").distinct().withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
                      .withColumn("item", F.row_number().over(Window.partitionBy("block").orderBy("item_id")) - 1))
    weights = (postings.groupBy("term").agg(F.sum("held").alias("df"))
               .withColumn("weight", F.floor(1000 * F.log((2.0 * documents + 2) / (2 * F.col("df") + 1)))).filter("weight > 0"))
    heaviest = max(1, int(1000 * np.log((2 * documents + 2) / 3)))
    owner = F.greatest(F.lit(0), OWNERS - 1 - F.floor(F.col("weight") * OWNERS / (heaviest + 1)))
    wants = staged(asked.alias("a").join(numbered.alias("n"), F.col("a.item_id").eqNullSafe(F.col("n.item_id")))
                   .groupBy("term", "block").agg(F.collect_list(F.struct("item", "times")).alias("wants"))
                   .join(weights, "term").select("term", "block", "weight", owner.alias("owner"), "wants"))

    empty = F.lit(None).cast("binary")
    bundles = buckets.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"), "bucket", "doc_ids", "sizes",
                             empty.alias("items"), empty.alias("places"), empty.alias("scores"))
    for stage in range(OWNERS):
        owned = (postings.select("bucket", "term", "slots", "counts").join(wants.filter(F.col("owner") == stage), "term")
                 .select("block", F.col("bucket").alias("before"), "weight", "wants", "slots", "counts"))
        met = bundles.groupBy("block", "bucket").cogroup(owned.groupBy("block", "before"))
        if stage < OWNERS - 1:
            bundles = met.applyInArrow(pass_on(documents, words), BUNDLE_DDL)
    hits = met.applyInArrow(select_best(documents, words, best), "block long, item long, doc_id long, score long")
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(numbered, ["block", "item"]).select("item_id", "rank", "doc_id", "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op11_ranked_search": op11_ranked_search}

ORACLE_SQL = {"op11_ranked_search": r"""
WITH doc_terms AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
item_terms AS (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark),
tf AS (SELECT doc_id, term, count(*) AS tf FROM doc_terms GROUP BY doc_id, term),
size AS (SELECT doc_id, count(*) AS n FROM doc_terms GROUP BY doc_id),
total AS (SELECT count(*) AS N_docs, CAST(sum(n) AS BIGINT) AS L FROM size),
length AS (SELECT doc_id, 25 + (75 * n * N_docs) // L AS m FROM size, total),
weight AS (SELECT term, CAST(floor(1000 * ln((2.0 * N_docs + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
           FROM tf, total GROUP BY term, N_docs),
asked AS (SELECT item_id, term, count(*) AS times FROM item_terms GROUP BY item_id, term),
scored AS (
    SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN weight USING (term) JOIN tf USING (term) JOIN length USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
    FROM scored WHERE score > 0)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 10
"""}
