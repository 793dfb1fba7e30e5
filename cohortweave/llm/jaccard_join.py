"""Similarity self-join of texts on word n-grams: MinHash banding, verified on full n-gram sets.

1. Each text becomes its set of hashed five-word shingles, and MinHash bands whose number and rows are
   chosen for the recall asked for. Texts with one set are one *content*; work goes on with contents.
2. Contents are shuffled on band hashes; a bucket with two contents or more links its members to the
   smallest one, its *hub*. What shares a bucket shares a hub.
3. The contents of a hub get their full sets from the texts and are verified in blocks: a large hub is dealt into
   blocks by hash, and each pair of blocks is one group of bounded size. A group counts links with one sparse
   incidence product and gives its members' link counts and one link to a root each, never pairs.
   A pair that shares several hubs counts at the smallest.
4. Classes are the connected components of the verified links.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import TEXT_ROWS, binary, mix, record_batch, slices, staged, table
from cohortweave.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
ROWS = 5
#: Contents and shingles of one block, about.
BLOCK_CONTENTS = 500
BLOCK_SHINGLES = 600_000


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` rows that a pair at the threshold meets in with probability ``recall``."""
    bands, missed = 1, 1 - threshold ** rows
    while missed ** bands > 1 - recall:
        bands += 1
    return bands


def shingles(words: list[bytes], gram: int = GRAM) -> np.ndarray:
    """The sorted set of hashed shingles; fewer words than ``gram``, but some, are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < gram:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words))], np.uint64)
    name = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - gram + 1
    out = np.zeros(n, np.uint64)
    for j in range(gram):
        out = out * np.uint64(0x5851F42D4C957F2D) + name[j:j + n]
    return np.unique(mix(out))


SIGNED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("content", pa.binary()),
                    ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])
SIGNED_DDL = "doc_id long, row long, content binary, size long, bands array<long>"


def sign(bands: int, rows: int):
    """(doc_id, row, text) to the content's digest and its band hashes."""
    draw = np.random.default_rng(20)
    factors = draw.integers(1, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in binary(batch.column(2))]
            for lo, hi in slices(texts, 1_000_000):
                sets = [shingles(t.split()) for t in texts[lo:hi]]
                some = [i for i, s in enumerate(sets) if len(s)]
                keys: list[list[int] | None] = [None] * len(sets)
                if some:
                    flat = np.concatenate([sets[i] for i in some])
                    begins = np.concatenate([[0], np.cumsum([len(sets[i]) for i in some])])[:-1]
                    band = np.zeros((bands, len(some)), np.uint64)
                    for k, f in enumerate(factors):
                        least = np.minimum.reduceat(flat * f, begins)
                        b = k // rows
                        band[b] = mix(band[b] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(b + 1))
                    for i, column in zip(some, band.T.view(np.int64)):
                        keys[i] = column.tolist()
                yield record_batch(SIGNED, (
                    batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo),
                    [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
                    [len(s) for s in sets], keys))

    return run


MEMBERS = pa.schema([("node", pa.int64()), ("copies", pa.int64()), ("grams", pa.binary()),
                     ("hubs", pa.list_(pa.int64())), ("blocks", pa.list_(pa.int64()))])
MEMBERS_DDL = "node long, copies long, grams binary, hubs array<long>, blocks array<long>"


def full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, node, copies, hubs, blocks) to members with their whole shingle sets."""
    for batch in batches:
        node, copies, hubs, blocks = batch.columns[1:]
        texts = [t or b"" for t in binary(batch.column(0))]
        for lo, hi in slices(texts, 2_000_000):
            n = hi - lo
            yield record_batch(MEMBERS, (node.slice(lo, n), copies.slice(lo, n), [shingles(t.split()).tobytes() for t in texts[lo:hi]],
                                         hubs.slice(lo, n), blocks.slice(lo, n)))


def common_grams(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share (the diagonal is not used)."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([[True], flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    held = np.bincount(column)
    shared = held[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1] if shared.any() else column[:0]
    out = np.zeros((len(sets), len(sets)), np.float32)
    width = max(1, 1_000_000 // len(sets))
    for a in range(0, int(column.max()) + 1 if len(column) else 0, width):
        inside = (column >= a) & (column < a + width)
        part = np.zeros((len(sets), min(width, int(column.max()) + 1 - a)), np.float32)
        part[owner[inside], column[inside] - a] = 1
        out += part @ part.T
    return out


def verify(hub: int, side: list[int], node: list[int], copies: list[int], grams: list[bytes], hubs: list[list[int]],
           threshold: float) -> list[tuple[int, int, int]]:
    """(node, links counted by copies, root) of the members with a link. ``side``: 0 and 1 in a pair of
    different blocks, where only pairs across count; 2 in one block."""
    m = len(node)
    if m < 2:
        return []
    t = Fraction(threshold).limit_denominator(1000)
    sets = [np.frombuffer(g, np.uint64) for g in grams]
    size = np.array([len(s) for s in sets], np.float64)
    same = common_grams(sets).astype(np.float64)
    linked = same * (t.numerator + t.denominator) >= t.numerator * (size[:, None] + size[None, :])
    np.fill_diagonal(linked, False)
    s = np.array(side)
    linked &= (s[:, None] != s[None, :]) | (s[:, None] == 2)
    smaller = sorted({h for hs in hubs for h in hs if h < hub})
    if smaller and linked.any():
        at = {h: i for i, h in enumerate(smaller)}
        has = np.zeros((m, len(smaller)), np.float32)
        for i, hs in enumerate(hubs):
            for h in hs:
                if h < hub:
                    has[i, at[h]] = 1
        linked &= (has @ has.T) == 0
    if not linked.any():
        return []
    weight = np.array(copies, np.float64)
    links = (linked @ weight).astype(np.int64)
    root = np.arange(m)
    while True:  # the smallest index reachable, halving chains
        near = np.where(linked, root[None, :], m).min(axis=1)
        now = np.minimum(root, near)
        now = now[now]
        if (now == root).all():
            break
        root = now
    return [(node[i], int(links[i]), node[root[i]]) for i in np.flatnonzero(links).tolist()]


VERIFIED = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def verify_groups(threshold: float):
    """Rows sorted by (hub, first block, second block) to verified links, a group at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] == key and row[4] == held[-1][1]:
                    continue  # a repeated row of the table
                if row[:3] != key:
                    if len(held) > 1:
                        out += verify(key[0], *map(list, zip(*held)), threshold)
                    key, held = row[:3], []
                held.append(row[3:])
            if out:
                yield record_batch(VERIFIED, list(zip(*out)))
                out = []
        if len(held) > 1:
            out += verify(key[0], *map(list, zip(*held)), threshold)
        if out:
            yield record_batch(VERIFIED, list(zip(*out)))

    return run


def join_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, row (a hash of the text), class_id, class_root, n_links per row of ``docs`` (doc_id, text).

    Words are runs without ASCII white space, unchanged. Two rows are linked if the Jaccard similarity of their
    sets of five-word shingles is ``threshold`` or more; copies have similarity 1. ``n_links`` is the number
    of rows linked to the row (repeated rows included); ``class_id`` the smallest doc_id among
    all rows connected by links (null if none has one). Null texts and texts without words have no shingles: no
    links, each a class of its own with its own doc_id; ``class_root`` is null for every row without links. No rows give no
    rows; other columns are not used.
    """
    bands = bands_for(threshold, recall)
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("row"),
                        F.col("text").cast("string"))
    signed = staged(keyed.mapInArrow(sign(bands, ROWS), SIGNED_DDL), TEXT_ROWS)
    own = signed.filter(F.col("content").isNotNull())
    contents = own.groupBy("content").agg(F.count("*").alias("copies"), F.max("size").alias("size"),
                                          F.min_by(F.struct("doc_id", "row"), F.struct("doc_id", "row")).alias("at"),
                                          F.first("bands").alias("bands"))
    contents = staged(contents.withColumn("node", F.monotonically_increasing_id()))

    banded = contents.select("node", "size", F.explode("bands").alias("band"))
    buckets = staged(banded.groupBy("band").agg(F.min("node").alias("hub"), F.max("node").alias("other"))
                     .filter("hub < other").select("band", "hub"))
    met = staged(banded.join(buckets, "band").select("node", "size", "hub").distinct())
    # The blocks of large hubs are found on narrow rows; full sets are moved once, to the groups that verify them.
    large = staged(met.groupBy("hub").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK_CONTENTS), F.ceil(F.sum("size") / BLOCK_SHINGLES)).alias("blocks")).filter("blocks > 1"))
    hubs = staged(met.join(large, "hub", "left").groupBy("node")
                  .agg(F.sort_array(F.collect_list(F.struct("hub", F.coalesce("blocks", F.lit(1)).cast("long").alias("blocks")))).alias("of"))
                  .join(contents, "node").select("node", "copies", "of.hub", "of.blocks", "at.doc_id", "at.row"))

    texts = keyed.select(F.col("doc_id").alias("id"), F.col("row").alias("own"), "text").filter(F.col("text").isNotNull())
    sets = staged(texts.join(hubs.hint("merge"), F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("row")))
                  .select("text", "node", "copies", "hub", "blocks").mapInArrow(full_sets, MEMBERS_DDL), TEXT_ROWS)
    dealt = (sets.select("node", "copies", "grams", "hubs", F.explode(F.arrays_zip("hubs", "blocks")).alias("in"))
             .select("node", "copies", "grams", "hubs", F.col("in.hubs").alias("hub"), F.col("in.blocks").alias("blocks"))
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    pairs = dealt.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "hub", F.least("block", "with").alias("first"), F.greatest("block", "with").alias("second"),
        F.when(F.col("block") == F.col("with"), 2).when(F.col("block") < F.col("with"), 0).otherwise(1).alias("side"), "node", "copies", "grams", "hubs")
    verified = staged(pairs.repartition("hub", "first", "second").sortWithinPartitions("hub", "first", "second", "node")
                      .mapInArrow(verify_groups(threshold), "node long, links long, root long"), TEXT_ROWS)

    roots = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = (contents.select("content", "node", "copies", "at.doc_id")
              .join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
              .join(roots, "node", "left")
              .select("content", "doc_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                      F.coalesce("root", "node").alias("class_root"))
              .filter("n_links > 0"))
    linked = staged(linked)
    classes = linked.groupBy("class_root").agg(F.min("doc_id").alias("class_id"))
    named = linked.drop("doc_id").join(classes, "class_root")
    return (signed.select("doc_id", "row", "content").join(named, "content", "left")
            .select("doc_id", "row", F.when(F.col("class_root").isNotNull(), F.col("class_id"))
                    .otherwise(F.col("doc_id")).alias("class_id"), "class_root", F.coalesce("n_links", F.lit(0)).alias("n_links")))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")


QUERIES = {"op10_jaccard_join": op10_jaccard_join}
ORACLE_SQL: dict[str, str] = {}
