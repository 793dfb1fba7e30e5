"""Near duplicates among embeddings, by an inverted multi-index.

1. Equal vectors of one label are one *content*; work goes on with contents.
2. Two codebooks, one for each half of the unit vectors, are fitted by k-means on a sample of at most ``SAMPLE`` contents
   (fewer if ``SAMPLE_BYTES`` is reached). Their product is a grid of cells, about ``CELL`` contents each
   until ``MOST`` centres a half; every content is indexed in the cell of its nearest centres.
3. Multi-sequence traversal: for a vector, a cell's bound is the sum of the squared distances to the
   bisectors between its own centres and the cell's. Nearest cells come first; it stops at the bound that the target
   recall needs. With recall 1 that is the squared distance at the threshold itself: no link is ever missed. A lower
   recall takes the quantile of that bound over neighbours drawn at the threshold.
   Only cells up to the vector's own in the grid's order are visited: each pair meets once.
4. The cells of one first centre are cut into blocks of about ``BLOCK`` contents along the second codebook (sorted
   along its main axis, in ``STRIPES`` stripes); a vector goes once to each block with a visited cell. Visitors of
   a block are dealt to parts of about ``VISITORS``. A group (block, part) is bounded whatever the data; it
   verifies all its pairs with one matrix product in double precision and returns link counts and one
   link to a root for each member, never pairs.
5. Components come from the roots' links by star contraction.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from cohortweave.llm.common import record_batch, staged, table
from cohortweave.llm.components import components

cloudpickle.register_pickle_by_value(sys.modules[__name__])

THRESHOLD = 0.98
RECALL = 1.0
#: Contents that the codebooks are fitted on, at most, and bytes of them.
SAMPLE = 16_384
SAMPLE_BYTES = 32_000_000
#: Contents a cell that the number of centres aims at; centres a half, at least and at most.
CELL = 50
LEAST, MOST = 4, 256
STRIPES = 32
BLOCK = 2048
VISITORS = 16_384
#: Rows of one matrix product.
CHUNK = 2048
#: Added to squared distances, against rounding.
SLACK = 1e-9


def valid(vectors: pa.Array, kind: str) -> tuple[list[bytes | None], list[int]]:
    """The bytes of each vector that has a direction (scaled by a power of two, which leaves cosines as they are), else
    None; and its length."""
    flat = vectors.flatten()
    values = np.array(flat.fill_null(np.nan).to_numpy(zero_copy_only=False), np.float64)
    size = np.where(np.asarray(vectors.is_null()), 0, np.asarray(vectors.value_lengths().fill_null(0)))
    ends = np.cumsum(size)
    out: list[bytes | None] = []
    for a, b in zip((ends - size).tolist(), ends.tolist()):
        x = values[a:b]
        largest = np.abs(x).max(initial=0.0)
        if not np.isfinite(x).all() or largest == 0:
            out.append(None)
        elif kind == "<f4":
            out.append((x + 0.0).astype(kind).tobytes())
        else:
            out.append((np.ldexp(x, -int(np.frexp(largest)[1])) + 0.0).astype(kind).tobytes())
    return out, size.tolist()


PREPARED = pa.schema([("vec_id", pa.int64()), ("key", pa.string()), ("digest", pa.binary()), ("vector", pa.binary())])


def prepare(kind: str):
    """(vec_id, label, vector) to the vector's bytes and a digest of label and vector; both null if it links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_pylist()
            vectors, sizes = valid(batch.column(2), kind)
            vectors = [None if label is None else v for label, v in zip(labels, vectors)]
            keys = [None if v is None else f"{n}:{label}" for n, label, v in zip(sizes, labels, vectors)]
            digests = [None if v is None else xxhash.xxh3_128_digest(k.encode() + b"\0" + v) for k, v in zip(keys, vectors)]
            yield record_batch(PREPARED, (batch.column(0), keys, digests, vectors))

    return run


def matrix(vectors: list[bytes], kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(len(vectors), -1).astype(np.float64)


def halves(vectors: list[bytes], kind: str, width: int) -> list[np.ndarray]:
    """The halves of unit vectors, brought to ``width`` numbers (a projection: it brings no two vectors apart)."""
    out = np.zeros((len(vectors), width))
    for k, v in enumerate(vectors):
        x = np.frombuffer(v, kind).astype(np.float64)
        x = x / np.linalg.norm(x)
        out[k, :min(width, len(x))] = x[:width]
    half = (width + 1) // 2
    return [out[:, :half], out[:, half:]]


def squares(z: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (z ** 2).sum(1)[:, None] - 2 * (z @ centres.T) + (centres ** 2).sum(1)


def fit(z: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres by k-means, distinct, sorted along their main axis."""
    draw = np.random.default_rng(12)
    centres = z[draw.choice(len(z), min(k, len(z)), replace=False)].copy()
    for _ in range(rounds):
        own = np.concatenate([squares(z[a:a + CHUNK], centres).argmin(1) for a in range(0, len(z), CHUNK)])
        order = np.argsort(own, kind="stable")
        held, first = np.unique(own[order], return_index=True)
        centres[held] = np.add.reduceat(z[order], first) / np.diff(np.append(first, len(z)))[:, None]
    centres = np.unique(centres, axis=0)
    if centres.shape[1]:
        around = centres - centres.mean(0)
        centres = centres[np.argsort(around @ np.linalg.svd(around, full_matrices=False)[2][0], kind="stable")]
    return centres


def bounds(z: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centre, and its squared distance to the bisector with every other one: what lies
    in the other's cell is no nearer."""
    d = squares(z, centres)
    own = d.argmin(1)
    between = np.sqrt(np.maximum(squares(centres, centres), 0))[own]
    ahead = np.maximum(d - d[np.arange(len(z)), own][:, None], 0)
    away = np.divide(ahead, 2 * between, out=np.zeros_like(ahead), where=between > 1e-7)
    away[np.arange(len(z)), own] = 0
    return own, away ** 2


def limit_for(sample: list[bytes], books: list[np.ndarray], kind: str, width: int, threshold: float, recall: float) -> float:
    """The bound at which the traversal stops."""
    most = 2 - 2 * threshold + SLACK
    if recall >= 1:
        return most
    draw = np.random.default_rng(13)
    x = np.concatenate(halves(sample, kind, width), axis=1)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    u = draw.normal(size=x.shape)
    u -= (u * x).sum(1, keepdims=True) * x
    y = threshold * x + np.sqrt(1 - threshold ** 2) * u / np.maximum(np.linalg.norm(u, axis=1, keepdims=True), 1e-12)
    half, total = (width + 1) // 2, 0
    for book, part in zip(books, (slice(0, half), slice(half, width))):
        there = squares(y[:, part], book).argmin(1)
        total = total + bounds(x[:, part], book)[1][np.arange(len(x)), there]
    return min(most, float(np.quantile(total, recall)) + SLACK)


INDEXED = pa.schema([("node", pa.int64()), ("key", pa.string()), ("copies", pa.int64()), ("vector", pa.binary()), ("first", pa.int32()),
                     ("stripe", pa.int32()), ("cell", pa.int64()), ("visits", pa.list_(pa.struct([("first", pa.int32()), ("mask", pa.int64())])))])
INDEXED_DDL = ("node long, key string, copies long, vector binary, first int, stripe int, cell long, "
               "visits array<struct<first: int, mask: long>>")


def index(books: list[np.ndarray], limit: float, kind: str, width: int):
    """Contents to their cells and the cells to visit, by first centre with a mask of stripes of second centres."""
    stripe = (np.arange(len(books[1])) * STRIPES // len(books[1])).astype(np.int64)

    def traverse(near: np.ndarray, far: np.ndarray, own: tuple[int, int]) -> list[tuple[int, int]]:
        """The cells up to ``own`` whose bounds sum up to ``limit`` at most, nearest first along both sequences."""
        out = []
        reach = np.argsort(far, kind="stable")
        sums = far[reach]
        for i in np.argsort(near, kind="stable").tolist():
            if near[i] > limit:
                break
            if i > own[0]:
                continue
            seconds = reach[:np.searchsorted(sums, limit - near[i], side="right")]
            if i == own[0]:
                seconds = seconds[seconds <= own[1]]
            out.append((i, int(np.bitwise_or.reduce(np.int64(1) << stripe[seconds]))))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, 4_000_000 // (8 * max(width, len(books[0]))))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                vectors = part.column(3).to_pylist()
                (i, near), (j, far) = (bounds(z, book) for z, book in zip(halves(vectors, kind, width), books))
                visits = [[{"first": f, "mask": m} for f, m in traverse(near[k], far[k], (int(i[k]), int(j[k])))]
                          for k in range(len(vectors))]
                yield record_batch(INDEXED, (*part.columns, i, stripe[j], i.astype(np.int64) * len(books[1]) + j, visits))

    return run


def roots_of(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a matrix of links between two sides: a number for each member's component, by the smallest column in it."""
    most = linked.shape[1]
    column = np.arange(most)
    while True:
        row = np.where(linked, column[None, :], most).min(axis=1)
        now = np.minimum(column, np.where(linked, row[:, None], most).min(axis=0))
        now = now[now]
        if (now == column).all():
            return row, column
        column = now


VERIFIED = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def verify(kind: str, threshold: float):
    """The rows of one block and part to (node, links, root) of its members with links."""
    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        sides = [group.filter(pa.array(side == s)) for s in (0, 1)]
        if not sides[0].num_rows or not sides[1].num_rows:
            return VERIFIED.empty_table()
        node, cell, copies = ([s.column(c).to_numpy() for s in sides] for c in ("node", "cell", "copies"))
        held, moving = (matrix(s.column("vector").to_pylist(), kind) for s in sides)
        length = [np.sqrt((x ** 2).sum(1)) for x in (held, moving)]
        out: list[np.ndarray] = []
        for a in range(0, len(moving), CHUNK):
            rows = slice(a, a + CHUNK)
            linked = (moving[rows] @ held.T) / (length[1][rows][:, None] * length[0]) >= threshold
            after = cell[1][rows][:, None] > cell[0]
            after |= (cell[1][rows][:, None] == cell[0]) & (node[1][rows][:, None] > node[0])
            linked &= after
            some, met = np.flatnonzero(linked.any(1)), np.flatnonzero(linked.any(0))
            if not len(some):
                continue
            linked = linked[np.ix_(some, met)]
            row, column = roots_of(linked)
            home = node[0][met]
            out.append(np.stack([node[1][rows][some], linked @ copies[0][met].astype(np.float64), home[row]]).astype(np.int64))
            out.append(np.stack([home, copies[1][rows][some].astype(np.float64) @ linked, home[column]]).astype(np.int64))
        return pa.Table.from_arrays([pa.array(c) for c in np.concatenate(out, axis=1)] if out else [pa.array([], pa.int64())] * 3, schema=VERIFIED)

    return run


def _spread(name: str, parts):
    """A number below ``parts`` by the hash of ``name``."""
    return F.pmod(F.xxhash64(name), F.greatest(parts, F.lit(1)).cast("long"))


def link_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                 sample: int = SAMPLE) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label).

    Two rows with one label (not null) are linked if the cosine of their vectors is ``threshold`` or more; equal
    vectors are. ``n_links``: other rows linked with the row (repeated rows included); ``component_id``: the
    smallest vec_id among all rows connected by links (null if none has one); ``kept``: whether it is the row's own.
    Vectors that are null, empty or zero, hold null or non-finite numbers, or have a null label link with nothing, nor do
    vectors of different lengths: each is a component of its own. No rows give no rows; other columns are not used.
    ``recall`` below 1 may miss links (never below that share, for neighbours drawn at the threshold); ``sample``
    bounds only what the codebooks are fitted on.
    """
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType
    kind = "<f4" if isinstance(element, ArrayType) and isinstance(element.elementType, FloatType) else "<f8"
    cast = F.col("embedding") if kind == "<f4" else F.col("embedding").cast("array<double>")
    rows = staged(vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), cast)
                  .mapInArrow(prepare(kind), "vec_id long, key string, digest binary, vector binary"))
    contents = staged(rows.filter(F.col("digest").isNotNull()).groupBy("digest", "key", "vector")
                      .agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
                      .withColumn("node", F.monotonically_increasing_id()))
    n, width = contents.agg(F.count("*"), F.percentile_approx(F.length("vector"), 0.5)).first()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))
    width //= int(kind[2])
    wanted = max(LEAST, min(sample, SAMPLE_BYTES // (8 * width)))
    drawn = contents.filter(F.pmod(F.xxhash64("digest"), F.lit(1 << 30)) <= int(min(1.0, wanted / n) * (1 << 30)))
    training = [bytes(r.vector) for r in drawn.select("vector").limit(2 * wanted).collect()] or \
               [bytes(r.vector) for r in contents.select("vector").limit(wanted).collect()]
    centres = max(LEAST, min(MOST, 1 << round(np.log2(max(n / CELL, 1)) / 2)))
    books = [fit(z, centres) for z in halves(training, kind, width)]
    limit = limit_for(training, books, kind, width, threshold, recall)

    indexed = staged(contents.select("node", "key", "copies", "vector").mapInArrow(index(books, limit, kind, width), INDEXED_DDL))
    cells = indexed.groupBy("key", "first", "stripe").agg(F.count("*").alias("n"))
    along = "sum(n) OVER (PARTITION BY key, first ORDER BY stripe ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cells = cells.withColumn("upto", F.expr(along)).select(
        "key", "first", "stripe", F.floor((F.col("upto") - F.col("n")) / BLOCK).alias("low"), F.floor((F.col("upto") - 1) / BLOCK).alias("high"))
    cells = staged(cells)
    visits = indexed.select("node", "key", "copies", "vector", "cell", F.explode("visits").alias("v")).select(
        "node", "key", "copies", "vector", "cell", "v.first", "v.mask")
    parts = visits.groupBy("key", "first").agg(F.ceil(F.count("*") / VISITORS).alias("parts"))
    grid = staged(cells.groupBy("key", "first").agg(F.collect_list(F.struct("stripe", "low", "high")).alias("cells"))
                  .join(parts, ["key", "first"]))
    group = ("key", "first", "block", "part", "side", "node", "copies", "vector", "cell")
    held = (indexed.join(cells, ["key", "first", "stripe"])
            .withColumn("block", F.col("low") + _spread("node", F.col("high") - F.col("low") + 1))
            .join(grid.select("key", "first", "parts"), ["key", "first"])
            .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("side", F.lit(0)))
    reached = "array_distinct(flatten(transform(filter(cells, c -> (mask & shiftleft(1L, c.stripe)) <> 0), c -> sequence(c.low, c.high))))"
    moving = (visits.join(grid, ["key", "first"]).withColumn("block", F.explode(F.expr(reached)))
              .withColumn("part", _spread("node", F.col("parts"))).withColumn("side", F.lit(1)))
    verified = staged(held.select(*group).unionByName(moving.select(*group)).groupBy("key", "first", "block", "part")
                      .applyInArrow(verify(kind, threshold), "node long, links long, root long"))

    roots = components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    linked = staged(contents.select("node", "digest", "copies", "least")
                    .join(verified.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
                    .join(roots, "node", "left")
                    .select("digest", "least", F.coalesce("root", "node").alias("root"),
                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
                    .filter("n_links > 0"))
    smallest = linked.groupBy("root").agg(F.min("least").alias("component"))
    named = linked.join(smallest, "root").select("digest", "n_links", F.lit(True).alias("found"), "component")
    component = F.when(F.col("found"), F.col("component")).otherwise(F.col("vec_id"))
    return (rows.select("vec_id", "digest").join(named, "digest", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                    F.col("vec_id").eqNullSafe(component).alias("kept")))


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_embedding_dedup": op12_embedding_dedup}

ORACLE_SQL = {"op12_embedding_dedup": """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id, b.vec_id AS other FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached(vec_id, other) AS (
    SELECT vec_id, other FROM links
    UNION SELECT r.vec_id, l.other FROM reached r JOIN links l ON l.vec_id = r.other),
counted AS (SELECT vec_id, count(*) AS n FROM links GROUP BY vec_id),
least AS (SELECT vec_id, min(other) AS other FROM reached GROUP BY vec_id)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(l.other, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(l.other, e.vec_id) AS kept
FROM embeddings e LEFT JOIN counted c USING (vec_id) LEFT JOIN least l USING (vec_id)
"""}
