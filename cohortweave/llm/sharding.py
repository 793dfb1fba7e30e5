"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is cut into ``2^bits`` cells at quantiles of the whole table (numbers by approximate quantiles, whole
strings by their exact ranks), a row's cells give its curve index, and
the rows in curve order are cut into runs of equal count, one run a shard. So each shard covers a
small box in every dimension and file statistics prune on any of them.

The order is never made in one place: rows of a curve cell are dealt into hash buckets, counted,
and placed by the counts before them; the number of cells is fixed by the bits.
"""

from __future__ import annotations

import math
import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import binary, record_batch, staged, table
from cohortweave.operators.sequence import sequence_within

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARDS = 16
BITS = 5
#: Rows of one curve cell that one task orders, about.
BUCKET_ROWS = 500_000


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Curve index of integer points (rows x dimensions), each coordinate below ``2^bits``.

    Works from the top bit down: the Gray-code turns of each level are undone by exchanging or
    inverting the lower bits, then the bits of all dimensions are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    d = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(d):
            turned = (x[i] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(turned, low, swap)
            x[i] ^= swap
    for i in range(1, d):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[d - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flip
    out = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            out = (out << 1) | ((x[i] >> level) & 1)
    return out


def number_cuts(rows: DataFrame, column: str, cells: int) -> list[int]:
    """The inner cuts at approximate quantiles; over no rows, none."""
    shares = [i / cells for i in range(1, cells)]
    got = rows.agg(F.percentile_approx(column, shares, 100 * cells).alias("cuts")).first()["cuts"]
    return sorted(set(got or []))


def string_cuts(rows: DataFrame, column: str, cells: int) -> list[bytes]:
    """The first string of each cell but the lowest, by exact rank: distinct strings with their counts, combined before they
    are shuffled, and the rows ahead of each. At most ``cells`` strings come to the driver."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ranked = sequence_within(counts, keys=[], order=["value"], before={"ahead": F.col("n")})
    total = ranked.agg(F.sum("n")).first()[0] or 1
    cell = F.expr(f"ahead * {cells} div {total}")
    first = ranked.groupBy(cell.alias("cell")).agg(F.min("value").alias("value")).filter("cell > 0").collect()
    return sorted(r["value"].encode() for r in first)


def cells_of(values: pa.Array, cuts: list) -> np.ndarray:
    """How many cuts lie at or before each value."""
    if not pa.types.is_string(values.type) and not pa.types.is_large_string(values.type):
        return np.searchsorted(np.array(cuts, np.int64), values.to_numpy(zero_copy_only=False), side="right")
    coded = values.dictionary_encode()
    own = np.array([bisect_right(cuts, v) for v in binary(coded.dictionary)], np.int64)
    return own[coded.indices.to_numpy()] if len(own) else np.zeros(len(values), np.int64)


def place_on_curve(cuts: list[list], bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = [cells_of(batch.column(3 + i), cut) for i, cut in enumerate(cuts)]
            index = hilbert_index(np.stack(points, axis=1), bits)
            yield record_batch(PLACED, (*batch.columns[:3], index))

    return run


PLACED = pa.schema([(c, pa.int64()) for c in ("doc_id", "size", "text_crc32", "curve")])


def shard(docs: DataFrame, dimensions: tuple[str, ...] = ("lang", "source", "size"), shards: int = SHARDS,
          bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, law ('rows'), shard, slot, grown_shard (null), curve per row of ``docs``.

    ``docs`` needs doc_id, text and the dimensions; ``size`` stands for the UTF-8 bytes of the text plus 1.
    Null texts have size 1 and the checksum of no bytes; null metadata sort first (strings: as empty ones). Shards differ by at most
    one row; rows of one curve cell are ordered by buckets of their place in the staged table, so alike rows
    are dealt out like others. No rows give no shards; other columns are not used.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    based = docs.withColumn("size", F.octet_length(text).cast("long") + 1)
    kinds, names = dict(based.dtypes), [f"_d{i}" for i in range(len(dimensions))]
    in_order = [F.coalesce(F.col(c), F.lit("")) if kinds[c] == "string" else F.coalesce(F.col(c).cast("long"), F.lit(-(1 << 62)))
                for c in dimensions]
    rows = based.select(F.col("doc_id").cast("long").alias("doc_id"), "size", F.crc32(text.cast("binary")).alias("text_crc32"),
                        *[c.alias(n) for c, n in zip(in_order, names)])
    cuts = [(string_cuts if kinds[c] == "string" else number_cuts)(rows, n, 1 << bits) for c, n in zip(dimensions, names)]
    placed = staged(rows.mapInArrow(place_on_curve(cuts, bits), "doc_id long, size long, text_crc32 long, curve long")
                    .withColumn("number", F.monotonically_increasing_id()))

    # at most 2^(bits * dimensions) rows, whatever the input
    cells = sorted((r["curve"], r["n"]) for r in placed.groupBy("curve").agg(F.count("*").alias("n")).collect())
    total = sum(n for _, n in cells)
    before = np.cumsum([0] + [n for _, n in cells])[:-1].tolist()
    offsets = spark.createDataFrame([(c, o) for (c, _), o in zip(cells, before)], "curve long, ahead long")
    buckets = 8 * max(1, math.ceil(total / BUCKET_ROWS))
    dealt = placed.withColumn("bucket", F.pmod(F.xxhash64("number"), F.lit(buckets)))
    over = Window.partitionBy("curve").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    skips = (dealt.groupBy("curve", "bucket").agg(F.count("*").alias("n"))
             .select("curve", "bucket", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("skip"))
             .join(offsets, "curve"))
    inside = Window.partitionBy("curve", "bucket").orderBy("number")
    at = F.col("own") + F.col("skip") + F.col("ahead")
    return (dealt.withColumn("own", F.row_number().over(inside).cast("long") - 1).join(skips, ["curve", "bucket"])
            .withColumn("_at", at).withColumn("shard", F.expr(f"int(_at * {shards} div {max(total, 1)})"))
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                    F.expr(f"_at - (shard * {max(total, 1)}L + {shards - 1}) div {shards}").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "curve"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


QUERIES = {"op4_sharding": op4_sharding}
ORACLE_SQL: dict[str, str] = {}
