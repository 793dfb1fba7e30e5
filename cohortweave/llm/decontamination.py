"""Benchmark decontamination: a broadcast set of hashed benchmark windows against all texts.

Words are runs of ASCII letters and digits, A-Z lower-cased, and of all other code points
beyond ASCII. A window is ``width`` consecutive words of an item; an item with fewer words, but
some, is one window. Texts are scanned with rolling hashes in numpy; each hit is then verified
on the words themselves. The set is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows,
so its size is bounded whatever the benchmark's; each block is one scan of the texts.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import binary, mix, record_batch, slices, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 10
#: Windows in one broadcast block (about 200 bytes each).
BLOCK_WINDOWS = 200_000
BITMAP_BITS = 23
_BASE = np.uint64(0x5851F42D4C957F2D)

#: Byte by byte: letters lower-cased, digits and bytes beyond ASCII kept, the rest a space.
CLEAN = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256)
)


def normal_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(CLEAN).split()


def item_windows(words: list[bytes], width: int = WIDTH) -> set[bytes]:
    if not words:
        return set()
    return {b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))}


def names(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(name: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` names."""
    n = len(name) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(width):
        out = out * _BASE + name[j:j + n] if n > 0 else out
    return mix(out)


class WindowSet:
    """Windows by length in words: a bitmap to pass most texts by, sorted hashes, and the
    windows' words with their items."""

    def __init__(self, windows: dict[bytes, list[str]]):
        self.windows = windows
        self.lengths = {}
        by_length: dict[int, list[bytes]] = {}
        for w in windows:
            by_length.setdefault(w.count(b" ") + 1, []).append(w)
        for length, group in by_length.items():
            flat = names([x for w in group for x in w.split(b" ")]).reshape(-1, length)
            out = np.zeros(len(group), np.uint64)
            for j in range(length):
                out = out * _BASE + flat[:, j]
            hashes = np.unique(mix(out))
            bitmap = np.zeros(1 << BITMAP_BITS, bool)
            bitmap[hashes >> np.uint64(64 - BITMAP_BITS)] = True
            self.lengths[length] = np.packbits(bitmap), hashes

    def hits(self, words: list[bytes], name: np.ndarray) -> Iterator[tuple[int, int, list[str]]]:
        """Verified (start, length, items) among the words of several texts; ``name`` has a
        separator's number where ``words`` has an empty one."""
        for length, (bitmap, hashes) in self.lengths.items():
            rolled = rolling(name, length)
            slot = (rolled >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)
            maybe = np.flatnonzero((bitmap[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1)
            at = np.minimum(np.searchsorted(hashes, rolled[maybe]), len(hashes) - 1)
            for p in maybe[hashes[at] == rolled[maybe]].tolist():
                items = self.windows.get(b" ".join(words[p:p + length]))
                if items is not None:
                    yield p, length, items


def built(windows: dict[bytes, list[str]]) -> WindowSet:
    """The set of the broadcast windows; the last one is kept by the worker process. Plain dicts are broadcast, as
    executors need not have this module to unpickle them."""
    held = sys.modules.setdefault("_llm_window_set", types.ModuleType("_llm_window_set")).__dict__
    if held.get("windows") is not windows:
        held.update(windows=windows, set=WindowSet(windows))
    return held["set"]


SCANNED = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_words", pa.int64()),
                     ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])


def scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = built(shared.value)
        for batch in batches:
            ids = batch.column(0)
            row = batch.column(1)
            texts = [t or b"" for t in binary(batch.column(2))]
            for lo, hi in slices(texts):
                per_text = [normal_words(t) for t in texts[lo:hi]]
                flat: list[bytes] = []
                for words in per_text:
                    flat += words
                    flat.append(b"")
                begins = np.concatenate([[0], np.cumsum([len(w) + 1 for w in per_text])])
                name = names(flat)
                spans: list[list[int]] = [[] for _ in per_text]
                items: list[set[str]] = [set() for _ in per_text]
                for p, length, found in windows.hits(flat, name):
                    i = int(np.searchsorted(begins, p, side="right")) - 1
                    spans[i] += (p - int(begins[i]), p - int(begins[i]) + length)
                    items[i].update(found)
                yield record_batch(SCANNED, (
                    ids.slice(lo, hi - lo), row.slice(lo, hi - lo), [len(w) for w in per_text],
                    [[x for span in merged(s) for x in span] for s in spans], [sorted(s) for s in items]))

    return run


def merged(spans: list[int]) -> list[tuple[int, int]]:
    """Flat (start, end, ...) to disjoint spans in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(spans[::2], spans[1::2])):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def without_hits(text: bytes, windows: WindowSet) -> bytes:
    """``text`` without the words of hit windows and what stands between them."""
    words = normal_words(text)
    spans = [x for p, n, _ in windows.hits(words, names(words)) for x in (p, p + n)]
    return without_words(text, spans) if spans else text


def without_words(text: bytes, spans: list[int]) -> bytes:
    """``text`` without the words of the spans (flat: start, end, ...) and what stands between them."""
    places = [m.span() for m in WORD.finditer(text.lower())]
    out, at = [], 0
    for a, b in merged(spans):
        out.append(text[at:places[a][0]])
        at = places[b - 1][1]
    return b"".join(out) + text[at:]


SCANNED_DDL = "doc_id long, row long, n_words long, spans array<long>, items array<string>"

CONCLUDED = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                       ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()),
                       ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.string()))])
CONCLUDED_DDL = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
                 "spans array<long>, items array<string>")


def conclude(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, _, n_words, spans, items = batch.columns
        flat = [[x for span in merged(s) for x in span] for s in spans.to_pylist()]
        found = [sorted(set(i)) for i in items.to_pylist()]
        n_hit = [sum(s[1::2]) - sum(s[::2]) for s in flat]
        yield record_batch(CONCLUDED, (
            ids, n_words, n_hit, [len(i) for i in found],
            [hashlib.sha256(",".join(i).encode()).hexdigest() for i in found], [n > 0 for n in n_hit], flat, found))


BENCH_WINDOWS_DDL = "window binary, item string"


def bench_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("window", pa.binary()), ("item", pa.string())])
    for batch in batches:
        item = batch.column(0).to_pylist()
        for i, text in enumerate(binary(batch.column(1))):
            own = sorted(item_windows(normal_words(text)))
            yield record_batch(schema, (own, [item[i] or ""] * len(own)))


def window_blocks(benchmark: DataFrame, block: int = BLOCK_WINDOWS) -> Iterator[dict[bytes, list[str]]]:
    """The benchmark's distinct windows with their items, at most ``block`` windows at a time. Rows stream
    to the driver by partition, in window order; one window's items are the only thing held whole."""
    rows = (benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
            .filter(F.col("text").isNotNull()).mapInArrow(bench_windows, BENCH_WINDOWS_DDL)
            .distinct().orderBy("window"))
    out: dict[bytes, list[str]] = {}
    for r in rows.toLocalIterator():
        w = bytes(r["window"])
        if w not in out and len(out) >= block:
            yield out
            out = {}
        out.setdefault(w, []).append(r["item"])
    yield out


def scans(docs: DataFrame, blocks: list) -> list[DataFrame]:
    """One scan of the texts for each broadcast dict of windows."""
    texts = docs.select(F.col("doc_id").cast("long"), F.xxhash64(F.col("text").cast("string")).alias("row"),
                        F.col("text").cast("string"))
    return [texts.mapInArrow(scan(shared), SCANNED_DDL) for shared in blocks]


def every_hit(found: list[DataFrame]) -> DataFrame:
    """doc_id, row, spans and items of the texts with a hit in one of the scans."""
    hits = [f.filter(F.size("items") > 0) for f in found]
    every = hits[0]
    for f in hits[1:]:
        every = every.unionByName(f)
    return every.groupBy("doc_id", "row").agg(
        F.flatten(F.collect_set("spans")).alias("spans"), F.flatten(F.collect_set("items")).alias("items"))


def hit_spans(docs: DataFrame, blocks: list) -> DataFrame:
    """doc_id, row (hash of the text), spans of the texts with a hit in one of the blocks."""
    return every_hit(scans(docs, blocks)).select("doc_id", "row", "spans")


def find_contamination(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): n_words, n_hit, n_items, items_sha256,
    contaminated, spans (flat word positions of the hit windows), items (ids, sorted as strings).

    Null and empty texts have no words and no hits. Rows of ``benchmark`` (item_id, text) with
    the same id are one item; a null id counts as the id ''; items without words match nothing.
    """
    spark = docs.sparkSession
    found = scans(docs, [spark.sparkContext.broadcast(windows) for windows in window_blocks(benchmark, block)])
    out = found[0]
    if len(found) > 1:
        every = every_hit(found).withColumnsRenamed({"doc_id": "id", "row": "own"})
        out = (out.drop("spans", "items").join(every, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("own")), "left")
               .select("doc_id", "row", "n_words", F.coalesce("spans", F.array().cast("array<bigint>")).alias("spans"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items")))
    return out.mapInArrow(conclude, CONCLUDED_DDL)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


QUERIES = {"op3_decontamination": op3_decontamination}
ORACLE_SQL = {"op3_decontamination": r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM documents),
asked AS (
  SELECT item_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws
  FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM asked WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM words, lengths WHERE len(ws) >= n)),
hits AS (SELECT d.doc_id, d.i, d.n, b.item_id FROM doc_windows d JOIN item_windows b ON d.n = b.n AND d.win = b.win),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit_words h ON w.doc_id = h.doc_id LEFT JOIN hit_items t ON w.doc_id = t.doc_id
"""}
