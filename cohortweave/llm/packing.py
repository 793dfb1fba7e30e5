"""Packing by shortest-pack-first over the length histogram.

Texts are tokenized once; a text of more than ``capacity`` tokens is cut into full sequences
and a rest. The histogram of rests (one count a length, at most ``capacity`` rows whatever the
input) comes to the driver, where lengths are placed longest first: each count goes to the shortest
open pack pattern that it fits, a pattern being split when only some of its packs are used. The
patterns (each step adds at most one) become a table of rank ranges per length, bounded by the
capacity alone, and every piece finds its sequence and offset by its rank among pieces of its length.
Ranks come from counts of (length, bucket), so a common length is never ordered in one task.
"""

from __future__ import annotations

import heapq
import json
import math
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortweave.llm.common import record_batch, spans, staged, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 4096
END_ID = 2
#: Distinct chunks whose ids a worker process remembers (about 200 bytes each).
CACHE_WORDS = 1_200_000
#: Pieces of one length that one task ranks, about.
BUCKET_ROWS = 500_000


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: A boundary that the vocabulary always has: nothing joins a letter and a sign after it. Only letters that stay one letter
#: when normalised: of others (a dotted capital I, for one) a mark may be left that does join the sign.
LETTER_SIGN = "([A-Za-zÀ-ÖØ-öø-įı-ſА-яЁё])([.,;:!?#$%*&])"
#: The normaliser and splitter that cutting into chunks rests on; with others whole texts are encoded. Fixed values.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLITTER = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Letters whose lower case is one letter and which no normal form changes; such words are encoded many at a time.
PLAIN_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
WORDS_AT_ONCE = 1000
#: Texts are split and coded in slices of about so many bytes.
CODE_BYTES = 8_000_000


class WordIds(dict):
    """Ids (little-endian 32-bit) by chunk. A vocabulary with ``NORMALIZER`` and ``SPLITTER`` drops white space and joins nothing
    across it, nor across a letter and a following sign, so chunks are encoded once each and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary_ = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary_.values()) + 1, bool)
        self.ends_word[[i for token, i in vocabulary_.items() if token.endswith("</w>")]] = True
        made = json.loads(self.tokenizer.to_str())
        steps = (made["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
        self.in_chunks = (made["normalizer"] == NORMALIZER and steps[0].get("pattern") == {"Regex": SPLITTER}
                          and steps[0].get("behavior") == "Removed" and steps[0].get("invert") is True)

    def encode(self, chunks: list[str]) -> list[np.ndarray]:
        coded = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in coded]

    def learn(self, chunks: list[str]) -> None:
        """Remember new chunks. Plain words are encoded as one text a group and told apart by the
        tokens that end a word; a group without one such token a word is encoded word by word."""
        plain = [c for c in chunks if PLAIN_WORD.fullmatch(c)]
        single = [c for c in chunks if not PLAIN_WORD.fullmatch(c)]
        lower = list({c.lower() for c in plain} - self.keys())
        groups = [lower[lo:lo + WORDS_AT_ONCE] for lo in range(0, len(lower), WORDS_AT_ONCE)]
        for group, ids in zip(groups, self.encode([" ".join(g) for g in groups])):
            stops = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
            if len(stops) != len(group):
                single += group
                continue
            coded = ids.tobytes()
            self.update(zip(group, (coded[a:b] for a, b in zip([0, *stops], stops))))
        self.update(zip(single, (ids.tobytes() for ids in self.encode(single))))
        for c in plain:
            self[c] = self[c.lower()]

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all ``texts`` (large strings without nulls) one after another, and where each text's begin and end."""
        if not self.in_chunks:
            coded = self.encode(texts.to_pylist())
            return np.concatenate([np.empty(0, "<u4"), *coded]), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)
        if len(self) > CACHE_WORDS:
            self.clear()
        parted = pc.replace_substring_regex(pc.replace_substring(texts, "\n", " "), LETTER_SIGN, r"\1 \2")
        lists = pc.split_pattern(parted, " ")
        chunks = lists.flatten().dictionary_encode()
        distinct = chunks.dictionary.to_pylist()
        self.learn([c for c in distinct if c not in self])
        coded = [self[c] for c in distinct]
        flat = np.frombuffer(b"".join(coded), "<u4")
        sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.cumsum(sizes) - sizes
        at = chunks.indices.to_numpy()
        size = sizes[at]
        after = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(starts[at] - after[:-1], size) + np.arange(after[-1])]
        words = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
        return ids, after[words]


def word_ids(path: str) -> WordIds:
    """The one of this worker process: tasks that follow one another share what is remembered."""
    held = sys.modules.setdefault("_llm_word_ids", types.ModuleType("_llm_word_ids")).__dict__
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


PIECES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64())])
PIECES_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut(path: str, capacity: int = CAPACITY):
    """Texts to pieces: full sequences and a rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        known = word_ids(path)
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for lo, hi in spans(pc.binary_length(texts).to_numpy(), CODE_BYTES):
                ids, bounds = known.ids(texts.slice(lo, hi - lo))
                rows = []
                for k, doc_id in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                    own = np.append(ids[bounds[k]:bounds[k + 1]], np.array([END_ID], "<u4"))
                    for a in range(0, len(own), capacity):
                        piece = own[a:a + capacity]
                        rows.append((doc_id, a, len(piece), zlib.crc32(piece.data), len(own)))
                yield record_batch(PIECES, zip(*rows))

    return run


def patterns(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Shortest-pack-first: ((length, copies in a pack), ...) and the number of such packs.

    Lengths go longest first; of the patterns with room the shortest (most room) takes the
    count, one piece a pack, until the count is used up; what fits nowhere opens new packs.
    """
    heap: list[tuple[int, int, tuple[tuple[int, int], ...], int]] = []  # (length so far, age, pattern, packs)
    done: list[tuple[tuple[tuple[int, int], ...], int]] = []
    age = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if heap and heap[0][0] + length <= capacity:
                used, _, pattern, packs = heapq.heappop(heap)
            else:
                used, pattern, packs = 0, (), left
            taken = min(packs, left)
            if taken < packs:
                age += 1
                heapq.heappush(heap, (used, age, pattern, packs - taken))
            left -= taken
            if pattern and pattern[-1][0] == length:
                grown = (*pattern[:-1], (length, pattern[-1][1] + 1))
            else:
                grown = (*pattern, (length, 1))
            if used + length == capacity:
                done.append((grown, taken))
            else:
                age += 1
                heapq.heappush(heap, (used + length, age, grown, taken))
    return done + [(pattern, packs) for _, _, pattern, packs in sorted(heap)]


def rank_ranges(packs: list[tuple[tuple[tuple[int, int], ...], int]], first_sequence: int = 0) -> np.ndarray:
    """Rows (length, first rank, copies in a pack, first sequence, offset in the sequence), by length and rank."""
    rows, ranks, sequence = [], {}, first_sequence
    for pattern, n in packs:
        offset = 0
        for length, copies in pattern:
            rank = ranks.get(length, 0)
            rows.append((length, rank, copies, sequence, offset))
            ranks[length] = rank + n * copies
            offset += length * copies
        sequence += n
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


PLACED_DDL = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
PLACED = pa.schema([(c, pa.int64()) for c in
                    ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])


def place(shared, stride: int):
    """Find each piece's sequence by its length and rank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges = shared.value
        keys = ranges[:, 0] * stride + ranges[:, 1]
        for batch in batches:
            length = batch.column(2).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * stride + rank, side="right") - 1
            inside = rank - ranges[at, 1]
            sequence = ranges[at, 3] + inside // ranges[at, 2]
            offset = ranges[at, 4] + inside % ranges[at, 2] * length
            yield record_batch(PLACED, (*batch.columns[:5], sequence, offset))

    return run


def ranked(pieces: DataFrame, n_pieces: int) -> DataFrame:
    """The rank of each piece among those of its length, from 0 without gaps.

    Each length is dealt into buckets by a hash of the piece's number (its place in the staged table, so alike rows
    are dealt out, too), counted, and offset by the counts before; only a bucket is ordered in one task.
    """
    buckets = max(1, math.ceil(n_pieces / BUCKET_ROWS)) * 8
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("number"), F.lit(buckets)))
    counts = dealt.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip"))
    inside = Window.partitionBy("length", "bucket").orderBy("number")
    return (dealt.withColumn("own", F.row_number().over(inside) - 1).join(counts, ["length", "bucket"])
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("own") + F.col("skip")).alias("rank")))


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of the tokenized ``docs`` (doc_id, text) with their sequence and offset.

    Null and empty texts are one piece, the end id alone. Rows that share a doc_id, also with the same
    text, are packed each for itself; no rows give no rows; other columns are not used. ``path`` is any vocabulary of
    ``tokenizers``. Returns doc_id, start, length, ids_crc32, doc_tokens, sequence_id (from 0 without gaps), offset.
    """
    spark = docs.sparkSession
    pieces = staged(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
                    .mapInArrow(cut(path or vocabulary(), capacity), PIECES_DDL)
                    .withColumn("number", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    n_pieces = sum(histogram.values())
    ranges = rank_ranges(patterns(histogram, capacity))
    stride = 1 << max(1, n_pieces).bit_length()
    shared = spark.sparkContext.broadcast(ranges)
    return ranked(pieces, n_pieces).mapInArrow(place(shared, stride), PLACED_DDL)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op2_packing": op2_packing}
ORACLE_SQL: dict[str, str] = {}
