"""Substring deduplication by recompression.

Every text is parsed by *recompression*: runs of one word get a name, then, over a few
rounds, neighbouring symbols whose names fall on the left and on the right side of that
round's split of all names are fused and named anew. A name is a 64-bit hash of what it
stands for, so it is the same in every task and no naming job is needed. Whether a symbol
appears depends on a few words around it only (its *context*, tracked exactly), so two
equal windows hold the same symbols, away from their edges, at the same offsets.

1. For each window of ``width`` words the *anchor* is the longest-spelled (ties: smallest
   name) high-level symbol whose context lies inside the window; windows without one take
   it from a lower level, at last from the words. Neighbouring windows with one anchor form a
   *stretch*. Equal windows have equal anchors, so only anchors found twice matter.
2. Stretches are shuffled by anchor name and streamed in order: of equal stretches all but
   the first document's are repeats outright; stretches of one anchor that differ go to
   verification.
3. Documents meet their verdicts; the windows of stretches to verify are digested (128 bits
   of the words themselves) and grouped over the corpus; a window is a repeat if a smaller
   document has it.

Copies are combined before the shuffle: in a block of a task only the smallest document of
equal stretches is sent on. A stretch is a few numbers; no task holds a group of anchors.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import binary, mix, record_batch, slices, staged, staged_by, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 20
#: Pair rounds after the run round, and the levels anchors are taken from, best first.
ROUNDS = 4
ANCHOR_LEVELS = (4, 2, 0)
#: Stretches a task combines at a time before they are shuffled.
BLOCK = 1_000_000
#: A document without an id is ordered after all others.
LAST = (1 << 63) - 1
COUNT_BITS = 5

STRETCHES = pa.schema([("anchor", pa.int64()), ("stretch", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()),
                       ("ref", pa.int64())])


class Level:
    """Symbols in text order: name, first word, end word, and the words their presence depends on."""

    def __init__(self, name, first, end, low, high, edge):
        self.name, self.first, self.end = name, first, end
        self.low, self.high, self.edge = low, high, edge

    def pick(self, keep: np.ndarray) -> Level:
        return Level(*(x[keep] for x in (self.name, self.first, self.end, self.low, self.high, self.edge)))


def name_runs(at: Level) -> Level:
    """Fuse maximal runs of one name; each symbol now also depends on its two neighbours."""
    starts = np.flatnonzero(np.concatenate([[True], at.name[1:] != at.name[:-1]]))
    ends = np.concatenate([starts[1:], [len(at.name)]]) - 1
    size = (ends - starts + 1).astype(np.uint64)
    name = np.where(size > 1, mix(at.name[starts] + size * np.uint64(0xD6E8FEB86659FD93)), at.name[starts])
    low = at.low[np.maximum(starts - 1, 0)]
    high = at.high[np.minimum(ends + 1, len(at.name) - 1)]
    return Level(name, at.first[starts], at.end[ends], low, high, at.edge[starts])


def name_pairs(at: Level, round_: int) -> Level:
    """Fuse each left-sided symbol with a right-sided one after it. A symbol left alone depends
    on the neighbour that it could have been fused with."""
    side = (mix(at.name ^ np.uint64(0x9E37 + round_)) >> np.uint64(40)) & np.uint64(1)
    left, right = (side == 0) & ~at.edge, (side == 1) & ~at.edge
    head = np.flatnonzero(left[:-1] & right[1:])
    fused = np.zeros(len(left), bool)
    fused[head] = fused[head + 1] = True
    low, high, name, end = at.low.copy(), at.high.copy(), at.name.copy(), at.end.copy()
    alone = np.flatnonzero(left & ~fused)
    high[alone] = at.high[np.minimum(alone + 1, len(left) - 1)]
    alone = np.flatnonzero(right & ~fused)
    low[alone] = at.low[np.maximum(alone - 1, 0)]
    high[head], end[head] = at.high[head + 1], at.end[head + 1]
    name[head] = mix(at.name[head] * np.uint64(0x9E3779B97F4A7C15) + at.name[head + 1] + np.uint64(round_))
    keep = np.ones(len(left), bool)
    keep[head + 1] = False
    return Level(name, at.first, end, low, high, at.edge).pick(keep)


def parse(names: np.ndarray, edge: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """Levels 0 (words) to ``rounds``; ``edge`` marks the separators between texts."""
    i = np.arange(len(names))
    at = Level(names, i, i + 1, i, i + 1, edge)
    levels = [at]
    at = name_runs(at)
    for r in range(rounds):
        at = name_pairs(at, r)
        levels.append(at)
    return levels


def leftmost_best(key: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the smallest key (leftmost of equals) in each range lo..hi (inclusive, not empty)."""
    best, span = [np.arange(len(key))], 1
    longest = int((hi - lo).max()) + 1 if len(lo) else 0
    while 2 * span <= longest:
        a = best[-1]
        b = a[np.minimum(np.arange(len(a)) + span, len(a) - 1)]
        best.append(np.where(key[b] < key[a], b, a))
        span *= 2
    k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
    rows = np.stack(best) if best else np.empty((0, 0), int)
    a, b = rows[k, lo], rows[k, hi - (1 << k) + 1]
    return np.where(key[b] < key[a], b, a)


def anchors(levels: list[Level], starts: np.ndarray, spelled: np.ndarray, width: int):
    """Per window start: the anchor's level-independent name and first word."""
    name, first = np.zeros(len(starts), np.uint64), np.full(len(starts), -1)
    for depth in ANCHOR_LEVELS:
        todo = np.flatnonzero(first < 0)
        if not len(todo):
            break
        at = levels[min(depth, len(levels) - 1)]
        p = starts[todo]
        lo = np.searchsorted(at.low, p)
        hi = np.searchsorted(at.high, p + width, side="right") - 1
        some = lo <= hi
        letters = np.minimum((spelled[at.end] - spelled[at.first]) >> 2, 31).astype(np.uint64)
        key = ((np.uint64(31) - letters) << np.uint64(59)) | (mix(at.name) >> np.uint64(5))
        best = leftmost_best(key, lo[some], hi[some])
        name[todo[some]] = at.name[best] + np.uint64(depth)
        first[todo[some]] = at.first[best]
    return name, first


def stretches(words: list[list[bytes]], width: int = WIDTH):
    """All stretches of a few texts: text number, first window, windows less one, anchor, content."""
    lengths = np.array([len(w) for w in words])
    begins = np.concatenate([[0], np.cumsum(lengths + 1)])[:-1] + 1  # a separator before each text
    n = int(lengths.sum()) + len(words) + 1
    edge = np.zeros(n, bool)
    edge[np.append(begins - 1, n - 1)] = True
    flat = [w for text in words for w in text]
    names = np.zeros(n, np.uint64)
    names[~edge] = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    names[edge] = np.arange(int(edge.sum()), dtype=np.uint64) + np.uint64(1)
    spelled = np.zeros(n + 1, np.int64)
    spelled[1:][~edge] = np.fromiter(map(len, flat), np.int64, len(flat))
    spelled = np.cumsum(spelled)
    texts = np.flatnonzero(lengths >= width)
    if not len(texts):
        return [np.empty(0, np.int64)] * 5
    counts = lengths[texts] - width + 1
    jumps = np.concatenate([[0], np.cumsum(counts)])[:-1]
    starts = np.arange(int(counts.sum())) + np.repeat(begins[texts] - jumps, counts)
    owner = np.repeat(texts, counts)
    anchor, where = anchors(parse(names, edge), starts, spelled, width)
    new = np.flatnonzero(np.concatenate([[True], (where[1:] != where[:-1]) | (anchor[1:] != anchor[:-1])
                                         | (owner[1:] != owner[:-1])]))
    last = np.concatenate([new[1:], [len(starts)]]) - 1
    # the content of a stretch: a polynomial over its words' names, its length and the anchor's offset
    base = np.uint64(0x5851F42D4C957F2D)
    power = np.cumprod(np.full(n + 1, base))
    back = np.cumprod(np.full(n + 1, np.uint64(pow(int(base), -1, 1 << 64))))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(names * power[:n])])
    a, b = starts[new], starts[last] + width
    content = (total[b] - total[a]) * back[a]
    shape = ((where[new] - a) * 64 + (last - new)).astype(np.uint64)
    content = mix(content ^ mix(shape + np.uint64(1)))
    return owner[new], a - begins[owner[new]], last - new, anchor[new].view(np.int64), content.view(np.int64)


def first_of_equals(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (most important first) and where a new tuple of all but the last begins."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for k in keys[:-1]:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, new


class Combiner:
    """Holds a block of stretches; hands on the smallest document's of equal ones, and the others as known repeats."""

    def __init__(self):
        self.parts, self.rows = [], 0

    def add(self, columns) -> None:
        self.parts.append(columns)
        self.rows += len(columns[0])

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            return
        anchor, content, doc, tag, ref = (np.concatenate(c) for c in zip(*self.parts))
        self.parts, self.rows = [], 0
        order, new = first_of_equals(anchor, content, doc, tag, ref, np.arange(len(doc)))  # rows alike in id and text count once
        anchor, content, doc, tag, ref = (x[order[new]] for x in (anchor, content, doc, tag, ref))
        order, new = first_of_equals(anchor, content, doc)
        smallest = doc[order][np.flatnonzero(new)][np.cumsum(new) - 1]
        known = order[doc[order] > smallest]
        sent = order[doc[order] == smallest]
        yield record_batch(STRETCHES, (anchor[sent], content[sent], doc[sent], tag[sent], ref[sent]))
        yield known_repeats(doc[known], tag[known], ref[known])


def known_repeats(doc: np.ndarray, tag: np.ndarray, ref: np.ndarray) -> pa.RecordBatch:
    """Rows that need no company: dealt by their own hash, without content."""
    own = mix(ref.view(np.uint64) ^ mix(doc.view(np.uint64) ^ mix(tag.view(np.uint64)))).view(np.int64)
    return record_batch(STRETCHES, (own, pa.nulls(len(doc), pa.int64()), doc, tag, ref))


def find_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, tag, text) to stretches. Repeats of a stretch inside its own text are known at once."""
    held = Combiner()
    for batch in batches:
        texts = binary(batch.column(2))
        doc = batch.column(0).to_numpy(zero_copy_only=False)
        tag = batch.column(1).to_numpy(zero_copy_only=False)
        for lo, hi in slices(texts):
            owner, start, more, anchor, content = stretches([t.split() for t in texts[lo:hi]])
            if not len(owner):
                continue
            ref = (start << COUNT_BITS) | more
            own_doc, own_tag = doc[lo:hi][owner], tag[lo:hi][owner]
            order, new = first_of_equals(owner, anchor, content, start)
            later, first = order[~new], order[new]
            yield known_repeats(own_doc[later], own_tag[later], ref[later])
            held.add((anchor[first], content[first], own_doc[first], own_tag[first], ref[first]))
            if held.rows >= BLOCK:
                yield from held.flush()
    yield from held.flush()


VERDICTS = pa.schema([("doc", pa.int64()), ("tag", pa.int64()), ("ref", pa.int64()), ("verify", pa.bool_())])


def judge_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches sorted by (anchor, content, doc) to verdicts, with a few numbers of state."""
    last_anchor = last_content = smallest = None
    first_of_anchor, pending = False, None  # pending: a lone first document, not known yet to have company
    for batch in batches:
        if not batch.num_rows:
            continue
        known = np.asarray(batch.column(1).is_null())
        content = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
        anchor, doc, tag, ref = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 2, 3, 4))
        yield record_batch(VERDICTS, (doc[known], tag[known], ref[known], np.zeros(int(known.sum()), bool)))
        anchor, content, doc, tag, ref = (x[~known] for x in (anchor, content, doc, tag, ref))
        n = len(anchor)
        if not n:
            continue
        new_anchor, new_content = np.ones(n, bool), np.ones(n, bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new_anchor[0] = last_anchor is None or anchor[0] != last_anchor
        new_content[1:] = content[1:] != content[:-1]
        new_content[0] = new_anchor[0] or content[0] != last_content
        new_content |= new_anchor
        group = np.cumsum(new_content)  # 0: goes on from the batch before
        heads = np.concatenate([[smallest if smallest is not None else 0], doc[new_content]])
        anchor_first = np.concatenate([[first_of_anchor], new_anchor[new_content]])
        low, in_first = heads[group], anchor_first[group]
        repeat = doc > low
        lead = ~repeat
        # leads of an anchor's first content wait for a second content; ties are verified at once
        lone = lead & in_first & new_content
        verify = lead & ~lone
        ends = np.flatnonzero(new_content)
        follows = np.zeros(n, bool)  # a lone lead whose anchor has another content later in this batch
        next_group = np.searchsorted(ends, np.flatnonzero(lone), side="right")
        has_next = next_group < len(ends)
        at = np.flatnonzero(lone)
        follows[at[has_next]] = ~new_anchor[ends[next_group[has_next]]]
        out_doc, out_tag, out_ref = ([x[repeat], x[verify | follows]] for x in (doc, tag, ref))
        out_verify = [np.zeros(int(repeat.sum()), bool), np.ones(int((verify | follows).sum()), bool)]
        if pending is not None and len(ends):
            if not new_anchor[ends[0]]:
                for out, x in zip((out_doc, out_tag, out_ref), pending):
                    out.append(np.array([x]))
                out_verify.append(np.ones(1, bool))
            pending = None
        if len(at) and not has_next[-1]:
            pending = (doc[at[-1]], tag[at[-1]], ref[at[-1]])
        yield record_batch(VERDICTS, [np.concatenate(x) for x in (out_doc, out_tag, out_ref, out_verify)])
        last_anchor, last_content, smallest = anchor[-1], content[-1], low[-1]
        first_of_anchor = bool(in_first[-1])


def digest(words: list[bytes]) -> tuple[int, int]:
    both = xxhash.xxh3_128_intdigest(b" ".join(words))
    return (both >> 64) - (1 << 63), (both & ((1 << 64) - 1)) - (1 << 63)


def covered(n: int, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which of ``n`` words lie in one of the (start, end) spans."""
    steps = np.zeros(n + 1, np.int64)
    for a, b in spans:
        steps[a] += 1
        steps[b] -= 1
    return np.cumsum(steps[:n]) > 0


def kept_digest(words: list[bytes], gone: np.ndarray) -> tuple[int, int, str]:
    kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def unpack(ref: int) -> tuple[int, int]:
    """(first window, number of windows) of a stretch."""
    return ref >> COUNT_BITS, (ref & ((1 << COUNT_BITS) - 1)) + 1


WINDOW = pa.struct([("high", pa.int64()), ("low", pa.int64()), ("at", pa.int64())])
OPENED = pa.schema([
    ("doc_id", pa.int64()), ("doc", pa.int64()), ("tag", pa.int64()), ("text", pa.string()),
    ("gone", pa.list_(pa.int64())), ("windows", pa.list_(WINDOW)),
    ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept_text", pa.string()),
])


def open_documents(keep_text: bool, width: int = WIDTH):
    """Texts with their verdicts: finished where nothing is to verify, else with the digests of
    the windows in question (first of equals in the text; later ones are repeats)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = binary(batch.column(names.index("text")))
            known = batch.column(names.index("repeats")).to_pylist()
            asked = batch.column(names.index("verify")).to_pylist()
            ids, docs, tags = (batch.column(names.index(c)).to_pylist() for c in ("doc_id", "doc", "tag"))
            rows = []
            for i, text in enumerate(texts):
                words = (text or b"").split()
                gone, windows, seen = [], [], {}
                for ref in known[i] or ():
                    a, n = unpack(ref)
                    gone.append((a, a + n - 1 + width))
                for ref in sorted(asked[i] or (), key=unpack):
                    a, n = unpack(ref)
                    for p in range(a, a + n):
                        d = digest(words[p:p + width])
                        if seen.setdefault(d, p) == p:
                            windows.append({"high": d[0], "low": d[1], "at": p})
                        else:
                            gone.append((p, p + width))
                mask = covered(len(words), gone)
                if windows:
                    rows.append((ids[i], docs[i], tags[i], text, [x for s in gone for x in s], windows, None, None, None, None))
                else:
                    n, removed, sha = kept_digest(words, mask)
                    kept = kept_text(words, mask) if keep_text else None
                    rows.append((ids[i], docs[i], tags[i], None, None, None, n, removed, sha, kept))
            yield record_batch(OPENED, list(zip(*rows)) if rows else [[]] * len(OPENED))

    return run


def kept_text(words: list[bytes], gone: np.ndarray) -> bytes:
    return b" ".join(w for w, g in zip(words, gone.tolist()) if not g)


CLOSED = pa.schema([OPENED.field(c) for c in ("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text")])


def close_documents(keep_text: bool, width: int = WIDTH):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            texts = binary(batch.column(names.index("text")))
            ids, gone, found = (batch.column(names.index(c)).to_pylist() for c in ("doc_id", "gone", "found"))
            rows = []
            for i, text in enumerate(texts):
                words = text.split()
                g = gone[i]
                spans = list(zip(g[::2], g[1::2])) + [(p, p + width) for p in found[i] or ()]
                mask = covered(len(words), spans)
                rows.append((ids[i], *kept_digest(words, mask), kept_text(words, mask) if keep_text else None))
            yield record_batch(CLOSED, list(zip(*rows)) if rows else [[]] * len(CLOSED))

    return run


def ddl(schema: pa.Schema) -> str:
    kinds = {pa.int64(): "long", pa.string(): "string", pa.bool_(): "boolean"}

    def one(kind: pa.DataType) -> str:
        if pa.types.is_list(kind):
            return f"array<{one(kind.value_type)}>"
        if pa.types.is_struct(kind):
            return "struct<" + ", ".join(f"{f.name}: {one(f.type)}" for f in kind) + ">"
        return kinds[kind]

    return ", ".join(f"{f.name} {one(f.type)}" for f in schema)


def remove_repeats(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """Remove the words of every window of 20 words whose words also start earlier.

    ``docs`` needs ``doc_id`` and ``text``. Earlier means a smaller ``doc_id`` (null: after
    all others), or an earlier start in the same row; rows that share a ``doc_id`` are not
    earlier than one another. Null and empty texts have no words; texts of fewer than 20
    words stay whole. One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256
    (of the kept words, joined by one space) and, if asked for, kept_text.
    """
    # Rows are told apart by id, and by a hash of the text only where an id is repeated: the hash would double what a
    # stretch weighs, as nothing compresses it.
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    repeated = staged(docs.select(doc.alias("doc")).groupBy("doc").agg(F.count("*").alias("n")).filter("n > 1")
                      .select("doc", F.lit(True).alias("repeated")))
    keyed = (docs.select(F.col("doc_id").cast("long"), doc.alias("doc"), F.col("text").cast("string").alias("text"))
             .join(repeated, "doc", "left")
             .select("doc_id", "doc", F.when(F.col("repeated"), F.xxhash64("text")).otherwise(F.lit(0).cast("long")).alias("tag"), "text"))
    found = (keyed.filter(F.col("text").isNotNull()).select("doc", "tag", "text")
             .mapInArrow(find_stretches, ddl(STRETCHES)))
    verdicts = (found.repartition("anchor").sortWithinPartitions("anchor", "stretch", "doc")
                .mapInArrow(judge_stretches, ddl(VERDICTS)))
    per_text = (verdicts.groupBy("doc", "tag")
                .agg(F.collect_set(F.when(~F.col("verify"), F.col("ref"))).alias("repeats"),
                     F.collect_set(F.when(F.col("verify"), F.col("ref"))).alias("verify")))
    opened = staged_by(keyed.join(per_text, ["doc", "tag"], "left")
                       .select("doc_id", "doc", "tag", "text", "repeats", "verify")
                       .mapInArrow(open_documents(keep_text), ddl(OPENED)), "doc", "tag")
    done = opened.filter(F.col("windows").isNull()).select(*CLOSED.names)
    waiting = opened.filter(F.col("windows").isNotNull())
    asked = waiting.select("doc", "tag", F.explode("windows").alias("w")).select("doc", "tag", "w.high", "w.low", "w.at")
    owners = (asked.groupBy("high", "low").agg(F.min("doc").alias("smallest"), F.max("doc").alias("largest"))
              .filter("largest > smallest").select("high", "low", "smallest"))
    later = (asked.join(owners, ["high", "low"]).filter("doc > smallest")
             .groupBy("doc", "tag").agg(F.collect_set("at").alias("found")))
    closed = (waiting.select("doc_id", "doc", "tag", "text", "gone").join(later, ["doc", "tag"], "left")
              .select("doc_id", "text", "gone", "found").mapInArrow(close_documents(keep_text), ddl(CLOSED)))
    out = done.unionByName(closed)
    return out if keep_text else out.drop("kept_text")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


QUERIES = {"op1_substring_dedup": op1_substring_dedup}
ORACLE_SQL: dict[str, str] = {}
