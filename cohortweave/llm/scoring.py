"""Language-model scoring by prediction by partial matching (PPM) over bytes, pretrained on the corpus.

Counting: each task counts its byte runs of ``ORDER + 1`` (A-Z lower-cased, ``ORDER`` start marks before and one
end mark after each text); Spark sums them and derives the shorter contexts from them. Every context is kept, as a row
with the counts of the symbols after it.

Scoring: a byte is coded in the longest context known. A symbol seen there has probability n / (T + D), T its total
and D its distinct symbols (escape method C); otherwise the escape D / (T + D) is paid and the next shorter context
is asked, *without* the symbols seen in the longer one (exclusion), at last a uniform choice among the
bytes never seen. The probabilities of the 256 symbols sum to one in each context. So the probability of a
byte follows from its run alone: it is found once for each distinct run of all texts, by joins with the contexts. The
runs that occur most often are broadcast (at most ``LIKELY``), the others are joined by shuffle, counted by text.

The unigram baseline needs the count of every word: frequent words are broadcast (at most
``FREQUENT``), the others are joined by shuffle.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import binary, mix, record_batch, slices, staged, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 5
#: Runs and words that are broadcast.
LIKELY = 2_000_000
FREQUENT = 150_000
MARK = 0xFF  # no byte of UTF-8: the start and end of a text
SYMBOLS = 256
END = " "  # the end token's key among words, none of which has a space
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
HELD_KEYS = 2_000_000
HELD_WORDS = 1_000_000
SLICE = 1_500_000
STEPS = 4  # of a histogram's bin per doubling


def text_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and end mark its run of ``ORDER + 1`` bytes (the symbol lowest), and where texts begin."""
    pad = bytes([MARK])
    joined = np.frombuffer(b"".join(pad * ORDER + t + pad for t in texts), np.uint8)
    lengths = np.array([len(t) + 1 for t in texts])
    begins = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    coded = np.ones(len(joined), bool)
    heads = begins + ORDER * np.arange(len(texts))
    for j in range(ORDER):
        coded[heads + j] = False
    key = joined.astype(np.uint64)
    out = key.copy()
    for j in range(1, ORDER + 1):
        out[j:] |= key[:-j] << np.uint64(8 * j)
    return out[coded], begins


RUNS = pa.schema([("key", pa.int64()), ("n", pa.int64())])


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def summed():
        keys, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
        return keys, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

    for batch in batches:
        texts = [(t or b"").translate(LOWER) for t in binary(batch.column(0))]
        for lo, hi in slices(texts, SLICE):
            held.append(np.unique(text_keys(texts[lo:hi])[0], return_counts=True))
            if sum(len(k) for k, _ in held) > HELD_KEYS:
                held = [summed()]
                if len(held[0][0]) > HELD_KEYS // 2:
                    yield record_batch(RUNS, (held[0][0].view(np.int64), held[0][1]))
                    held = []
    if held:
        keys, n = summed()
        yield record_batch(RUNS, (keys.view(np.int64), n))


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
    held: Counter = Counter()
    for batch in batches:
        for text in binary(batch.column(0)):
            held.update((text or b"").translate(LOWER).split())
        held[END.encode()] += batch.num_rows
        if len(held) > HELD_WORDS:
            yield record_batch(schema, (list(held), list(held.values())))
            held = Counter()
    if held:
        yield record_batch(schema, (list(held), list(held.values())))


class Index:
    """An open-addressing table from unsigned longs to their place in ``keys``."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys) + 1).bit_length() + 1)
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        todo, slot = np.arange(len(keys)), self.home(keys)
        while len(todo):
            free = self.slots[slot] < 0
            _, first = np.unique(slot[free], return_index=True)
            taken = np.flatnonzero(free)[first]
            self.slots[slot[taken]] = todo[taken]
            left = np.ones(len(todo), bool)
            left[taken] = False
            todo, slot = todo[left], (slot[left] + 1) & (len(self.slots) - 1)

    def home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        slot = self.home(keys)
        at = self.slots[slot]
        if not len(self.keys):
            return at
        open_ = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & (len(self.slots) - 1)
            at[open_] = self.slots[slot[open_]]
            open_ = open_[(at[open_] >= 0) & (self.keys[at[open_]] != keys[open_])]
        return at


class Trie:
    """The model in one process, as ``log_runs`` has it in tables: contexts of 0 to ORDER bytes. ``tables[k]`` has runs
    of k + 1 bytes and their counts, for whole contexts."""

    def __init__(self, tables: list[tuple[np.ndarray, np.ndarray]]):
        self.entries, self.contexts = [], []
        self.count_log, self.total_log, self.escape_log, self.rest_log, self.rest_escape_log = [], [], [], [], []
        below = None
        for k, (keys, n) in enumerate(tables):
            order = np.argsort(keys)
            keys, n = keys[order], n[order].astype(np.float64)
            context, at = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.bincount(at, n, len(context))
            distinct = np.bincount(at, minlength=len(context)).astype(np.float64)
            self.entries.append(Index(keys))
            self.contexts.append(Index(context))
            with np.errstate(divide="ignore"):
                self.count_log.append(np.log(n))
                self.total_log.append(np.log(total + distinct))
                self.escape_log.append(np.log(distinct / (total + distinct)))
                if k:
                    # what the next shorter context has left without the symbols seen here
                    mask = np.uint64((1 << (8 * k)) - 1)
                    low = self.entries[k - 1].find(keys & mask)
                    parent = self.contexts[k - 1].find((context & (mask >> np.uint64(8))) if k > 1 else np.zeros(len(context), np.uint64))
                    rest = below[1][parent] - np.bincount(at, below[0][low], len(context))
                    left = below[2][parent] - distinct
                    self.rest_log.append(np.log(rest + left))
                    self.rest_escape_log.append(np.where(left > 0, np.log(left / np.maximum(rest + left, 1)), 0.0))
                else:
                    self.rest_log.append(None), self.rest_escape_log.append(None)
            below = n, total, distinct
        self.unseen_log = math.log(max(1, SYMBOLS - (int(below is not None and len(self.entries[0].keys)))))
        top = self.contexts[ORDER].find(self.entries[ORDER].keys >> np.uint64(8))
        self.direct = self.count_log[ORDER] - self.total_log[ORDER][top]

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """Natural log probability of each run's last byte after the bytes before it."""
        at = self.entries[ORDER].find(keys)
        if len(self.direct):
            out = np.where(at >= 0, self.direct[at], 0.0)
        else:
            out = np.zeros(len(keys))
        todo = np.flatnonzero(at < 0)
        longer = np.full(len(todo), -1)  # the context escaped from, in the order above
        for k in range(ORDER, -1, -1):
            if not len(todo):
                break
            run = keys[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            context = self.contexts[k].find(run >> np.uint64(8))
            known = context >= 0
            entry = self.entries[k].find(run) if k < ORDER else np.full(len(todo), -1)
            came = known & (longer >= 0)
            seen = known & (entry >= 0)
            base = np.zeros(len(todo))
            first = known & ~came
            base[first] = self.total_log[k][context[first]]
            if k < ORDER:
                base[came] = self.rest_log[k + 1][longer[came]]
            out[todo[seen]] += self.count_log[k][entry[seen]] - base[seen]
            escaped = known & ~seen
            out[todo[escaped & first]] += self.escape_log[k][context[escaped & first]]
            if k < ORDER:
                out[todo[escaped & came]] += self.rest_escape_log[k + 1][longer[escaped & came]]
            todo, longer = todo[~seen], np.where(known, context, -1)[~seen]
        out[todo] -= self.unseen_log
        return out


def most_frequent(rows: DataFrame, total: str, most: int, weight: str | None = None) -> float:
    """The least total such that rows of that total or more are at most ``most`` (weighted)."""
    step = F.floor(F.log2(F.col(total).cast("double")) * STEPS).cast("int")
    bins = rows.groupBy(step.alias("s")).agg((F.sum(weight) if weight else F.count("*")).alias("n")).collect()  # 64 x STEPS
    held, least = 0, math.inf
    for r in sorted(bins, key=lambda r: -r["s"]):
        held += r["n"]
        if held > most:
            break
        least = 2 ** (r["s"] / STEPS)
    return least * (1 - 1e-9)


def log_runs(texts: DataFrame) -> DataFrame:
    """key, times, log: every distinct run of ``texts`` (text, not null; held_out), how often it occurs, and the decimal
    log probability of its last byte by the texts that are not held out."""
    held, symbol = F.coalesce("held_out", F.lit(True)), F.col("key").bitwiseAND(255).cast("int")
    learnt, asked = (texts.filter(c).select("text").mapInArrow(count_runs, "key long, n long") for c in (~held, held))
    none = F.lit(0).cast("long")
    runs = staged(learnt.withColumn("m", none).unionByName(asked.select("key", none.alias("n"), F.col("n").alias("m")))
                  .groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m")))
    context, size = F.shiftrightunsigned("key", 8), F.col("total") + F.col("distinct")
    # the longest contexts with their runs, those that are held out only among them
    tops = (runs.groupBy(context.alias("context"))
            .agg(F.collect_list(F.struct("key", "n", "m")).alias("runs"), F.sum("n").alias("total"),
                 F.sum((F.col("n") > 0).cast("long")).alias("distinct")))
    gone = F.transform(F.filter("runs", lambda r: r["n"] > 0), lambda r: r["key"].bitwiseAND(255).cast("int"))
    first = staged(tops.withColumn("gone", F.when(F.exists("runs", lambda r: r["n"] == 0), gone))
                   .select(F.explode("runs").alias("r"), "total", "distinct", "gone")
                   .select("r.key", (F.col("r.n") + F.col("r.m")).alias("times"), (F.col("r.n") > 0).alias("done"),
                           F.when(F.col("r.n") > 0, F.log10("r.n") - F.log10(size))
                           .when(F.col("distinct") > 0, F.log10("distinct") - F.log10(size)).otherwise(0.0).alias("log"),
                           F.when(F.col("r.n") == 0, F.col("gone")).alias("gone")))
    found, open_, at = first.filter("done"), first.filter("NOT done"), runs.filter("n > 0").select("key", "n")
    for k in range(ORDER - 1, -1, -1):
        at = staged(at.withColumn("key", F.col("key").bitwiseAND((1 << (8 * (k + 1))) - 1)).groupBy("key").agg(F.sum("n").alias("n")))
        level = (at.groupBy(context.alias("context"))
                 .agg(F.map_from_entries(F.collect_list(F.struct(symbol, "n"))).alias("seen"),
                      F.sum("n").alias("total"), F.count("*").alias("distinct")))
        # at most 256 contexts of one byte: a shuffle would deal the runs by their last byte but one
        level = F.broadcast(level) if k < 2 else level
        met = (open_.withColumn("context", context.bitwiseAND((1 << (8 * k)) - 1)).join(level, "context", "left")
               .withColumn("known", F.col("seen").isNotNull() & ~F.col("done"))
               # without the symbols seen in the longer context
               .withColumn("left", F.col("distinct") - F.size("gone"))
               .withColumn("whole", F.col("left") + F.col("total") - F.aggregate("gone", none, lambda a, s: a + F.col("seen")[s]))
               .withColumn("n", F.col("seen")[symbol]))
        hit = F.col("known") & F.col("n").isNotNull()
        more = (F.when(hit, F.log10("n") - F.log10("whole"))
                .when(F.col("known") & (F.col("left") > 0), F.log10("left") - F.log10("whole")).otherwise(0.0))
        open_ = met.select("key", "times", (F.col("done") | hit).alias("done"), (F.col("log") + more).alias("log"),
                           F.when(F.col("known") & ~hit, F.map_keys("seen")).otherwise(F.col("gone")).alias("gone"))
    unseen = F.when(F.col("done"), 0.0).otherwise(F.log10(F.greatest(SYMBOLS - F.size("gone"), F.lit(1))))
    return staged(found.select("key", "times", "log").unionByName(open_.select("key", "times", (F.col("log") - unseen).alias("log"))))


SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                    ("base_score", pa.float64()), ("score", pa.float64()),
                    ("rare", pa.list_(pa.struct([("word", pa.string()), ("times", pa.int64())]))),
                    ("runs", pa.list_(pa.struct([("key", pa.int64()), ("times", pa.int64())])))])
SCORED_DDL = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, "
              "rare array<struct<word: string, times: long>>, runs array<struct<key: long, times: long>>")


def runs_by_text(keys: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    """The keys of each of ``n`` texts and how often they occur in it."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(keys)))
    runs = pa.StructArray.from_arrays([pa.array(keys[first].view(np.int64)), pa.array(times, pa.int64())],
                                      fields=list(SCORED.field("runs").type.value_type))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner[first], np.arange(n + 1)), pa.int32()), runs)


def score_texts(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, log_of, frequent = shared.value  # a 0 at the end of log_of, for those not found
        for batch in batches:
            texts = [(t or b"").translate(LOWER) for t in binary(batch.column(2))]
            for lo, hi in slices(texts, SLICE):
                keys, begins = text_keys(texts[lo:hi])
                at = index.find(keys)
                score = np.add.reduceat(log_of[at], begins)
                other_runs = np.flatnonzero(at < 0)
                owner = np.searchsorted(begins, other_runs, side="right") - 1
                n_tokens, n_known, base, rare = [], [], [], []
                for t in texts[lo:hi]:
                    words = t.split()
                    words.append(END.encode())
                    logs = list(map(frequent.get, words))
                    other = Counter(w for w, x in zip(words, logs) if x is None)
                    known = [x for x in logs if x is not None]
                    n_tokens.append(len(words)), n_known.append(len(known)), base.append(math.fsum(known))
                    rare.append([{"word": w, "times": n} for w, n in other.items()])
                n = hi - lo
                yield record_batch(SCORED, (batch.column(0).slice(lo, n), batch.column(1).slice(lo, n),
                                            n_tokens, n_known, base, score, rare,
                                            runs_by_text(keys[other_runs], owner, n)))

    return run


def score(docs: DataFrame, held_out: Column, likely: int = LIKELY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs`` (doc_id, text).

    Learns from the rows that are not held out. Null texts are empty: one token, the end. With nothing to learn
    from, the model is uniform over the 256 symbols and no token is known.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    learnt = rows.filter(~F.col("held_out"))
    words = staged(learnt.select("text").mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    sums = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    total, below = sums["n"], sums["n"] + 0.5 * (sums["v"] + 1)
    cut = most_frequent(words, "n", FREQUENT)
    frequent = {r["word"].encode(): math.log10((r["n"] + 0.5) / below)
                for r in words.filter(F.col("n") >= cut).toLocalIterator()}  # at most FREQUENT
    logs = log_runs(rows)
    least = most_frequent(logs, "times", likely)
    got = logs.filter(F.col("times") >= least).select("key", "log").toArrow()  # at most likely
    shared = spark.sparkContext.broadcast((Index(got["key"].to_numpy().view(np.uint64)), np.append(got["log"].to_numpy(), 0.0), frequent))
    scored = staged(rows.mapInArrow(score_texts(shared), SCORED_DDL).withColumn("uid", F.monotonically_increasing_id()))
    n = F.coalesce("n", F.lit(0))
    rare = (scored.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.times")
            .join(words.filter(F.col("n") < cut), "word", "left")
            .select("uid", (F.col("times") * F.log10((n + 0.5) / below)).alias("more"),
                    F.when(n > 0, F.col("times")).otherwise(0).alias("known"), F.lit(0.0).alias("rest")))
    other = (scored.select("uid", F.explode("runs").alias("r")).select("uid", "r.key", F.col("r.times").alias("here"))
             .join(logs.filter(F.col("times") < least), "key")
             .select("uid", F.lit(0.0).alias("more"), F.lit(0).cast("long").alias("known"), (F.col("here") * F.col("log")).alias("rest")))
    more = (rare.unionByName(other).groupBy("uid")
            .agg(F.sum("more").alias("more"), F.sum("known").alias("known"), F.sum("rest").alias("rest")))
    return scored.drop("rare", "runs").join(more, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("rest", F.lit(0.0))).alias("score"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 1
    return score(table(spark, sf_dir, "documents"), held_out)


QUERIES = {"op5_lm_scoring": op5_lm_scoring}
ORACLE_SQL: dict[str, str] = {}
