"""A training corpus in five stages: quality rules, near duplicates, benchmark decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as a Parquet
table in the shared folder and reads it back as the next stage's ``docs``. All but the last
return the columns of ``documents`` (further columns of ``docs`` are carried on).

Nulls: a null text fails the quality rules; null metadata are kept. Repeated rows are near duplicates of one another.
No rows give no rows in every stage.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm import decontamination, jaccard_join, packing, quality_rules, secrets
from cohortweave.llm.common import TEXT_ROWS, binary, staged, table

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """``docs`` with a new text, and ``n_chars`` following it where there is that column."""
    out = docs.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)


def _packed(docs: DataFrame) -> DataFrame:
    """id, own (a hash of the text) and the whole row in one column, so that no name of ``docs`` can clash."""
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("own"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that break no rule."""
    return docs.filter(quality_rules.verdict(F.col("text"))["kept"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near duplicates, that of the smallest doc_id (ties: of the smallest
    hash of the text, then any of rows that are alike); rows without words are classes of their own."""
    found = staged(jaccard_join.join_classes(docs)).filter("n_links > 0")
    first = (found.filter("doc_id <=> class_id").groupBy("class_root").agg(F.min("row").alias("first")))
    doomed = (found.join(first, "class_root").filter("NOT (doc_id <=> class_id AND row = first)")
              .select(F.col("doc_id").alias("_id"), F.col("row").alias("_row")).distinct())
    rows = _packed(docs)
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_row"))
    rest = rows.join(doomed, same, "left_anti")
    # rows alike in doc_id and text are one another's copies, too: one stays
    alike = found.filter("doc_id <=> class_id").groupBy("doc_id", "row").agg(F.count("*").alias("n")).filter("n > 1")
    if not alike.isEmpty():
        words = F.coalesce(F.length(F.btrim("row.text", F.lit(quality_rules.SPACES))) > 0, F.lit(False))
        rest = rest.filter(words).dropDuplicates(["id", "own"]).unionByName(rest.filter(~words))
    return rest.select("row.*")


def _cut_spans(names: list[str]):
    """(row, spans): remove the words of the spans from the row's text and what stands between them."""
    def run(batches):
        for batch in batches:
            columns, spans = batch.column(0).flatten(), batch.column(1).to_pylist()
            at = names.index("text")
            out = [decontamination.without_words(t, s) if s else t for t, s in zip(binary(columns[at]), spans)]
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _cut_hits(shared, at: int):
    """Remove the words of hit windows from the text at column ``at`` and what stands between them."""
    def run(batches):
        windows = decontamination.built(shared.value)
        for batch in batches:
            out = [None if t is None else decontamination.without_hits(t, windows) for t in binary(batch.column(at))]
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return run


def cut_benchmark(docs: DataFrame, benchmark: DataFrame, block: int = decontamination.BLOCK_WINDOWS) -> DataFrame:
    """``docs`` without the words of benchmark windows. Of several blocks of windows, all are looked for in the unchanged
    texts, and the union of their hits is cut once."""
    at = docs.columns.index("text")
    blocks = [docs.sparkSession.sparkContext.broadcast(w)
              for w in decontamination.window_blocks(benchmark, block)]
    if len(blocks) == 1:
        return docs.mapInArrow(_cut_hits(blocks[0], at), docs.schema)
    spans = decontamination.hit_spans(docs, blocks)
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_row"))
    return (_packed(docs).join(spans.toDF("_id", "_row", "_spans"), same, "left").select("row", "_spans")
            .mapInArrow(_cut_spans(docs.columns), docs.schema))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every occurrence of a benchmark window out of the texts; a document with nothing left goes."""
    out = cut_benchmark(docs, table(spark, sf_dir, "benchmark"))
    kept = out.filter(F.length(F.btrim("text", F.lit(quality_rules.SPACES))) > 0)
    return _with_text(kept, F.col("text"), docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mask."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    found = secrets.find_secrets(docs.select(others, F.col("text")), "row", "text")
    masked = found.select("row", secrets.redacted(F.col("text"), F.col("spans")).alias("masked"))
    return _with_text(masked.select("row.*", F.col("masked").alias("text")), F.col("text"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the tokenized documents with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality),
    ("jaccard_join", near_duplicates),
    ("decontamination", decontaminate),
    ("secret_scans", mask_secrets),
    ("packing", pack),
]

#: Packing needs the tokenizer, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), TEXT_ROWS)
    return STAGES[-1][1](spark, docs, sf_dir)
