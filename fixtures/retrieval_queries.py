"""Document and vector queries, each with its DuckDB statement where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.operators import chunking, retrieval

K, CUT = 3, 0.2  # the test vectors are nearly orthogonal; the defaults would pass none


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector whose id is divisible by a hundred asks, against all vectors but itself."""
    vectors = _read(spark, sf, "embeddings")
    questions = vectors.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.topk(questions, vectors, K, CUT, skip_same_id=True)


def _contexts(spark: SparkSession, sf: str) -> DataFrame:
    texts = _read(spark, sf, "documents").withColumnRenamed("doc_id", "vec_id")
    return retrieval.assemble_context(_hits(spark, sf), texts)


def _upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Four documents in a row write to one id; the last wins. Other ids stay as they are."""
    existing = _read(spark, sf, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("payload"))
    incoming = _read(spark, sf, "documents").select(
        F.shiftright("doc_id", 2).alias("vec_id"), F.col("n_chars").alias("payload"), "doc_id")
    return retrieval.upsert(existing, incoming, "vec_id", "doc_id")


def _fixed(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk(_read(spark, sf, "documents"), by_separator=False)


_FIXED = """
SELECT doc_id, i AS chunk_no, substring(text, i * 850 + 1, 1000) AS text
FROM (SELECT doc_id, text, unnest(range(greatest(CAST(ceil((length(text) - 150) / 850.0) AS BIGINT), 1))) AS i
      FROM documents WHERE length(text) > 0)"""

_BLANKS = "||".join(f"chr({ord(c)})" for c in chunking.BLANKS)


def _separator_sql() -> str:
    """The separator chunker over sets: pieces with their places, where the chunk that begins at a piece ends and where
    the next one begins (both by ASOF joins on running lengths), then a walk from chunk to chunk."""
    parts = ["t0 AS (SELECT doc_id, text, CAST(0 AS BIGINT) AS base FROM documents WHERE text IS NOT NULL)"]
    for level, separator in enumerate((r"chr(10)||chr(10)", "chr(10)", "' '")):
        n = str(level)
        parts.append(f"""
cut{n} AS (SELECT doc_id, base, i, CASE WHEN i = 1 THEN part ELSE {separator}||part END AS piece FROM (
    SELECT doc_id, base, unnest(string_split(text, {separator})) AS part, generate_subscripts(string_split(text, {separator}), 1) AS i FROM t{n})),
piece{n} AS MATERIALIZED (SELECT *, length(piece) AS len, length(piece) >= 1000 AS long,
    base + CAST(coalesce(sum(length(piece)) OVER (PARTITION BY doc_id, base ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM cut{n} WHERE piece <> ''),
run{n} AS MATERIALIZED (SELECT doc_id, base, run, start, len, start + len AS finish, row_number() OVER (PARTITION BY doc_id, base, run ORDER BY start) AS k FROM (
    SELECT *, count(CASE WHEN long THEN 1 END) OVER (PARTITION BY doc_id, base ORDER BY start) AS run FROM piece{n}) WHERE NOT long),
filled{n} AS (SELECT a.doc_id, a.base, a.run, a.k, a.start, b.finish, b.k AS last
    FROM run{n} a ASOF JOIN run{n} b ON a.doc_id = b.doc_id AND a.base = b.base AND a.run = b.run AND a.start + 1000 >= b.finish),
onward{n} AS (SELECT f.*, CASE WHEN r.len IS NOT NULL THEN f.finish - least(150, 1000 - r.len) END AS floor
    FROM filled{n} f LEFT JOIN run{n} r ON r.doc_id = f.doc_id AND r.base = f.base AND r.run = f.run AND r.k = f.last + 1),
step{n} AS MATERIALIZED (SELECT o.*, r.k AS next
    FROM onward{n} o ASOF LEFT JOIN run{n} r ON r.doc_id = o.doc_id AND r.base = o.base AND r.run = o.run AND o.floor <= r.start),
walk{n}(doc_id, base, run, k, start, finish, next) AS (
    SELECT doc_id, base, run, k, start, finish, next FROM step{n} WHERE k = 1
    UNION ALL SELECT s.doc_id, s.base, s.run, s.k, s.start, s.finish, s.next FROM walk{n} w
    JOIN step{n} s ON s.doc_id = w.doc_id AND s.base = w.base AND s.run = w.run AND s.k = w.next),
t{level + 1} AS MATERIALIZED (SELECT doc_id, piece AS text, start AS base FROM piece{n} WHERE long)""")
    parts.append("""
letters AS (SELECT doc_id, base + 850 * i AS start, least(base + length(text), base + 850 * i + 1000) AS finish FROM (
    SELECT *, unnest(range(CAST(greatest(ceil((length(text) - 150) / 850.0), 1) AS BIGINT))) AS i FROM t3)),
spans AS (SELECT doc_id, start, finish FROM walk0 UNION ALL SELECT doc_id, start, finish FROM walk1
    UNION ALL SELECT doc_id, start, finish FROM walk2 UNION ALL SELECT doc_id, start, finish FROM letters)""")
    return f"""WITH RECURSIVE {','.join(parts)}
SELECT doc_id || ':' || chunk_no AS chunk_id, doc_id, chunk_no, chunk AS text FROM (
    SELECT doc_id, chunk, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1 AS INTEGER) AS chunk_no FROM (
        SELECT s.doc_id, s.start, trim(substring(d.text, s.start + 1, s.finish - s.start), {_BLANKS}) AS chunk
        FROM spans s JOIN documents d USING (doc_id)) WHERE chunk <> '')"""


_HITS = f"""
SELECT query_id, vec_id, score, rank FROM (
  SELECT q.vec_id AS query_id, v.vec_id, round(s.raw, 6) AS score,
         CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(s.raw, 6) DESC, v.vec_id) AS INTEGER) AS rank
  FROM embeddings q JOIN embeddings v ON v.vec_id <> q.vec_id,
       LATERAL (SELECT list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) AS raw) s
  WHERE q.vec_id % 100 = 0 AND s.raw >= {CUT})
WHERE rank <= {K}"""

_CONTEXT = f"""
SELECT query_id, string_agg(text, '' ORDER BY rank) AS context
FROM ({_HITS}) h JOIN documents d ON d.doc_id = h.vec_id GROUP BY query_id"""

_PROMPT = retrieval.PROMPT.replace("'", "''").split("{context}")

# name -> (query, SQL or None)
RETRIEVAL = {
    "r_chunk_fixed": (lambda spark, sf: chunking.explode_chunks(_fixed(spark, sf)), f"""
SELECT doc_id || ':' || chunk_no AS chunk_id, doc_id, CAST(chunk_no AS INTEGER) AS chunk_no, text FROM ({_FIXED})"""),
    "r_chunk_separator": (lambda spark, sf: chunking.explode_chunks(
        chunking.chunk(_read(spark, sf, "documents"))), _separator_sql()),
    "r_chunk_ids": (lambda spark, sf: chunking.with_chunk_id(_fixed(spark, sf)), f"""
SELECT 'id' || row_number() OVER (ORDER BY doc_id, chunk_no) AS chunk_id, doc_id,
       CAST(chunk_no AS INTEGER) AS chunk_no, text FROM ({_FIXED})"""),
    "r_upsert": (_upsert, """
SELECT vec_id, CAST(label AS BIGINT) AS payload FROM embeddings
WHERE vec_id NOT IN (SELECT doc_id // 4 FROM documents)
UNION ALL SELECT doc_id // 4, arg_max(n_chars, doc_id) FROM documents GROUP BY doc_id // 4"""),
    "r_topk": (_hits, _HITS),
    "r_assemble_context": (_contexts, _CONTEXT),
    "r_fill_prompt": (lambda spark, sf: retrieval.fill_prompt(_contexts(spark, sf)), f"""
SELECT *, '{_PROMPT[0]}' || coalesce(context, '') || '{_PROMPT[1]}' AS prompt FROM ({_CONTEXT})"""),
    "r_replay": (lambda spark, sf: retrieval.replay(_read(spark, sf, "conversations")),
                 "SELECT * FROM conversations WHERE role IN ('user', 'assistant')"),
}
