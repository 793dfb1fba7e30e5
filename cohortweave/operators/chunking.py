"""Overlapping text chunks, and their numbering."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from cohortweave.operators.sequence import sequence_within

CHUNK_SIZE, CHUNK_OVERLAP = 1000, 150

# Places to cut, best first (paragraph, line, blank, anywhere).
SEPARATORS = ("\n\n", "\n", " ", "")

#: What counts as blank at the edges of a chunk.
BLANKS = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _stepped(text: Column, size: int, overlap: int) -> Column:
    """Chunks of ``size`` characters, each starting ``size - overlap`` after the last; the
    final one ends with the text. Empty text has none.

    The text is cut once into pieces as long as a step, and a chunk is a piece with the
    beginning of what follows, so the work is linear in the text.
    """
    step = size - overlap
    reach = -(-size // step)  # pieces a chunk reaches into

    def joined(cut: Column) -> Column:
        following = [F.slice(cut, F.lit(i + 1), F.greatest(F.size(cut) - i, F.lit(0))) for i in range(reach)]
        return F.transform(F.arrays_zip(*[f.alias(f"p{i}") for i, f in enumerate(following)]), lambda z: F.left(
            F.concat(*[F.coalesce(z[f"p{i}"], F.lit("")) for i in range(reach)]), F.lit(size)))

    count = F.greatest(F.ceil((F.length(text) - overlap) / F.lit(step)), F.lit(1)).cast("int")
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    whole = F.element_at(F.transform(F.array(pieces), joined), 1)  # the lambda binds the pieces, which are cut once
    return F.when(F.length(text) > 0, F.slice(whole, F.lit(1), count)).otherwise(F.array().cast("array<string>"))


def fixed_chunks(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> DataFrame:
    """``doc_id`` and chunks of ``size`` characters, each starting ``size - overlap`` after the last."""
    return documents.select("doc_id", _stepped(F.col("text"), size, overlap).alias("chunks"))


def _filled(pieces: Column, size: int, overlap: int, finer: Callable[[Column], Column]) -> Column:
    """Chunks of consecutive pieces: a piece of ``size`` or more is cut further by ``finer``, shorter ones are
    joined up to ``size``, and a new chunk keeps up to ``overlap`` characters worth of the last one's last pieces.

    One fold over the pieces; its state is the chunks so far, the pieces of the chunk being filled and their length.
    """
    none = F.array().cast("array<string>")

    def state(out: Column, window: Column, held: Column) -> Column:
        return F.struct(out.alias("out"), window.alias("window"), held.alias("held"))

    def flushed(s: Column) -> Column:
        return F.when(F.size(s["window"]) > 0, F.array(F.array_join(s["window"], ""))).otherwise(none)

    def started(s: Column, piece: Column) -> Column:
        """The chunk is full: hand it on and begin the next with the last pieces that still fit."""
        room = F.least(F.lit(overlap), F.lit(size) - F.length(piece))

        def keep(k: Column, x: Column) -> Column:
            fits = k["open"] & (k["held"] + F.length(x) <= room)
            return F.when(fits, F.struct(F.concat(F.array(x), k["window"]).alias("window"), (k["held"] + F.length(x)).alias("held"),
                                         F.lit(True).alias("open"))).otherwise(
                F.struct(k["window"].alias("window"), k["held"].alias("held"), F.lit(False).alias("open")))

        nothing = F.struct(none.alias("window"), F.lit(0).alias("held"), F.lit(True).alias("open"))
        return F.aggregate(F.reverse(s["window"]), nothing, keep, lambda k: state(
            F.concat(s["out"], flushed(s)), F.concat(k["window"], F.array(piece)), k["held"] + F.length(piece)))

    def step(s: Column, piece: Column) -> Column:
        n = F.length(piece)
        return (F.when(n >= size, state(F.concat(s["out"], flushed(s), finer(piece)), none, F.lit(0)))
                .when((F.size(s["window"]) > 0) & (s["held"] + n > size), started(s, piece))
                .otherwise(state(s["out"], F.concat(s["window"], F.array(piece)), s["held"] + n)))

    return F.aggregate(pieces, state(none, none, F.lit(0)), step, lambda s: F.concat(s["out"], flushed(s)))


def _cut(text: Column, separators: Sequence[str], size: int, overlap: int) -> Column:
    """``text`` cut at the first separator, over-long pieces at the next ones; every piece after the first begins
    with its separator. (A text without the separator is one piece, so the best separator present is found on the way.)"""
    separator, *finer = separators
    if not separator:
        return _stepped(text, size, overlap)
    parts = F.transform(F.split(text, f"\\Q{separator}\\E", -1), lambda x, i: F.when(i == 0, x).otherwise(F.concat(F.lit(separator), x)))
    last = (lambda piece: _cut(piece, finer, size, overlap)) if finer else (lambda piece: F.array(piece))
    return _filled(F.filter(parts, lambda x: x != ""), size, overlap, last)


def separator_chunks(text: Column, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
                     separators: Sequence[str] = SEPARATORS) -> Column:
    """Separator-aware chunks of whole texts, blank edges trimmed and blank chunks left out; no text, no chunks.
    The levels of separators are unrolled into nested folds of built-in functions."""
    trimmed = F.transform(_cut(text, separators, size, overlap), lambda c: F.btrim(c, F.lit(BLANKS)))
    return F.coalesce(F.filter(trimmed, lambda c: c != ""), F.array().cast("array<string>"))


def chunk(documents: DataFrame, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
          by_separator: bool = True) -> DataFrame:
    """``doc_id``, and all chunks of the document as one array."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be smaller than the chunk size")
    if not by_separator:
        return fixed_chunks(documents, size, overlap)
    return documents.select("doc_id", separator_chunks(F.col("text"), size, overlap).alias("chunks"))


def explode_chunks(packed: DataFrame) -> DataFrame:
    """(chunk_id, doc_id, chunk_no, text) with ids scoped to the document: no shuffle."""
    return packed.select("doc_id", F.posexplode("chunks").alias("chunk_no", "text")).select(
        F.concat_ws(":", "doc_id", "chunk_no").alias("chunk_id"), "doc_id", "chunk_no", "text")


def with_chunk_id(packed: DataFrame) -> DataFrame:
    """Chunks numbered ``id1``, ``id2``, ... over the whole corpus, in the order of
    numeric document ids, else in a fixed order by hash.

    Documents are numbered, not chunks; they are cut once (into a staged table), and no task holds more than its part.
    """
    place = F.col("doc_id") if isinstance(packed.schema["doc_id"].dataType, NumericType) else F.xxhash64("doc_id")
    numbered = sequence_within(packed, keys=[], order=[place, "doc_id"], before={"chunks_before": F.size("chunks")})
    return numbered.select(
        "doc_id", "chunks_before", F.posexplode("chunks").alias("chunk_no", "text")).select(
        F.concat(F.lit("id"), F.col("chunks_before") + F.col("chunk_no") + 1).alias("chunk_id"),
        "doc_id", "chunk_no", "text")
