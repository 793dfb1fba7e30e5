"""Quality rules: a threshold table compiled into one Spark projection.

``measures`` holds what is counted in a text, as column expressions; ``RULES`` is the table: a ratio of
two measures (or a measure over 1), the least and the greatest value allowed. The table is
compiled into one struct column of built-in functions, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the languages at hand.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was", "with", "as", "by", "this",
    "der", "die", "das", "und", "ist", "von", "den", "mit", "ein", "nicht", "des", "dem",
    "de", "la", "le", "les", "et", "un", "une", "que", "en", "du", "pour", "est",
    "el", "los", "las", "y", "del", "una", "por", "con", "no", "se",
)


@dataclass(frozen=True)
class Rule:
    """``above / below`` (0 over an empty text) must lie in [low, high]; None: no bound."""

    name: str
    above: str
    below: str | None = None
    low: float | None = None
    high: float | None = None

    def broken(self, measure: Column) -> Column:
        value = measure[self.above].cast("double")
        if self.below:
            value = F.when(measure[self.below] > 0, value / measure[self.below]).otherwise(F.lit(0.0))
        out = F.lit(False)
        if self.low is not None:
            out = out | (value < self.low)
        if self.high is not None:
            out = out | (value > self.high)
        return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over one evaluation of ``value``, however often it is used and wherever the
    optimizer moves the whole: the lambda's variable is never inlined."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: The first two are the base rules.
BASE = (
    Rule("words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", "n_words", high=0.5),
)
RULES = (
    *BASE,
    Rule("word_length", "word_chars", "n_words", low=2, high=16),
    Rule("symbols", "n_symbols", "n_words", high=0.2),
    Rule("shouts", "n_shouts", "n_words", high=0.2),
    Rule("stop_words", "n_stop_words", "n_words", low=0.03),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=0.5),
)


#: Up to so many different repeated windows are looked up one by one; more are found by sorting windows with their places.
FEW = 64


def covered(places: Column) -> Column:
    """The size of the union of three words from each of the ascending ``places`` on."""
    return F.aggregate(
        places, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])


def repeated_words(w: Column) -> Column:
    """The words in windows of three found twice or more. Windows are hashed (64 bits) and sorted; a hash equal
    to its neighbour is a repeated one; the places of these are picked and their union summed."""
    steps = F.sequence(F.lit(0), F.size(w) - 3)
    hashes = F.transform(steps, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def sorted_places(h: Column) -> Column:
        def again(s: Column) -> Column:
            return F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                            | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.sort_array(F.transform(let(pairs, again), lambda x: x["i"]))

    def count(h: Column) -> Column:
        repeated = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1))))
        return let(repeated, lambda r: F.when(F.size(r) == 0, F.lit(0).cast("long")).otherwise(covered(
            F.when(F.size(r) <= FEW, F.filter(steps, lambda i: F.array_contains(r, F.get(h, i))))
            .otherwise(sorted_places(h)))))

    return F.when(F.size(w) < 3, F.lit(0).cast("long")).otherwise(let(hashes, count))


def measures(text: Column) -> Column:
    """A struct of what is counted in a text that is not null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def number_of(chars: str) -> Column:
        return F.regexp_count(text, F.lit(f"[{chars}]")).cast("long")

    return let(words, lambda w: let(lines, lambda ls: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        number_of(SYMBOLS).alias("n_symbols"),
        number_of("!").alias("n_shouts"),
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"))))


MEASURES = ("n_words", "word_chars", "n_symbols", "n_shouts", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words")


def verdict(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """A struct: the measures of ``text``, ``base_failed``, ``broken`` (names of rules) and ``kept``."""
    def judged(m: Column) -> Column:
        base = F.lit(False)
        for r in BASE:
            base = base | r.broken(m)
        broken = F.array_compact(F.array(*[F.when(r.broken(m), F.lit(r.name)) for r in rules]))
        return let(base, lambda b: let(broken, lambda x: F.struct(
            *[m[c].alias(c) for c in MEASURES], b.alias("base_failed"), x.alias("broken"),
            (~b & (F.size(x) == 0)).alias("kept"))))

    return let(measures(F.coalesce(text.cast("string"), F.lit(""))), judged)


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, ``base_failed``, ``kept`` and ``broken`` (names of the rules broken) per row of ``docs``.

    Every row stays, repeated rows as well; columns of ``docs`` with such names are replaced. A null or
    empty text has no words and fails the base rules.
    """
    return docs.withColumn("_verdict", verdict(F.col("text"), rules)).withColumns(
        {c: F.col("_verdict")[c] for c in (*MEASURES, "base_failed", "broken", "kept")}).drop("_verdict")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                              "base_failed", "kept")


QUERIES = {"op9_quality_rules": op9_quality_rules}

MEASURES_SQL = r"""
words AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM words WHERE len(ws) >= 3)),
again AS (SELECT doc_id, win FROM windows GROUP BY doc_id, win HAVING count(*) > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT w.doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows w JOIN again a ON w.doc_id = a.doc_id AND w.win = a.win)
  GROUP BY doc_id),
measured AS (
  SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(t, '[^!]', '', 'g')) AS BIGINT) AS n_shouts,
         CAST(len(ls) AS BIGINT) AS n_lines,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
         len(list_filter(ws, lambda x: list_contains([STOPS], x))) AS n_stop_words
  FROM words w LEFT JOIN repeated r ON w.doc_id = r.doc_id),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
""".replace("STOPS", ", ".join(f"'{w}'" for w in STOP_WORDS)).strip()

KEPT_SQL = """NOT base_failed AND word_chars >= 2 * n_words AND word_chars <= 16 * n_words
         AND n_symbols <= 0.2 * n_words AND n_shouts <= 0.2 * n_words AND n_stop_words >= 0.03 * n_words
         AND n_dup_lines <= 0.5 * n_lines"""

ORACLE_SQL = {"op9_quality_rules": f"""
WITH {MEASURES_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       {KEPT_SQL} AS kept
FROM judged
"""}
