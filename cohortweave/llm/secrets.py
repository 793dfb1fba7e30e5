"""Secret scans: patterns, and a battery of randomness tests, in built-in functions only.

Base spans come from patterns. The battery takes runs of at least ``LEAST`` letters, digits and encoding
signs that hold a letter and a digit, infers the encoding (hex, base32, lower-case, base64), maps characters
to their place in its alphabet, and tests that the places are random: chi-squared uniformity (with the exact
variance for short runs), runs below and above the middle, and serial correlation, combined
by Fisher's method. Random strings have uniform p-values, prose has small ones; by (encoding, length class) a
histogram of the corpus's distinct strings tells how many of those above a p-value are not random, and the
smallest p-value with an estimated false-discovery rate of at most ``FDR`` is the limit there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.llm.common import staged, table
from cohortweave.llm.quality_rules import let

# The base patterns; the group and the fewest characters that must match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 8

LEAST = 20
RUN = rf"[A-Za-z0-9+/_-]{{{LEAST},}}"
# The alphabets in code order.
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
LOWER36 = "0123456789abcdefghijklmnopqrstuvwxyz"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

#: Lower ends of the length classes.
LENGTHS = (20, 28, 36, 48, 64, 96)
FDR = 0.1
P_STEPS = 20


#: Matches and code points that one fold handles; what it appends to stays so small.
FOLD, TEXT_FOLD = 512, 16_384


def _before(lengths: Column) -> Column:
    """For each length the sum of those before it, in folds of ``FOLD``: a fold that appends to an array copies it each time."""
    def running(xs: Column, start: Column) -> Column:
        return F.aggregate(xs, F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")), lambda a, x: F.struct(
            (a["at"] + x).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")), lambda a: a["out"])

    def blocks(xs: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / FOLD).cast("int")), lambda b: F.slice(xs, b * FOLD + 1, F.lit(FOLD)))
        sums = F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, x: a + x))
        return let(F.struct(parts.alias("parts"), running(sums, F.lit(0)).alias("starts")), lambda p: F.flatten(
            F.zip_with(p["parts"], p["starts"], running)))

    return let(lengths, blocks)


def spans(text: Column, pattern: str, kind: int, value_group: int | None = None) -> Column:
    """The matches of ``pattern``, leftmost and not overlapping, as structs (start, kind, end, value) in
    code points; the places follow from the lengths of what lies between the matches."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group or 0))
    gaps = F.split(text, pattern, -1)

    def placed(parts: Column) -> Column:
        steps = F.zip_with(F.slice(parts["gaps"], F.lit(1), F.size(parts["whole"])), parts["whole"], lambda g, w: F.length(g) + F.length(w))
        rows = F.arrays_zip(_before(steps).alias("before"), parts["gaps"].alias("gap"), parts["whole"].alias("whole"), parts["value"].alias("value"))
        return F.transform(F.slice(rows, F.lit(1), F.size(parts["whole"])), lambda r: let(r["before"] + F.length(r["gap"]), lambda start: F.struct(
            start.alias("start"), F.lit(kind).alias("kind"), (start + F.length(r["whole"])).alias("end"), r["value"].alias("value"))))

    none = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    found = let(F.struct(whole.alias("whole"), value.alias("value"), gaps.alias("gaps")), placed)
    return F.when(text.rlike(pattern), found).otherwise(none)


def _tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, by the usual logistic fit."""
    z = F.least(F.abs(z), F.lit(12.0))
    return 2 / (1 + F.exp(1.5976 * z + 0.07056 * z * z * z))


def battery(places: Column, size: int) -> Column:
    """Fisher's combined p-value of the three tests for an array of places in an alphabet of ``size``."""
    half, middle, variance = size // 2, (size - 1) / 2, (size * size - 1) / 12

    def combined(x: Column) -> Column:
        n = F.size(x).cast("double")
        squares = F.aggregate(
            F.sort_array(x), F.struct(F.lit(-1).alias("last"), F.lit(0).alias("k"), F.lit(0.0).alias("s")),
            lambda a, v: let(F.when(v == a["last"], a["k"] + 1).otherwise(F.lit(1)), lambda k: F.struct(
                v.alias("last"), k.alias("k"), (a["s"] + 2 * k - 1).alias("s"))), lambda a: a["s"])
        chi = size / n * squares - n
        z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (1 - 1 / n))
        walk = F.aggregate(
            x, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("high"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("s")),
            lambda a, v: F.struct(
                v.alias("last"), (a["high"] + F.when(v >= half, 1.0).otherwise(0.0)).alias("high"),
                (a["runs"] + F.when((a["last"] < 0) | ((v >= half) != (a["last"] >= half)), 1.0).otherwise(0.0)).alias("runs"),
                (a["s"] + F.when(a["last"] < 0, 0.0).otherwise((v - middle) * (a["last"] - middle))).alias("s")))

        def tests(w: Column) -> Column:
            both = 2 * w["high"] * (n - w["high"])
            z_runs = F.when((both <= n), F.lit(12.0)).otherwise(
                (w["runs"] - 1 - both / n) / F.sqrt(both * (both - n) / (n * n * (n - 1))))
            z_serial = w["s"] / (variance * F.sqrt(n - 1))
            x2 = -2 * (F.log(_tail(z_chi)) + F.log(_tail(z_runs)) + F.log(_tail(z_serial)))
            return let(x2 / 2, lambda h: F.exp(-h) * (1 + h + h * h / 2))

        return let(walk, tests)

    return let(places, combined)


def _places(run: Column, alphabet: str) -> Column:
    return F.transform(F.split(run, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)


def encoding(run: Column) -> Column:
    """0 hex, 1 base32, 2 lower-case letters and digits, 3 base64; null: no letter or no digit."""
    return (F.when(~(run.rlike("[0-9]") & run.rlike("[A-Za-z]")), F.lit(None).cast("int"))
            .when(run.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 0).when(run.rlike("^[A-Z2-7]+$"), 1)
            .when(run.rlike("^[a-z0-9]+$"), 2).otherwise(3))


def random_runs(text: Column) -> Column:
    """Structs (start, end, encoding, class, p, hash of the value) of the runs whose encoding can be told."""
    def tested(run: Column) -> Column:
        v = run["value"]
        return let(encoding(v), lambda e: F.struct(
            run["start"].alias("start"), run["end"].alias("end"), e.alias("encoding"),
            F.lit(0) + sum((F.length(v) >= low).cast("int") for low in LENGTHS[1:]),
            F.when(e.isNull(), F.lit(0.0)).when(e == 0, battery(_places(F.lower(v), HEX_DIGITS), 16))
            .when(e == 1, battery(_places(v, BASE32), 32)).when(e == 2, battery(_places(v, LOWER36), 36))
            .otherwise(battery(_places(F.translate(v, "-_", "+/"), BASE64), 64)).alias("p"), F.xxhash64(v)))

    kind = "array<struct<start:int,end:int,encoding:int,class:int,p:double,own:bigint>>"
    return F.filter(F.transform(spans(text, RUN, 3), tested).cast(kind), lambda r: r["encoding"].isNotNull())


def scan(docs: DataFrame, *carried: str) -> DataFrame:
    """``base`` (structs start, kind, end by start, then kind) and ``runs`` of each text, with the
    carried columns. Null and empty texts have neither."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    assign = F.filter(spans(text, ASSIGN, 0, 2), lambda s: F.length(s["value"]) >= LEAST_VALUE)
    base = F.concat(assign, spans(text, ACCESS, 1), spans(text, HEX, 2))
    plain = F.sort_array(F.transform(base, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return docs.select(*carried, plain.alias("base"), random_runs(text).alias("runs"))


def limits(scanned: DataFrame) -> list[tuple[int, int, float]]:
    """(encoding, class, least p) where the estimated false-discovery rate is at most ``FDR``.

    Random runs have uniform p-values: twice the number above one half estimates how many there
    are; of the runs above a limit, the rest is false. Copies of a run are not independent: each distinct run counts
    once, and the limits hold for all its copies. At most 24 x 20 rows come to the driver.
    """
    step = F.least(F.floor(F.col("r.p") * P_STEPS), F.lit(P_STEPS - 1)).cast("int")
    counts: dict[tuple[int, int], list[int]] = {}
    for row in (scanned.select(F.explode("runs").alias("r"))
                .select(F.col("r.encoding").alias("e"), F.col("r.class").alias("c"), step.alias("s"), "r.own").distinct()
                .groupBy("e", "c", "s")
                .agg(F.count("*").alias("n")).collect()):
        counts.setdefault((row["e"], row["c"]), [0] * P_STEPS)[row["s"]] = row["n"]
    out = []
    for (e, c), n in sorted(counts.items()):
        random = 2 * sum(n[P_STEPS // 2:])
        for s in range(1, P_STEPS):
            above = sum(n[s:])
            if above and above - random * (1 - s / P_STEPS) <= FDR * above:
                out.append((e, c, s / P_STEPS))
                break
    return out


def with_spans(scanned: DataFrame, least: list[tuple[int, int, float]]) -> DataFrame:
    """``spans``: base spans and those of runs that pass their limit, by start, then kind."""
    def passes(r: Column) -> Column:
        out = F.lit(False)
        for e, c, p in least:
            out = out | ((r["encoding"] == e) & (r["class"] == c) & (r["p"] >= p))
        return out

    added = F.transform(F.filter("runs", passes), lambda r: F.struct(
        r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return scanned.withColumn("spans", F.sort_array(F.concat("base", added)))


def listed(column: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(column, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, found: Column, mask: str = "[secret]") -> Column:
    """``text`` with every union of overlapping spans (ascending by start) replaced by ``mask``. Texts are rewritten
    ``TEXT_FOLD`` code points at a time; a union has its mask where it begins."""
    def block(piece: Column, number: Column) -> Column:
        low = number * TEXT_FOLD
        here = F.filter(found, lambda s: (s["start"] < low + F.length(piece)) & (s["end"] > low))
        return F.when(F.size(here) == 0, piece).otherwise(F.aggregate(
            here, F.struct(F.lit("").alias("out"), low.alias("at")),
            lambda a, s: F.struct(
                F.when(s["start"] < a["at"], a["out"])
                .otherwise(F.concat(a["out"], F.substring(piece, a["at"] - low + 1, s["start"] - a["at"]), F.lit(mask))).alias("out"),
                F.greatest(a["at"], s["end"]).alias("at")),
            lambda a: F.concat(a["out"], F.substring(piece, a["at"] - low + 1, F.lit(TEXT_FOLD)))))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_FOLD}}}"), F.lit(0))
    return F.when(F.size(found) == 0, text).otherwise(F.array_join(F.transform(pieces, block), ""))


def find_secrets(docs: DataFrame, *carried: str) -> DataFrame:
    """``base``, ``runs`` and ``spans`` (kind: place in KINDS) per row of ``docs``, with the carried columns.
    Every row stays, repeated rows each for itself; null and empty texts have no spans; no rows give no rows. The scan runs once, staged without texts unless carried."""
    scanned = staged(scan(docs, *carried))
    return with_spans(scanned, limits(scanned))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"), "doc_id")

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
                        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES = {"op7_secret_scans": op7_secret_scans}
ORACLE_SQL: dict[str, str] = {}
