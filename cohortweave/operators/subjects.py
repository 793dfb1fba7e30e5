"""Participants from partial identifiers.

A sighting carries some of ``subjid``, ``record_id`` and ``scrno``. In order of
appearance, a sighting belongs to the registered participant holding its subjid, else
its record_id, else its scrno, and registers a new participant (with exactly its own
identifiers) when none of them is held. Done one row at a time that is a loop; here it
is a few set-based rounds. In each, a sighting that comes first for all of its identifiers
registers; one that has a single other sighting before it registers exactly if that one does
not, and such chains are followed by pointer jumping, in steps that double; then what shares an identifier
with a new participant is settled.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortweave.functions.text import blank_to_null
from cohortweave.operators.sequence import sequence_within
from cohortweave.sources.store import cut_lineage, shared_folder

IDS = ["subjid", "record_id", "scrno"]  # order of precedence
SIGHTING = ["source_study", "seen"]


class Resolution(NamedTuple):
    subjects: DataFrame   # every participant, earlier ones included
    assigned: DataFrame   # source_study and identifiers -> subject_key
    rejected: DataFrame   # sightings without any identifier, and how many rows each stands for


def distinct_sightings(rows: DataFrame, seen: str) -> DataFrame:
    """One row per identifier combination: its first appearance, that row's studyid, and its rows."""
    clean = rows.select(
        "source_study", F.col("studyid").cast("string").alias("studyid"),
        *[blank_to_null(F.col(c).cast("string")).alias(c) for c in IDS],
        F.col(seen).cast("bigint").alias("seen"))
    return clean.groupBy("source_study", *IDS).agg(
        F.min_by("studyid", "seen").alias("studyid"), F.min("seen").alias("seen"),
        F.count("*").alias("n_rows"))


def _held_ids(df: DataFrame, *columns: str) -> DataFrame:
    """(study, kind, id) rows; kind is the rank of precedence."""
    kinds = F.array(*[
        F.struct(F.lit(rank).alias("kind"), F.col(c).alias("id")) for rank, c in enumerate(IDS)])
    return df.select("source_study", *columns, F.inline(kinds)).where(F.col("id").isNotNull())


ID_KEY = ["source_study", "kind", "id"]


def _unsettled(open_: DataFrame, claims: DataFrame) -> DataFrame:
    """Sightings none of whose identifiers is among ``claims``."""
    settled = _held_ids(open_, "seen").join(claims, ID_KEY, "left_semi").select(*SIGHTING)
    return open_.join(settled, SIGHTING, "left_anti")


def _waiting(open_: DataFrame) -> DataFrame:
    """(study, seen, ``waits``): null for a sighting that comes first for all of its identifiers; the one open sighting before
    it where there is just one; sightings with several before them are left out. Only the two
    earliest sightings of an identifier are needed, so one that very many carry is two minima, combined before they are shuffled."""
    held = _held_ids(open_, "seen")
    first = held.groupBy(*ID_KEY).agg(F.min("seen").alias("first"))
    placed = held.join(first, ID_KEY)
    second = placed.where("seen > first").groupBy(*ID_KEY).agg(F.min("seen").alias("second"))
    behind = F.when(F.col("seen") > F.col("first"), F.col("first"))
    return placed.join(second, ID_KEY, "left").groupBy(*SIGHTING).agg(
        F.min(behind).alias("waits"), F.max(behind).alias("also"),
        F.bool_or(F.col("seen") > F.col("second")).alias("many"),
    ).where("NOT coalesce(many, false) AND waits <=> also").select(*SIGHTING, "waits")


def _settled_chains(waiting: DataFrame) -> DataFrame:
    """The sightings of ``waiting`` that register, as far as their chains begin with one that comes first.

    ``turns`` counts the steps from a sighting to the one it points at; each round points twice as far.
    """
    chain = waiting.where("waits IS NOT NULL").select(*SIGHTING, "waits", F.lit(1).cast("bigint").alias("turns"))
    first = waiting.where("waits IS NULL").select(*SIGHTING)
    while True:
        onward = chain.select("source_study", F.col("seen").alias("waits"), F.col("waits").alias("beyond"), F.col("turns").alias("more"))
        step = chain.join(onward, ["source_study", "waits"], "left")
        moved = cut_lineage(step.select(
            *SIGHTING, F.coalesce("beyond", "waits").alias("waits"), (F.col("turns") + F.coalesce("more", F.lit(0))).alias("turns"),
            F.col("beyond").isNotNull().alias("moved")))
        chain = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    heads = first.withColumnRenamed("seen", "waits")
    return first.unionByName(chain.where("turns % 2 = 0").join(heads, ["source_study", "waits"], "left_semi").select(*SIGHTING))


def _registrations(sightings: DataFrame, claimed: DataFrame | None) -> DataFrame:
    """Sightings that register a participant, by rounds until none is left open; all rounds in one staged folder."""
    spark = sightings.sparkSession
    folder = f"{shared_folder(spark)}/registered-{uuid.uuid4().hex}"
    sightings.limit(0).write.parquet(f"{folder}/round=0")
    open_ = sightings if claimed is None else cut_lineage(_unsettled(sightings, claimed))
    round_ = 0
    while not open_.isEmpty():
        round_ += 1
        path = f"{folder}/round={round_}"
        open_.join(_settled_chains(cut_lineage(_waiting(open_))), SIGHTING, "left_semi").write.parquet(path)
        new = spark.read.schema(sightings.schema).parquet(path)
        open_ = cut_lineage(_unsettled(open_, _held_ids(new).select(*ID_KEY)))
    return spark.read.schema(sightings.schema).parquet(folder).select(*sightings.columns)


def _nameless() -> Column:
    nameless = F.lit(True)
    for c in IDS:
        nameless = nameless & F.col(c).isNull()
    return nameless


def rejected_sightings(rows: DataFrame, seen: str) -> DataFrame:
    """Sightings without any identifier, and how many rows each stands for; participants need not be resolved for that."""
    return distinct_sightings(rows, seen).where(_nameless())


def resolve_subjects(rows: DataFrame, seen: str, existing: DataFrame | None = None) -> Resolution:
    """Assign every identifier combination in ``rows`` a participant.

    ``seen`` names a column that is unique within a study and orders the rows. Keys are
    serial numbers in order of registration, following those of ``existing``.
    """
    sightings = cut_lineage(distinct_sightings(rows, seen))
    rejected, named = sightings.where(_nameless()), sightings.where(~_nameless())

    claimed, last_key = None, 0
    if existing is not None:
        claimed = _held_ids(existing).distinct()
        last_key = existing.agg(F.max("subject_key")).first()[0] or 0
    registered = cut_lineage(sequence_within(
        _registrations(named, claimed), keys=[],
        order=["source_study", "seen"],
        before={"earlier": F.lit(1)},
    ).withColumn("subject_key", F.col("earlier") + 1 + last_key).drop("earlier"))

    columns = ["subject_key", "source_study", "studyid", "subjid", "scrno", "record_id"]
    holders = _held_ids(registered, "subject_key", "seen")
    subjects = registered.select(*columns)
    if existing is not None:
        subjects = existing.select(*columns).unionByName(subjects)
        holders = holders.unionByName(_held_ids(
            existing.withColumn("seen", F.lit(-1).cast("bigint")), "subject_key", "seen"))

    # A participant counts only if it was registered by the time of the sighting.
    wanted = _held_ids(named, "seen")
    match = wanted.join(
        holders.withColumnRenamed("seen", "registered"), ["source_study", "kind", "id"]
    ).where(F.col("registered") <= F.col("seen"))
    keys = match.groupBy(*SIGHTING).agg(
        F.min_by("subject_key", F.struct("kind", "subject_key")).alias("subject_key"))
    assigned = named.join(keys, SIGHTING).select("source_study", *IDS, "subject_key")
    return Resolution(subjects, assigned, rejected)


def attach_subject_key(rows: DataFrame, assigned: DataFrame) -> DataFrame:
    """Add ``subject_key`` to rows by their identifier combination (nulls match nulls)."""
    ids = F.struct("source_study", *[blank_to_null(F.col(c).cast("string")).alias(c) for c in IDS])
    keyed = assigned.select(F.struct("source_study", *IDS).alias("_ids"), "subject_key")
    return rows.withColumn("_ids", ids).join(keyed, "_ids").drop("_ids")
