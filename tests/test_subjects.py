"""Subject resolution against a row-by-row walk."""

import random

import pytest
from pyspark.sql import functions as F

from cohortweave.operators import subjects as subject_rules
from cohortweave.operators.load import build_linkage
from cohortweave.operators.subjects import attach_subject_key, resolve_subjects
from cohortweave.sources import store
from tests.helpers import rows, subjects

SCHEMA = "source_study string, studyid string, subjid string, record_id string, scrno string, seen long"


def walk(data, registered=()):
    """The sequential rule: subjid, else record_id, else scrno, else a new participant."""
    held, keys, out = {}, len(registered), {}
    people = []
    for key, study, ids in registered:
        for kind, value in enumerate(ids):
            if value:
                held[study, kind, value] = key
    for study, studyid, *ids, seen in sorted(data, key=lambda r: (r[0], r[-1])):
        ids = [i or None for i in ids]
        if not any(ids):
            continue
        key = next((held[study, kind, v] for kind, v in enumerate(ids)
                    if v and (study, kind, v) in held), None)
        if key is None:
            keys += 1
            key = keys
            people.append((key, study, studyid, *ids))
            held.update({(study, kind, v): key for kind, v in enumerate(ids) if v})
        out.setdefault((study, *ids), key)
    return people, out


@pytest.mark.parametrize("seed", range(4))
def test_equals_sequential_walk(spark, seed):
    rng = random.Random(seed)

    def maybe(prefix, n):
        return rng.choice([None, "", f"{prefix}{rng.randint(1, n)}", f"{prefix}{rng.randint(1, n)}"])

    data = [(rng.choice(["STUDY_A", "STUDY_C"]), f"p{i}", maybe("s", 12), maybe("r", 12), maybe("x", 9), i)
            for i in range(150)]
    result = resolve_subjects(spark.createDataFrame(data, SCHEMA), "seen")
    people, assigned = walk(data)
    assert rows(result.subjects, "subject_key", "source_study", "studyid", "subjid", "record_id", "scrno") == \
        sorted(people, key=repr)
    got = {tuple(r)[:-1]: r.subject_key for r in result.assigned.select(
        "source_study", "subjid", "record_id", "scrno", "subject_key").collect()}
    assert got == assigned


def test_named_cases(spark):
    data = [
        ("STUDY_A", "A", None, None, "X1", 0), ("STUDY_A", "A", "S1", None, "X1", 1),   # scrno first
        ("STUDY_C", "C", None, "R1", None, 2),                                           # record_id only
        ("STUDY_A", "A", None, None, "", 3),                                             # nothing usable
        ("STUDY_A", "A", "S2", None, "X9", 4), ("STUDY_A", "A", "S3", None, "X9", 5),    # shared scrno
    ]
    result = resolve_subjects(spark.createDataFrame(data, SCHEMA), "seen")
    assert rows(result.subjects, "subject_key", "subjid", "record_id", "scrno") == [
        (1, None, None, "X1"), (2, "S2", None, "X9"), (3, None, "R1", None)]
    assert result.rejected.count() == 1
    keyed = attach_subject_key(spark.createDataFrame(data, SCHEMA), result.assigned)
    assert rows(keyed, "seen", "subject_key") == [(0, 1), (1, 1), (2, 3), (4, 2), (5, 2)]


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    """Each sighting shares an identifier with the one before only: 64 links, a logarithm of staged tables."""
    data = [("STUDY_A", "A", f"s{i // 2}", f"r{(i + 1) // 2}", None, i) for i in range(1, 65)]
    data += [("STUDY_B", "B", f"h{i}", None, "HOT", i) for i in range(40)]  # one identifier on a third of all rows
    data += [("STUDY_C", "C", f"s{i % 7}", f"r{i % 5}", f"x{i % 3}", i) for i in range(30)]
    staged = []
    monkeypatch.setattr(subject_rules, "cut_lineage", lambda df: staged.append(1) or store.cut_lineage(df))
    result = resolve_subjects(spark.createDataFrame(data, SCHEMA).repartition(3), "seen")
    people, assigned = walk(data)
    assert rows(result.subjects, "subject_key", "source_study", "studyid", "subjid", "record_id", "scrno") == people
    got = {tuple(r)[:-1]: r.subject_key for r in result.assigned.select("source_study", *subject_rules.IDS, "subject_key").collect()}
    assert got == assigned and len(staged) < 20


def test_rejects_need_no_resolution(spark):
    data = [("STUDY_A", "A", None, "", None, 3), ("STUDY_A", "A", None, None, "", 1), ("STUDY_A", "A", "s", None, None, 2)]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(subject_rules.rejected_sightings(df, "seen"), "seen", "n_rows") == [(1, 2)]
    assert rows(resolve_subjects(df, "seen").rejected, "seen", "n_rows") == [(1, 2)]


def test_late_registration_does_not_reach_back(spark):
    """A sighting is settled by what was registered before it."""
    data = [("STUDY_A", None, None, None, "X", 0), ("STUDY_A", None, "S", None, "X", 1),
            ("STUDY_A", None, "S", None, "Y", 2)]
    people, assigned = walk(data)
    result = resolve_subjects(spark.createDataFrame(data, SCHEMA), "seen")
    assert len(people) == 2 and result.subjects.count() == 2
    assert rows(result.assigned, "subjid", "scrno", "subject_key") == sorted(
        [(k[1], k[3], v) for k, v in assigned.items()], key=repr)


def test_existing_subjects_keep_their_keys(spark):
    existing = subjects(spark, dict(subject_key=7, subjid="S1", scrno="X1"))
    data = [("STUDY_A", "A", "S1", None, None, 0), ("STUDY_A", "A", None, None, "X1", 1),
            ("STUDY_A", "A", "S9", None, None, 2)]
    result = resolve_subjects(spark.createDataFrame(data, SCHEMA), "seen", existing)
    assert rows(result.assigned, "subjid", "subject_key") == [("S1", 7), ("S9", 8), (None, 7)]
    assert result.subjects.count() == 2


def test_linkage_pairs(spark):
    people = subjects(
        spark, dict(subject_key=1, subjid="A1"), dict(subject_key=2, source_study="STUDY_C", subjid="C1"))
    named = [("r1", "STUDY_A_subjid", "A1"), ("r1", "study_c_subjid", "C1"), ("r1", "link_status", "exact"),
             ("r2", "study_a_subjid", "A1"), ("r2", "study_c_subjid", "C1"), ("r2", "link_status", "again"),
             ("r3", "study_a_subjid", "gone"), ("r4", "study_a_subjid", "gone too")]
    eav = spark.createDataFrame([(r, v, x, i) for i, (r, v, x) in enumerate(named)],
                                "record_id string, source_var string, value string, row_id long")
    assert rows(build_linkage(eav, people)) == [(1, 1, 2, "exact"), (2, None, None, None), (3, None, None, None)]
    stored = build_linkage(eav, people).withColumn("linkage_id", F.col("linkage_id") + 4).where("study_a_subject_key = 1")
    assert rows(build_linkage(eav, people, stored)) == [(6, None, None, None), (7, None, None, None)]
