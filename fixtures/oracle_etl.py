"""DuckDB statements for the unpivoting and loading queries."""

from __future__ import annotations

from fixtures.wide_data import duck_form_ctes

# (form table, form name, ids, visit expression, [(order, variable, label, column, ie sequence)])
_A_AE = (
    ("a_ae", "AE", "visit_num", [
        (1, "AETERM", "Reported term", "aeterm", 0), (2, "AESTDTC", "Start date", "aestdt", 0),
        (3, "AESEV", "Severity", "aesev", 0), (4, "AESER", "Serious", "aeser", 0)]),
    ("a_sae", "SAE", "visit", [
        (1, "AETERM", "Reported term", "saeterm", 0), (2, "AELLT", "Lowest level term", "saeterm", 0),
        (3, "AESTDTC", "Start date", "saedt", 0)]),
)
_A_IE = (("a_ie", "IE", "visit_num", [
    (1, "IEORRES", "Eligible", "ieorres", 5),
    (2, "SUPPIE", "Screening Failure Reason", "iesfreason", 7),
    (3, "SUPPIE", "Eligibility Reason", "ieeligreason", 8)]),)
_B_MH = (("b_mh", "MH", "visitnum", [
    (1, "MHTERM", "Condition", "mhterm", 0), (2, "MHSTDTC", "Onset", "mhdat", 0)]),)
_B_IE = (("b_ie", "IE", "CAST(NULL AS VARCHAR)", [
    (1, "IETESTCD", "Inclusion 1", "in1", 1), (2, "IECAT", "Inclusion 1 category", "in1cat", 1),
    (3, "IETESTCD", "Inclusion 2", "in2", 2), (4, "IETESTCD", "Exclusion 1", "ex1", 3),
    (5, "IECAT", "Exclusion 1 category", "ex1cat", 3), (6, "IETESTCD", "Exclusion 10", "ex10", 4),
    (7, "IEDTC", "Date", "iedat", 5)]),)
_B_DM = (("b_dm", "DM", "CAST(NULL AS VARCHAR)", [(1, "SEX", "Sex", "sex", 0)]),)


def _cells(domain: str, forms, scrno: str) -> str:
    parts = []
    for form_no, (table, form, visit, mapping) in enumerate(forms, start=1):
        for order, var, label, column, ie in mapping:
            parts.append(
                f"SELECT '{domain}' AS domain, {form_no} AS form_no, '{form}' AS source_form,"
                f" source_row_number AS r, studyid, subjid, {scrno} AS scrno, {visit} AS visitnum,"
                f" {order} AS o, '{var}' AS standard_var, '{label}' AS standard_label,"
                f" '{column}' AS source_var, {column} AS value, {ie} AS ie FROM {table}"
                f" WHERE {column} IS NOT NULL AND {column} <> ''")
    return "\nUNION ALL\n".join(parts)


def _unpivoted(domains, scrno: str) -> str:
    cells = "\nUNION ALL\n".join(_cells(d, forms, scrno) for d, forms in domains)
    return f"""
WITH cells AS ({cells}),
events AS (
  SELECT *, row_number() OVER (PARTITION BY domain, subjid
           ORDER BY TRY_CAST(visitnum AS DOUBLE) NULLS LAST, source_form, r) AS seq
  FROM (SELECT DISTINCT domain, subjid, source_form, r, visitnum FROM cells))
SELECT row_number() OVER (PARTITION BY domain ORDER BY form_no, r, o) AS row_id,
       studyid, c.subjid, scrno, domain, standard_var, standard_label, value, source_form, source_var,
       c.visitnum, CAST(CASE WHEN domain = 'IE' THEN ie ELSE seq END AS INTEGER) AS seqnum
FROM cells c JOIN events e USING (domain, source_form, r)"""


UNPIVOT_A = _unpivoted((("AE", _A_AE), ("IE", _A_IE)), "scrno")
UNPIVOT_B = _unpivoted((("MH", _B_MH), ("IE", _B_IE), ("DM", _B_DM)), "CAST(NULL AS VARCHAR)")

_VISITS = ", ".join(
    f"('{spelling.format(n)}', {n})" for n in (1, 2, 3)
    for spelling in ("visit_{}_arm_1", "visit{}_arm_1", "visit{}arm1"))

PARTICIPANT_ROWS = f"""
WITH seen AS (
  SELECT m.*, v.visitnum, nullif(m.subjid, '') AS own
  FROM c_main m LEFT JOIN (VALUES {_VISITS}) v(label, visitnum) ON v.label = lower(trim(m.redcap_event_name)))
SELECT * REPLACE (coalesce(
         own,
         last_value(own IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         first_value(own IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS subjid),
       CAST(row_number() OVER w AS INTEGER) AS seqnum
FROM seen
WINDOW w AS (PARTITION BY record_id ORDER BY visitnum NULLS LAST, source_row_number)"""

_FIELDS = "record_id AS record_id, subjid, visitnum, seqnum"
#: Slot numbers of the STUDY_C columns, and one more than the greatest.
_C_SLOTS = {"mhq": 0, "cmtrt": 1, "peres1": 8, "peres2": 9, "peres3": 10, "vsyn": 20, "vsreasnd": 21,
            "vsorres1": 22, "vsorres2": 23, "vsorres3": 24, "vsorres4": 25, "vsorres5": 26}
_C_LIMIT = 27
_NONE = "CAST(NULL AS VARCHAR)"


def _c_row(domain, var, label, value, form, column, where, *, code=_NONE, desc=_NONE, sig=_NONE,
           vsnd=_NONE, status=_NONE):
    return (f"SELECT {_FIELDS}, source_row_number * {_C_LIMIT} + {_C_SLOTS[column]} + 1 AS row_id, '{domain}' AS domain, '{var}' AS standard_var, {label} AS standard_label,"
            f" {value} AS value, {code} AS value_code, {desc} AS pedesc, {sig} AS peclsig, {vsnd} AS vsnd,"
            f" '{form}' AS source_form, '{column}' AS source_var, {status} AS match_status"
            f" FROM numbered WHERE {where}")


def _present(column: str) -> str:
    return f"{column} IS NOT NULL AND {column} <> ''"


def _pe_rows():
    for i in (1, 2, 3):
        decoded = (f"CASE peres{i} WHEN '1' THEN 'Normal' WHEN '2' THEN 'Abnormal'"
                   f" WHEN '9' THEN 'Not assessed' ELSE 'UNMAPPED_CODE_' || peres{i} END")
        yield _c_row("PE", "PEORRES", f"trim(petest{i})", decoded,
                     "exam" if i == 2 else "physical_examination", f"peres{i}",
                     f"{_present(f'petest{i}')} AND {_present(f'peres{i}')}",
                     code=f"peres{i}", desc=f"pedesc{i}", sig=f"peclsig{i}",
                     status="'position_label_from_petest'")


def _vs_rows():
    yield _c_row("VS", "VSPERF", "'Vital signs taken'", "vsyn", "vitals", "vsyn", _present("vsyn"))
    yield _c_row("VS", "VSREASND", "'If No, Reason for Not Done'", "vsreasnd", "vital_signs",
                 "vsreasnd", _present("vsreasnd"))
    for i, label, form in (
        (1, "Body height", "vitals"), (2, "Weight (kg)", "vitals"),
        (3, "Heart Rate (beats/minute)", "vital_signs"),
        (4, "Respiratory Rate (breaths/minute)", "vital_signs"),
        (5, "Body Temperature (Celsius)", "vital_signs"),
    ):
        yield _c_row("VS", "VSORRES", f"'{label}'", f"vsorres{i}", form, f"vsorres{i}",
                     _present(f"vsorres{i}"), vsnd=f"vsnd{i}___9", status="'position_label_confirmed'")


def _c_statement(rows) -> str:
    return f"WITH numbered AS ({PARTICIPANT_ROWS})\n" + "\nUNION ALL\n".join(rows)


UNPIVOT_C = _c_statement([
    _c_row("MH", "MHTERM", "'Condition'", "mhq", "history", "mhq", _present("mhq")),
    _c_row("CM", "CMTRT", "'Medication'", "cmtrt", "meds", "cmtrt", _present("cmtrt")),
    *_pe_rows(), *_vs_rows()])

# (place in the form's mapping, column, domain, variable, label)
_LINK = ((0, "study_c_record_id", "DM", "DMSPID", "STUDY_C Record ID"),
         (1, "study_c_subjid", "DM", "SUBJID", "STUDY_C Subject ID"),
         (2, "study_a_subjid", "DM", "SUBJID", "STUDY_A Subject ID"),
         (3, "pre_id", "DM", "SUPPDM", "Previous Subject Identifier"),
         (4, "link_status", "DM", "SUPPDM", "Link Status"),
         (6, "first_enrollment_visit", "SV", "VISIT", "Visit of First Enrollment"))

MANUAL = "\nUNION ALL\n".join(
    f"SELECT source_row_number * 7 + {o} + 1 AS row_id, 1 AS seqnum, CAST(NULL AS INTEGER) AS visitnum, STUDY_C_subjid AS subjid,"
    f" STUDY_C_record_id AS record_id, '{d}' AS domain, '{v}' AS standard_var, '{label}' AS standard_label,"
    f" {c} AS value, 'STUDY_A_STUDY_C_linkage' AS source_form, '{c}' AS source_var"
    f" FROM linkage WHERE {_present(c)}" for o, c, d, v, label in _LINK)

_PAIRS = """
SELECT a.subject_key AS study_a_subject_key, c.subject_key AS study_c_subject_key,
       nullif(link_status, '') AS linkage_type, study_c_record_id AS record_id
FROM linkage l
LEFT JOIN {subjects} a ON a.source_study = 'STUDY_A' AND a.subjid = l.STUDY_A_subjid
LEFT JOIN {subjects} c ON c.source_study = 'STUDY_C' AND c.subjid = l.STUDY_C_subjid"""
LINKAGE = f"""
SELECT row_number() OVER (ORDER BY record_id) AS linkage_id, study_a_subject_key, study_c_subject_key, linkage_type
FROM ({_PAIRS.replace('{subjects}', 'subjects')})"""

# Pairs of odd records are stored first; of them, those with an unknown side are not known again.
LINKAGE_STORED = f"""
WITH pairs AS ({_PAIRS.replace('{subjects}', 'subjects')}),
one AS (SELECT row_number() OVER (ORDER BY record_id) AS linkage_id, * FROM pairs WHERE CAST(record_id AS BIGINT) % 2 = 1),
two AS (SELECT (SELECT max(linkage_id) FROM one) + row_number() OVER (ORDER BY record_id) AS linkage_id, * FROM pairs
        WHERE CAST(record_id AS BIGINT) % 2 = 0 OR study_a_subject_key IS NULL OR study_c_subject_key IS NULL)
SELECT linkage_id, study_a_subject_key, study_c_subject_key, linkage_type FROM (FROM one UNION ALL FROM two)"""

# Sightings in order, one family (customers sharing a screening number) at a time: an
# identifier list grows only when a sighting finds none of its own on it.
_WALK = """
WITH RECURSIVE combos AS (
  SELECT source_study, family, subjid, nullif(scrno, '') AS scr, record_id, min(seen) AS seen,
         arg_min(studyid, seen) AS studyid
  FROM sightings GROUP BY source_study, family, subjid, scr, record_id),
steps AS (
  SELECT *, list_filter(['s' || subjid, 'r' || record_id, 'x' || scr], lambda x: x IS NOT NULL) AS ids,
         row_number() OVER (PARTITION BY family ORDER BY seen) AS i
  FROM combos WHERE subjid IS NOT NULL OR scr IS NOT NULL OR record_id IS NOT NULL),
walk AS (
  SELECT family, i, seen AS holder,
         list_transform(ids, lambda x: {'id': x, 'holder': seen}) AS known
  FROM steps WHERE i = 1
  UNION ALL
  SELECT family, i, coalesce(found, seen) AS holder,
         CASE WHEN found IS NULL THEN list_concat(known, list_transform(ids, lambda x: {'id': x, 'holder': seen}))
              ELSE known END
  FROM (SELECT t.family, t.i, t.seen, t.ids, w.known,
               list_filter(list_transform(t.ids, lambda x: list_extract(
                   list_filter(w.known, lambda y: y.id = x), 1).holder), lambda z: z IS NOT NULL)[1] AS found
        FROM walk w JOIN steps t ON t.family = w.family AND t.i = w.i + 1)),
keys AS (
  SELECT s.family, s.seen, row_number() OVER (ORDER BY source_study, s.seen) AS subject_key,
         source_study, studyid, subjid, scr AS scrno, record_id
  FROM steps s JOIN walk w ON w.family = s.family AND w.i = s.i AND w.holder = s.seen)"""

RESOLVED_SUBJECTS = _WALK + """
SELECT subject_key, source_study, studyid, subjid, scrno, record_id FROM keys"""

ASSIGNED = _WALK + """
SELECT s.source_study, s.subjid, s.record_id, s.scr AS scrno, k.subject_key
FROM steps s JOIN walk w ON w.family = s.family AND w.i = s.i
JOIN keys k ON k.family = s.family AND k.seen = w.holder"""

REJECTED = """
SELECT source_study, min(seen) AS seen, arg_min(studyid, seen) AS studyid, count(*) > 0 AS rejected
FROM sightings
WHERE subjid IS NULL AND record_id IS NULL AND nullif(scrno, '') IS NULL
GROUP BY source_study"""

REJECTED_ROWS = """
SELECT source_study, count(*) AS n_rows FROM sightings
WHERE coalesce(subjid, record_id, nullif(scrno, '')) IS NULL GROUP BY source_study"""

# Participants appear by study, then by the place of the first sheet that names them, then by row.
_PEOPLE = f"""
a AS ({UNPIVOT_A}), b AS ({UNPIVOT_B}), c AS ({UNPIVOT_C}),
people AS (
  SELECT source_study, id, subjid, row_number() OVER (ORDER BY source_study, place) AS k FROM (
    SELECT 'STUDY_A' AS source_study, scrno AS id, min(subjid) AS subjid, min(source_row_number) AS place FROM a_ie GROUP BY scrno
    UNION ALL SELECT 'STUDY_B', subjid, subjid, min(source_row_number) FROM b_dm GROUP BY subjid
    UNION ALL SELECT 'STUDY_C', record_id, min(subjid),
      min(row_id + CASE domain WHEN 'MH' THEN 1 WHEN 'PE' THEN 2 WHEN 'VS' THEN 3 ELSE 4 END * 72057594037927936) FROM c GROUP BY record_id))"""

LOADED_FACTS = f"""
WITH {_PEOPLE}
SELECT lower(domain) AS domain, 72057594037927936 + row_id AS fact_id, k AS subject_key,
       'STUDY_A' AS source_study, standard_var, standard_label, value, {_NONE} AS value_code, seqnum,
       CAST(visitnum AS DOUBLE) AS visitnum
FROM a JOIN people ON id = scrno AND source_study = 'STUDY_A'
UNION ALL
SELECT lower(domain), 2 * 72057594037927936 + row_id, k, 'STUDY_B', standard_var, standard_label, value,
       {_NONE}, seqnum, CAST(visitnum AS DOUBLE)
FROM b JOIN people ON id = b.subjid AND source_study = 'STUDY_B'
UNION ALL
SELECT lower(domain), 3 * 72057594037927936 + row_id, k, 'STUDY_C', standard_var, standard_label, value,
       value_code, seqnum, CAST(visitnum AS DOUBLE)
FROM c JOIN people ON id = record_id AND source_study = 'STUDY_C'"""

LOADED_LINKAGE = f"""
WITH {_PEOPLE},
known AS (SELECT source_study, subjid, k AS subject_key FROM people)
SELECT row_number() OVER (ORDER BY record_id) AS linkage_id, study_a_subject_key, study_c_subject_key, linkage_type
FROM ({_PAIRS.replace('{subjects}', 'known')})"""

_STORED = """SELECT domain, {id} AS fact_id, subject_key, source_study, standard_var, standard_label, value, value_code,
       CAST(seqnum AS INTEGER) AS seqnum, CAST(CAST(visitnum AS DECIMAL(10, 2)) AS DOUBLE) AS visitnum FROM facts f"""
SECOND_BATCH = f"""
WITH last AS (SELECT domain AS d, source_study AS s, max(fact_id % 72057594037927936) AS id FROM facts
              WHERE subject_key % 2 = 1 GROUP BY ALL)
{_STORED.format(id='fact_id')} WHERE subject_key % 2 = 1
UNION ALL
{_STORED.format(id='fact_id + coalesce(last.id, 0)')} LEFT JOIN last ON d = domain AND s = source_study WHERE subject_key % 2 = 0"""
SMALLER_BATCH = f"""{_STORED.format(id='fact_id')} WHERE subject_key % 2 = 1 OR (subject_key % 2 = 0 AND domain IN ('ae', 'mh'))"""

# Violations planted in the facts and subjects; the Spark side plants the same ones.
DIRTY_FACTS = """
SELECT domain, fact_id, value,
       CASE WHEN fact_id % 4999 = 0 THEN NULL WHEN fact_id % 4993 = 0 THEN -1 - fact_id % 3 ELSE subject_key END AS subject_key,
       CASE WHEN fact_id % 503 = 0 THEN 'STUDY_B' ELSE source_study END AS source_study,
       CASE WHEN fact_id % 4987 = 0 THEN NULL ELSE standard_var END AS standard_var
FROM {facts}"""
DIRTY_SUBJECTS = """
SELECT subject_key, source_study, CASE WHEN subject_key % 40 < 3 THEN 'DUP' ELSE subjid END AS subjid,
       CASE WHEN subject_key % 200 < 10 THEN 'SCR-DUP' ELSE scrno END AS scrno, record_id
FROM {subjects}"""

_DIRTY = DIRTY_FACTS.replace("{facts}", "facts")
_DIRTY_S = DIRTY_SUBJECTS.replace("{subjects}", "subjects")

CHECKS: dict[str, tuple[tuple[str, ...], str]] = {
    "l_check_registry": (("facts",), f"""
SELECT domain, source_study, count(*) AS n_rows FROM ({_DIRTY})
WHERE domain IN ('ex', 'ae', 'lb') AND source_study <> 'STUDY_A' GROUP BY ALL"""),
    "l_check_not_null": (("facts",), f"""
SELECT domain, count(*) - count(subject_key) AS null_subject_key, count(*) - count(source_study) AS null_source_study,
       count(*) - count(standard_var) AS null_standard_var
FROM ({_DIRTY}) GROUP BY domain"""),
    "l_check_fk": (("facts", "subjects"), f"""
SELECT domain, subject_key, count(*) AS n_rows FROM ({_DIRTY})
WHERE subject_key NOT IN (SELECT subject_key FROM subjects) GROUP BY ALL"""),
    "l_batch_checks": (("facts",), f"""
SELECT count(*) AS n_rows, count(*) - count(subject_key) AS null_subject_key, count(*) - count(source_study) AS null_source_study,
       count(*) - count(standard_var) AS null_standard_var,
       count(CASE WHEN domain IN ('ex', 'ae', 'lb') AND source_study <> 'STUDY_A' THEN 1 END) AS not_in_registry
FROM ({_DIRTY})"""),
    "l_check_subject_ids": (("subjects",), f"""
SELECT rule, source_study, id, count(*) AS n_rows FROM (
  SELECT 'subjid' AS rule, source_study, subjid AS id FROM ({_DIRTY_S})
  UNION ALL SELECT 'scrno', source_study, scrno FROM ({_DIRTY_S})
  UNION ALL SELECT 'record_id', source_study, record_id FROM ({_DIRTY_S}))
WHERE id IS NOT NULL GROUP BY ALL HAVING count(*) > 1"""),
}

# name -> (wide forms, study tables, SQL)
QUERIES: dict[str, tuple[tuple[str, ...], tuple[str, ...], str]] = {
    "e_unpivot_a": (("a_ae", "a_sae", "a_ie"), (), UNPIVOT_A),
    "e_unpivot_b": (("b_mh", "b_ie", "b_dm"), (), UNPIVOT_B),
    "e_unpivot_c": (("c_main",), (), UNPIVOT_C),
    "e_positional_pe": (("c_main",), (), _c_statement(_pe_rows())),
    "e_positional_vs": (("c_main",), (), _c_statement(_vs_rows())),
    "e_participant_rows": (("c_main",), (), f"""
SELECT source_row_number, record_id AS record_id, subjid, visitnum, seqnum FROM ({PARTICIPANT_ROWS})"""),
    "e_manual_linkage": (("linkage",), (), MANUAL),
    "e_empty_domains": (("a_ae", "a_sae", "a_ie"), (), f"""
SELECT d.domain FROM (VALUES ('AE'), ('IE'), ('LB')) d(domain)
WHERE d.domain NOT IN (SELECT domain FROM ({UNPIVOT_A}))"""),
    "l_resolve_subjects": (("sightings",), (), RESOLVED_SUBJECTS),
    "l_assign_subjects": (("sightings",), (), ASSIGNED),
    "l_resolve_chained": (("chained",), (), RESOLVED_SUBJECTS.replace("sightings", "chained")),
    "l_assign_chained": (("chained",), (), ASSIGNED.replace("sightings", "chained")),
    "l_rejected_sightings": (("sightings",), (), REJECTED),
    "l_rejected_rows": (("sightings",), (), REJECTED_ROWS),
    "e_checkpoint": (("a_ae", "a_sae", "a_ie"), (), f"SELECT *, 'STUDY_A' AS source_study FROM ({UNPIVOT_A})"),
    "l_load_facts": (("a_ae", "a_sae", "a_ie", "b_mh", "b_ie", "b_dm", "c_main"), (), LOADED_FACTS),
    "l_load_linkage": (("a_ae", "a_sae", "a_ie", "b_mh", "b_ie", "b_dm", "c_main", "linkage"), (), LOADED_LINKAGE),
    "l_linkage": (("linkage",), ("subjects",), LINKAGE),
    "l_linkage_stored": (("linkage",), ("subjects",), LINKAGE_STORED),
    "l_check_linkage_pairs": (("linkage",), ("subjects",), f"""
SELECT study_a_subject_key // 40 AS a, study_c_subject_key // 40 AS c, count(*) AS n_rows FROM ({LINKAGE})
WHERE study_a_subject_key IS NOT NULL AND study_c_subject_key IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"""),
    "l_load_second_batch": ((), ("facts",), SECOND_BATCH),
    "l_reload_smaller_batch": ((), ("facts",), SMALLER_BATCH),
    "l_route_rows": (("sheets",), (), """
SELECT row_id, CASE domain WHEN 'Comment' THEN 'co' ELSE lower(domain) END AS domain,
       coalesce("Standard_VAR", "StandardVAR") AS standard_var, "VALUE" AS value, "SeqNum" AS seqnum, 'STUDY_A' AS source_study
FROM sheets WHERE domain NOT IN ('identifier', 'Notes')"""),
    "l_skipped_sheets": (("sheets",), (), """
SELECT domain, count(*) AS n_rows FROM sheets WHERE domain IN ('identifier', 'Notes') GROUP BY domain"""),
    **{name: ((), *spec) for name, spec in CHECKS.items()},
}


def heads(forms: tuple[str, ...]) -> list[str]:
    return duck_form_ctes(*forms)
