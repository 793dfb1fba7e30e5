"""Wide study forms and the dictionary, derived from ``customer`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fixtures.dialect import DUCKDB, SPARK, Dialect
from fixtures.study_data import _spark_sql

DICTIONARY_COLUMNS = (
    "Standard_Domain", "Standard_VAR", "Standard_LABEL", "STUDY_A_FORM", "STUDY_A_VAR",
    "STUDY_B_FORM", "STUDY_B_VAR", "STUDY_C_FORM", "STUDY_C_VAR",
)

# A crosswalk as people write one: stray blanks, mixed case, repeats, gaps.
DICTIONARY = (
    (" AE ", "AETERM", "Reported term", "ae", " AETerm ", None, None, None, None),
    ("AE", "AESTDTC ", "Start date", "AE", "aestdt", None, None, None, None),
    ("AE", "AESEV", "Severity", "Ae", "AESEV", None, None, None, None),
    ("AE", "AESER", "Serious", "AE", "aeser", None, None, None, None),
    ("AE", "AETERM", "Reported term", "SAE", "saeterm", None, None, None, None),
    ("AE", "AELLT", "Lowest level term", "SAE", "saeterm", None, None, None, None),
    ("AE", "AESTDTC", "Start date", "SAE", "saedt", None, None, None, None),
    ("AE", "AEACN", "Action taken", "GONE", "aeacn", None, None, None, None),
    ("AE", "AEOUT", "Outcome", "AE", "  ", None, None, None, None),
    ("LB", "LBTEST", "Test", "GONE", "lbtest", None, None, None, None),
    ("IE", "IEORRES", "Eligible", "IE", "ieorres", None, None, None, None),
    ("MH", "MHTERM", "Condition", None, None, "mh", "mhterm", "history", "MHQ"),
    ("MH", "MHSTDTC", " Onset", None, None, "MH", "mhdat", None, None),
    ("IE", "IETESTCD", "Inclusion 1", None, None, "IE", "in1", None, None),
    ("IE", "IECAT", "Inclusion 1 category", None, None, "IE", "in1cat", None, None),
    ("IE", "IETESTCD", "Inclusion 2", None, None, "IE", "in2", None, None),
    ("IE", "IETESTCD", "Exclusion 1", None, None, "IE", "ex1", None, None),
    ("IE", "IECAT", "Exclusion 1 category", None, None, "IE", "ex1cat", None, None),
    ("IE", "IETESTCD", "Exclusion 10", None, None, "IE", "ex10", None, None),
    ("IE", "IEDTC", "Date", None, None, "IE", "iedat", None, None),
    ("DM", "SEX", "Sex", None, None, "DM", "sex", None, None),
    ("CM", "CMTRT", "Medication", None, None, None, None, "Meds", "cmtrt"),
    ("CM", "CMTRT", "Medication", None, None, None, None, "meds again", " CMTRT"),
    ("PE", "PEYN", "Examined?", None, None, None, None, "exam", "peyn"),
    ("PE", "PEORRES", "Result", None, None, None, None, "Exam", "peres2"),
    ("VS", "VSORRES", "Body height", None, None, None, None, "vitals", "vsorres1"),
    ("VS", "VSORRES", None, None, None, None, None, "vitals", "vsorres2"),
    ("VS", "VSPERF", "Vital signs taken", None, None, None, None, "vitals", "vsyn"),
)

_SYN = "lpad(CAST({n} AS STRING), 12, '0')"


def _events(q: Dialect, where: str, columns: str) -> str:
    return f"SELECT o_orderkey AS source_row_number, {columns} FROM {{orders}} WHERE {where}"


def _people(q: Dialect, where: str, columns: str) -> str:
    return f"SELECT c_custkey AS source_row_number, {columns} FROM {{customer}} WHERE {where}"


def form_sql(q: Dialect, form: str) -> str:
    """One wide form; every cell but ``source_row_number`` is text."""
    k, s, d = "o_orderkey", "o_custkey", "CAST(o_orderdate AS DATE)"
    n = q.idiv(s, 3)
    padded = _SYN.format(n=n)
    a_ids = (f"'A' AS studyid, CASE WHEN {s} % 15 <> 0 THEN 'A-SYN-' || {padded} END AS subjid,"
             f" 'SCR-' || CAST({s} AS STRING) AS scrno")
    if form == "a_ae":
        return _events(q, f"{s} % 3 = 0 AND {k} % 2 = 1", f"""{a_ids},
  CASE WHEN {k} % 11 <> 0 THEN CAST(1 + {k} % 13 AS STRING) END AS visit_num,
  o_orderpriority AS aeterm, {q.dmy(d)} AS aestdt,
  CASE WHEN {k} % 43 = 1 THEN '' WHEN {k} % 41 <> 1 THEN 'Mild' END AS aesev,
  CASE {k} % 5 WHEN 1 THEN 'Y' ELSE 'N' END AS aeser, 'free text' AS aecom""")
    if form == "a_sae":
        return _events(q, f"{s} % 3 = 0 AND {k} % 6 = 2", f"""{a_ids},
  CAST(1 + {k} % 13 AS STRING) AS visit,
  CASE WHEN {k} % 7 <> 0 THEN o_orderpriority END AS saeterm,
  CASE WHEN {k} % 14 <> 0 THEN {q.iso(d)} END AS saedt""")
    if form == "a_ie":
        c = "c_custkey"
        return _people(q, f"{c} % 3 = 0", f"""'A' AS studyid,
  CASE WHEN {c} % 15 <> 0 THEN 'A-SYN-' || {_SYN.format(n=q.idiv(c, 3))} END AS subjid,
  'SCR-' || CAST({c} AS STRING) AS scrno, '1' AS visit_num,
  CASE WHEN {c} % 15 = 0 THEN 'N' ELSE 'Y' END AS ieorres, 'unused' AS ienote,
  CASE WHEN {c} % 15 = 0 THEN c_mktsegment END AS iesfreason,
  CASE WHEN {c} % 45 = 0 THEN 'See notes' ELSE '' END AS ieeligreason""")
    if form == "b_mh":
        return _events(q, f"{s} % 3 = 1 AND {k} % 4 = 1", f"""'B' AS studyid,
  'B-SYN-' || {padded} AS subjid, CASE WHEN {k} % 9 <> 0 THEN CAST(1 + {k} % 3 AS STRING) END AS visitnum,
  CASE {k} % 3 WHEN 0 THEN 'Fever' WHEN 1 THEN 'Rash' END AS mhterm, {q.iso(d)} AS mhdat""")
    if form in ("b_ie", "b_dm"):
        c = "c_custkey"
        ids = (f"'B' AS studyid, 'B-SYN-' || {_SYN.format(n=q.idiv(c, 3))} AS subjid, '1' AS visitnum")
        if form == "b_dm":
            return _people(q, f"{c} % 3 = 1", f"{ids}, CAST(1 + {c} % 2 AS STRING) AS sex")
        return _people(q, f"{c} % 3 = 1", f"""{ids},
  'IN1' AS in1, 'INCLUSION' AS in1cat, CASE WHEN {c} % 5 <> 0 THEN 'IN2' END AS in2,
  'EX1' AS ex1, 'EXCLUSION' AS ex1cat, CASE WHEN {c} % 7 = 0 THEN 'EX10' ELSE '' END AS ex10,
  '2020-01-01' AS iedat""")
    if form == "c_main":
        slots = ", ".join(
            f"CASE WHEN {k} % {3 + i} <> 1 THEN ' System {i} ' END AS petest{i}, "
            f"CASE {k} % {5 + i} WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '9' WHEN 3 THEN '5'"
            f" WHEN 4 THEN '' END AS peres{i}, "
            f"CASE WHEN {k} % 10 = {i} THEN 'noted' END AS pedesc{i}, 'NCS' AS peclsig{i}"
            for i in (1, 2, 3))
        vitals = ", ".join(
            f"CASE WHEN {k} % {6 + i} <> 2 THEN CAST(50 + {k} % {40 + i} AS STRING) END AS vsorres{i}, "
            f"CASE WHEN {k} % {6 + i} = 2 THEN '1' ELSE '0' END AS vsnd{i}___9" for i in range(1, 6))
        return _events(q, f"{s} % 3 = 2", f"""CAST({s} AS STRING) AS Record_ID,
  CASE WHEN {k} % 5 = 0 THEN 'C-SYN-' || {padded} WHEN {k} % 5 = 1 THEN '' END AS SubjID,
  CASE {k} % 7 WHEN 3 THEN 'bad' WHEN 4 THEN ' Visit1_ARM_1' WHEN 5 THEN 'visit2arm1'
       ELSE 'visit_' || CAST(1 + {k} % 3 AS STRING) || '_arm_1' END AS redcap_event_name,
  CASE WHEN {k} % 2 = 0 THEN 'Typhoid?' END AS mhq, CASE WHEN {k} % 3 = 0 THEN 'MED-' || CAST({k} % 17 AS STRING) END AS cmtrt,
  'Yes' AS peyn, CASE WHEN {k} % 4 = 0 THEN '1' END AS vsyn, CASE WHEN {k} % 28 = 0 THEN 'refused' END AS vsreasnd,
  {slots}, {vitals}""")
    if form == "linkage":
        c = "c_custkey"
        me = _SYN.format(n=q.idiv(c, 3))
        return _people(q, f"{c} % 3 = 2 AND {q.idiv(c, 3)} % 4 <> 0", f"""
  CAST({c} AS STRING) AS STUDY_C_record_id, 'C-SYN-' || {me} AS STUDY_C_subjid,
  CASE WHEN {c} % 11 <> 0 THEN 'A-SYN-' || {me} END AS STUDY_A_subjid,
  'P' || CAST({c} AS STRING) AS pre_id, CASE WHEN {c} % 4 = 0 THEN '' ELSE 'exact' END AS link_status,
  CAST(NULL AS STRING) AS pre_vg, '2' AS first_enrollment_visit, 'x' AS reviewer""")
    if form == "sightings":
        # two customers share a screening number, so identifiers conflict now and then
        pair = q.idiv(s, 2)
        return f"""SELECT {k} AS seen, {pair} AS family,
  CASE {pair} % 3 WHEN 0 THEN 'STUDY_A' WHEN 1 THEN 'STUDY_B' ELSE 'STUDY_C' END AS source_study,
  'P' || CAST({k} % 3 AS STRING) AS studyid,
  CASE WHEN {k} % 5 IN (0, 3, 4) THEN 'S' || CAST({s} AS STRING) END AS subjid,
  CASE WHEN {k} % 35 = 0 THEN '' WHEN {k} % 5 IN (1, 3, 4) THEN 'X' || CAST({pair} AS STRING) END AS scrno,
  CASE WHEN {k} % 50 <> 27 AND {k} % 5 IN (2, 4) THEN 'R' || CAST({s} AS STRING) END AS record_id
FROM {{orders}}"""
    if form == "chained":
        # families of 64 sightings, each sharing an identifier with the one before only; and one identifier that a whole study shares
        c = "c_custkey"
        f, none = q.idiv(c, 64), "CAST(NULL AS STRING)"
        return f"""SELECT {c} AS seen, {f} AS family, 'STUDY_A' AS source_study, 'A' AS studyid,
  'C' || CAST({f} AS STRING) || '-' || CAST({q.idiv(c, 2)} AS STRING) AS subjid, {none} AS scrno,
  'D' || CAST({f} AS STRING) || '-' || CAST({q.idiv(f"({c} + 1)", 2)} AS STRING) AS record_id FROM {{customer}}
UNION ALL SELECT {c}, -1, 'STUDY_B', 'B', 'H' || CAST({c} AS STRING), 'HOT', {none} FROM {{customer}} WHERE {c} % 2 = 0"""
    if form == "sheets":
        # rows as an audit workbook has them: sheet names, spellings of a header, blank rows of one spelling
        return f"""SELECT {k} AS row_id,
  CASE {k} % 9 WHEN 0 THEN 'Comment' WHEN 1 THEN 'CO' WHEN 2 THEN 'identifier' WHEN 3 THEN 'AE' WHEN 4 THEN 'Notes' ELSE 'LB' END AS domain,
  CASE WHEN {k} % 2 = 0 THEN 'V' || CAST({k} % 5 AS STRING) END AS `Standard_VAR`,
  CASE WHEN {k} % 3 = 0 THEN 'W' || CAST({k} % 5 AS STRING) END AS `StandardVAR`,
  o_orderpriority AS `VALUE`, CAST({k} % 7 AS STRING) AS `SeqNum`, 'no' AS reviewer
FROM {{orders}}""".replace("`", "`" if q is SPARK else '"')
    raise KeyError(form)


FORMS = ("a_ae", "a_sae", "a_ie", "b_mh", "b_ie", "b_dm", "c_main", "linkage")


def spark_form(spark: SparkSession, sf_dir: str, form: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, form_sql(SPARK, form))


def spark_dictionary(spark: SparkSession) -> DataFrame:
    schema = ", ".join(f"{c} string" for c in DICTIONARY_COLUMNS) + ", dict_row long"
    return spark.createDataFrame([(*row, i) for i, row in enumerate(DICTIONARY)], schema)


def duck_form_ctes(*forms: str) -> list[str]:
    return [f"{f} AS ({form_sql(DUCKDB, f).replace('{customer}', 'customer').replace('{orders}', 'orders')})"
            for f in forms]
