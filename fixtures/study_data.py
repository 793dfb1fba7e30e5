"""Study-shaped tables derived from the driver's ``customer`` and ``orders``.

Every subject is a customer, every event an order. Each row is a function of its
source row only, so the fixture has no shuffle and grows linearly with its input.
``FIXTURES.md`` lists the rules; symbols here: ``s`` customer key, ``k`` order key,
``d`` order date.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from fixtures.dialect import DUCKDB, SPARK, Dialect

DOMAINS = (
    "dm", "ds", "sv", "mh", "pe", "vs", "be", "bs", "ie", "cm", "eos", "co",
    "ex", "ae", "lb",
)

NULL_TEXT = "CAST(NULL AS STRING)"
NULL_VISIT = "CAST(NULL AS DECIMAL(10,2))"
NULL_INT = "CAST(NULL AS INT)"


def _study(s: str) -> str:
    return f"CASE {s} % 3 WHEN 0 THEN 'STUDY_A' WHEN 1 THEN 'STUDY_B' ELSE 'STUDY_C' END"


def _visit(x: object) -> str:
    return f"CAST({x} AS DECIMAL(10,2))"


def subjects_sql(q: Dialect) -> str:
    n = q.idiv("c_custkey", 3)
    padded = f"lpad(CAST({n} AS STRING), 12, '0')"
    unlinked = f"lpad(CAST({n} + 500000000000 AS STRING), 12, '0')"
    return f"""
SELECT c_custkey AS subject_key,
       {_study('c_custkey')} AS source_study,
       {_study('c_custkey')} AS studyid,
       CASE WHEN c_custkey % 15 = 0 THEN NULL
            WHEN c_custkey % 3 = 2 AND {n} % 4 = 0 THEN 'C-SYN-' || {unlinked}
            WHEN c_custkey % 3 = 2 THEN 'C-SYN-' || {padded}
            WHEN c_custkey % 3 = 1 THEN 'B-SYN-' || {padded}
            ELSE 'A-SYN-' || {padded} END AS subjid,
       CASE WHEN c_custkey % 3 = 0 THEN 'SCR-' || lpad(CAST(c_custkey AS STRING), 12, '0') END AS scrno,
       CASE WHEN c_custkey % 3 = 2 THEN CAST(c_custkey AS STRING) END AS record_id
FROM {{customer}}"""


def _of_study(key: str, where: str, place: int | None) -> tuple[str, str]:
    """Study expression and filter; a literal study lets a filter on it drop the branch."""
    if place is None:
        return _study(key), where
    return f"'STUDY_{'ABC'[place]}'", f"{key} % 3 = {place} AND ({where})"


def _orders(q: Dialect, where: str, place: int | None = None) -> str:
    half = q.idiv("o_orderkey", 2)
    study, where = _of_study("o_custkey", where, place)
    return f"""
SELECT o_custkey AS s, o_orderkey AS k, CAST(o_orderdate AS DATE) AS d,
       o_orderpriority AS p, o_orderstatus AS st,
       o_orderkey * 200 AS id0,
       {study} AS source_study,
       CAST(o_orderkey % 2147483647 AS INT) AS seq0,
       CASE WHEN o_custkey % 3 = 0 THEN
                 CASE WHEN o_orderkey % 17 <> 0 THEN {_visit(f'1 + {half} % 13')} END
            WHEN o_orderkey % 7 <> 0 THEN {_visit(f'1 + {half} % 3')} END AS visit0
FROM {{orders}}
WHERE {where}"""


def _customers(q: Dialect, where: str, place: int | None = None) -> str:
    study, where = _of_study("c_custkey", where, place)
    return f"""
SELECT c_custkey AS s, c_custkey AS k, c_mktsegment AS p,
       c_custkey * 200 + 100 AS id0,
       {study} AS source_study,
       CAST(1 AS INT) AS seq0, {_visit(1)} AS visit0
FROM {{customer}}
WHERE {where}"""


def _row(var, label, value, seq="seq0", visit="visit0"):
    return {"standard_var": var, "standard_label": label, "value": value,
            "seqnum": seq, "visitnum": visit}


def _when(cond: str, text: str) -> str:
    return f"CASE WHEN {cond} THEN {text} END"


def _domain_rows(q: Dialect, domain: str) -> list[tuple[str, list[dict[str, str]]]]:
    """(base select, rows per base row) pairs of one domain; a null variable name
    means the row does not exist."""
    a, b, c = "s % 3 = 0", "s % 3 = 1", "s % 3 = 2"
    n = q.idiv("s", 3)

    if domain == "dm":
        return [(_customers(q, "true"), [
            _row(_when(a, "'AGE'"), "'Age'", "CAST(18 + s % 50 AS STRING)"),
            _row(_when(a, "'AGEU'"), "'Age Units'", "'YEARS'"),
            _row("'SEX'", "'Sex'",
                 f"CASE WHEN {a} THEN CASE s % 2 WHEN 0 THEN 'F' ELSE 'M' END"
                 " ELSE CAST(1 + s % 2 AS STRING) END"),
        ])]

    if domain == "sv":
        # attended visits: the first (n % 16) of 13 in A, the first (n % 4) of 3 in B, C
        rows = []
        for i in range(1, 14):
            held = f"({a} AND {n} % 16 >= {i})"
            if i <= 3:
                held = f"({held} OR ({a.replace('=', '<>')} AND {n} % 4 >= {i}))"
            rows.append(_row(_when(held, "'SVSTDTC'"), "'Visit date'",
                             f"CASE WHEN (s + {i}) % 29 = 0 THEN ' ' ELSE 'seen' END",
                             f"CAST({i} AS INT)", _visit(i)))
        return [(_customers(q, "true"), rows)]

    if domain == "ex":
        first = q.plus_days("DATE '1996-01-01'", "(s * 37) % 900")
        second = f"CASE WHEN s % 41 = 0 THEN {first} ELSE {q.plus_days(first, '60 + s % 200')} END"
        third = q.plus_days(first, "400 + s % 100")
        repeat = q.plus_days(first, "3")
        rows = []
        for seq, visit, held, when in (
            (1, 2, f"{n} % 4 >= 1", q.dmy(first)),
            (2, 6, f"{n} % 4 >= 2", f"CASE WHEN s % 59 = 0 THEN 'UNK' ELSE {q.dmy(second)} END"),
            (3, 11, f"{n} % 4 >= 3", q.dmy(third)),
            (4, 2, "s % 53 = 0", q.dmy(repeat)),
        ):
            seq_visit = (f"CAST({seq} AS INT)", _visit(visit))
            rows.append(_row(_when(held, "'EXSTDTC'"), "'Start Date'", when, *seq_visit))
            rows.append(_row(_when(held, "'EXTRT'"), "'Treatment'", "'VACCINE'", *seq_visit))
        return [(_customers(q, "true", 0), rows)]

    if domain == "ae":
        seq = f"CASE WHEN k % 211 = 0 THEN {NULL_INT} ELSE seq0 END"
        third = q.idiv("k", 3)
        return [(_orders(q, "o_orderkey % 2 = 1", 0), [
            _row("'AETERM'", "'Term'", "p", seq),
            _row("'AESTDTC'", "'Start Date'",
                 f"CASE WHEN k % 97 = 0 THEN 'UNK' ELSE {q.dmy('d')} END", seq),
            _row(_when("k % 43 <> 0", "'AESEV'"), "'Severity'",
                 "CASE k % 3 WHEN 0 THEN 'Mild' WHEN 1 THEN 'Moderate' ELSE 'Severe' END", seq),
            _row("'AEREL'", "'Causality'",
                 "CASE k % 4 WHEN 1 THEN 'Related' ELSE 'Not related' END", seq),
            _row("'AESER'", "'Serious'", f"CASE {third} % 5 WHEN 1 THEN 'Y' WHEN 2 THEN '1' ELSE 'N' END", seq),
            _row(_when("k % 5 = 0", "'AEREFID'"), "'Reference'", "'R' || CAST(k AS STRING)", seq),
        ])]

    if domain == "ie":
        screened = [
            _row("'IEORRES'", "'Eligible'",
                 "CASE WHEN s % 15 = 0 THEN 'N' WHEN s % 33 = 0 THEN NULL ELSE 'Y' END"),
            _row(_when("s % 15 = 0", "'SUPPIE'"), "'Screening Failure Reason'", "p"),
            _row(_when("s % 75 = 0", "'SUPPIE'"), "'Screening Failure Reason'", "'Withdrew consent'"),
            _row(_when("s % 45 = 0", "'SUPPIE'"), "'Eligibility Reason'", "'See notes'"),
        ]
        criteria_b, criteria_c = [], []
        for i in range(1, 5):
            at = (f"CAST({i} AS INT)", _visit(1))
            kind = "INCLUSION" if i <= 2 else "EXCLUSION"
            code = f"{'IN' if i <= 2 else 'EX'}{i}"
            held = f"s % 5 <> 0" if i == 4 else "true"
            criteria_b += [
                _row("'IECAT'", "'Category'", f"'{kind}'", *at),
                _row(_when(held, "'IETESTCD'"), "'Criterion code'", f"'{code}'", *at),
                _row("'IETEST'", "'Criterion'", f"'Criterion text {i}'", *at),
                _row(_when(f"(s + {i}) % 37 <> 0", "'IEORRES'"), "'Answer'",
                     f"CASE WHEN ({n} + {i}) % 9 = 0 THEN '{'N' if i <= 2 else 'Yes'}'"
                     f" ELSE '{'Y' if i <= 2 else 'No'}' END", *at),
            ]
        labels = {
            1: "CASE WHEN s % 29 = 2 THEN 'Consent form signed'"
               " ELSE 'Inclusion 1 < Signed <full> consent > read' END",
            2: "'Inclusion 2 <Aged 2 to 45>'",
            3: "'Exclusion 1 <Previously immunized with any typhoid vaccine>'",
            4: "'Exclusion 2 <Acute illnesses at enrolment >'",
        }
        for i, label in labels.items():
            at = (f"CAST({i} AS INT)", _visit(1))
            good, bad = ("1", "2") if i <= 2 else ("2", "1")
            criteria_c.append(_row(
                "'IETEST'", label,
                f"CASE WHEN (s + {i}) % 31 = 0 THEN NULL WHEN (s + {i}) % 61 = 0 THEN 'unknown'"
                f" WHEN ({n} + {i}) % 9 = 0 THEN '{bad}' ELSE '{good}' END", *at))
        return [
            (_customers(q, "true", 0), screened),
            (_customers(q, "true", 1), criteria_b),
            (_customers(q, "true", 2), criteria_c),
        ]

    if domain == "mh":
        third = q.idiv("k", 3)
        yes = f"CASE WHEN {a} THEN 'Y' WHEN {b} THEN 'Yes' ELSE '1' END"
        no = f"CASE WHEN {a} THEN 'N' WHEN {b} THEN 'No' ELSE '2' END"
        answer = (f"CASE {third} % 7 WHEN 0 THEN {yes} WHEN 1 THEN {yes} WHEN 2 THEN {no}"
                  f" WHEN 3 THEN {no} WHEN 4 THEN '9' WHEN 5 THEN 'Sometimes' END")
        term = "CASE k % 3 WHEN 0 THEN 'Fever' WHEN 1 THEN 'Headache' ELSE 'Rash' END"
        began = q.plus_days("DATE '1993-01-01'", "s % 700")
        return [
            (_orders(q, "o_orderkey % 2 = 0 AND o_custkey % 5 <> 0"), [
                _row("'MHOCCUR'", "'Question ' || CAST(k % 3 AS STRING)", answer)]),
            (_orders(q, "o_orderkey % 4 = 1"), [
                _row("'MHTERM'", f"CASE WHEN {a} THEN 'Reported term' ELSE {term} END",
                     f"CASE WHEN {a} THEN {term} ELSE 'Yes' END"),
                _row(_when("k % 29 <> 0", "'MHSTDTC'"), "'Start Date'",
                     f"CASE WHEN s % 41 = 0 THEN 'UNK' WHEN {a} THEN {q.dmy(began)}"
                     f" ELSE {q.iso(began)} END"),
            ]),
        ]

    if domain == "pe":
        system = ("CASE k % 8 WHEN 0 THEN 'Skin' WHEN 1 THEN 'Heart' WHEN 2 THEN 'Lungs'"
                  " WHEN 3 THEN 'Abdomen' WHEN 4 THEN 'Neck' WHEN 5 THEN 'Eyes'"
                  " WHEN 6 THEN 'Ears' ELSE 'Limbs' END")
        label = (f"CASE WHEN {a} THEN 'Result' WHEN {b} AND k % 55 = 0 THEN 'Result unnamed'"
                 f" WHEN {b} THEN 'Result <' || {system} || '>' ELSE {system} END")
        return [(_orders(q, "o_orderkey % 3 = 0"), [
            _row(_when(a, "'PETEST'"), "'Body system'", system),
            _row("'PEORRES'", label,
                 "CASE WHEN k % 5 = 0 THEN 'Abnormal' ELSE 'Normal' END"),
        ])]

    if domain == "vs":
        tests = (
            ("Heart Rate", "beats/minute", "CAST(60 + k % 40 AS STRING)"),
            ("Body Temperature", "Celsius",
             "CAST(36 + k % 3 AS STRING) || '.' || CAST(k % 10 AS STRING)"),
            ("Height", "cm", "' ' || CAST(150 + k % 40 AS STRING) || ' '"),
            ("Weight", "kg", "CAST(45 + k % 50 AS STRING)"),
            ("Respiratory Rate", "breaths/minute", "CAST(12 + k % 9 AS STRING)"),
        )
        paired, separate, combined = [], [], []
        for i, (test, unit, reading) in enumerate(tests):
            value = (f"CASE WHEN k % 23 = {i} THEN 'ND' WHEN k % 37 = {i} THEN '-1'"
                     f" WHEN k % 41 = {i} THEN '1e2' ELSE {reading} END")
            paired += [
                _row("'VSTEST'", "'Test'", f"'{test}'"),
                _row(_when(f"k % 31 <> {i}", "'VSORRES'"), "'Result'", value),
                _row(_when(f"k % 19 <> {i}", "'VSORRESU'"), "'Unit'", f"'{unit}'"),
            ]
            separate += [
                _row("'VSORRES'", f"'{test}'", value),
                _row(_when("k % 2 = 0", "'VSORRESU'"), f"'{test.upper()} Unit'", f"'{unit}'"),
            ]
            combined.append(_row("'VSORRES'", f"'{test} ({unit})'", value))
        return [(_orders(q, "true", place), rows)
                for place, rows in enumerate((paired, separate, combined))]

    if domain == "lb":
        result = "k % 100"
        return [(_orders(q, "o_orderkey % 2 = 0", 0), [
            _row("'LBTEST'", "'Test'",
                 "CASE k % 5 WHEN 0 THEN 'Albumin' WHEN 1 THEN 'Creatinine' WHEN 2 THEN 'Glucose'"
                 " WHEN 3 THEN 'Hemoglobin' ELSE 'Platelets' END"),
            _row("'LBORRES'", "'Result'",
                 f"CASE WHEN k % 71 = 0 THEN 'haemolysed' ELSE CAST({result} AS STRING) END"),
            _row(_when("k % 7 <> 0", "'LBORRESU'"), "'Unit'", "'g/dL'"),
            _row("'LBNRIND'", "'Flag'",
                 f"CASE WHEN {result} < 10 THEN 'Low' WHEN {result} > 80 THEN 'High' ELSE 'Normal' END"),
            _row("'LBORNRLO'", "'Lower limit'", "CAST(8 + k % 5 AS STRING)"),
            _row("'LBORNRHI'", "'Upper limit'", "CAST(80 + k % 3 AS STRING)"),
            _row("'LBDTC'", "'Assessed'", q.iso("d")),
        ])]

    if domain == "cm":
        screen = (f"CASE WHEN s % 13 = 0 THEN '9' WHEN {a} THEN CASE s % 2 WHEN 0 THEN 'Y' ELSE 'N' END"
                  f" WHEN {b} THEN CASE s % 2 WHEN 0 THEN 'Yes' ELSE 'No' END"
                  f" WHEN s % 17 = 0 THEN NULL ELSE CAST(1 + s % 2 AS STRING) END")
        return [
            (_orders(q, "o_orderkey % 4 <> 0 AND o_custkey % 7 <> 0"), [
                _row("'CMTRT'", "'Medication'", "'MED-' || CAST(k % 17 AS STRING)")]),
            (_customers(q, "c_custkey % 11 <> 0"), [
                _row("'CMYN'", "'Any medication?'", screen)]),
        ]

    every = {"ds": 2, "be": 5, "bs": 6, "co": 9, "eos": 10}[domain]
    return [(_orders(q, f"o_orderkey % {every} = 0"), [
        _row(f"'{domain.upper()}TERM'", "'Entry'",
             "CASE WHEN k % 13 = 0 THEN '  ' WHEN k % 29 = 0 THEN NULL ELSE st END"),
    ])]


@lru_cache(maxsize=None)
def domain_sql(q: Dialect, domain: str) -> str:
    parts = []
    for base, rows in _domain_rows(q, domain):
        numbered = [{"ord": str(i), **r} for i, r in enumerate(rows, start=1)]
        parts.append(f"""
SELECT '{domain}' AS domain, id0 + ord AS fact_id, s AS subject_key, source_study,
       standard_var, standard_label, value, {NULL_TEXT} AS value_code, seqnum, visitnum
FROM ({q.explode(base, numbered)}) e
WHERE standard_var IS NOT NULL""")
    return "\nUNION ALL\n".join(parts)


# --------------------------------------------------------------------------- Spark
def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders")}


def _spark_sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    used = {t: df for t, df in _tables(spark, sf_dir).items() if "{" + t + "}" in text}
    return spark.sql(text, **used)


def spark_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spark_sql(spark, sf_dir, subjects_sql(SPARK))


def spark_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All domains; a filter on ``domain`` leaves only that domain's scan in the plan."""
    return _spark_sql(spark, sf_dir, "\nUNION ALL\n".join(domain_sql(SPARK, d) for d in DOMAINS))


# -------------------------------------------------------------------------- DuckDB
def duck_ctes(*names: str) -> list[str]:
    """CTE texts, in order, for ``subjects``, domain names or ``facts`` (all domains)."""
    out = []
    for name in names:
        if name == "subjects":
            text = subjects_sql(DUCKDB)
        elif name == "facts":
            text = "\nUNION ALL\n".join(domain_sql(DUCKDB, d) for d in DOMAINS)
        else:
            text = domain_sql(DUCKDB, name)
        text = text.replace("{customer}", "customer").replace("{orders}", "orders")
        out.append(f"{name} AS ({text})")
    return out
