"""Named queries on the fixture, and the oracle text of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortweave.catalog import QUERIES as ENDPOINTS
from fixtures import etl_queries, oracle_etl, oracle_queries, page_queries, retrieval_queries
from fixtures.study_data import duck_ctes, spark_facts, spark_subjects

Query = Callable[[SparkSession, str], DataFrame]

_STUDY_OF = {"a": "STUDY_A", "b": "STUDY_B", "c": "STUDY_C"}
_PER_STUDY = {
    "eligibility": "abc", "vital-trends": "abc", "enrolled-count": "abc", "out-of-range-lb": "a",
}
_STUDY_A_ONLY = ("ae-by-subject", "ae-severity", "ae-events")


def _endpoint(name: str, **params: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ENDPOINTS[name](spark_subjects(spark, sf_dir), spark_facts(spark, sf_dir), **params)
    return run


def _endpoint_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in ENDPOINTS:
        key = "q_" + name.lower().replace("-", "_")
        if name in _PER_STUDY:
            for suffix in _PER_STUDY[name]:
                out[f"{key}_{suffix}"] = _endpoint(name, study=_STUDY_OF[suffix])
        elif name in _STUDY_A_ONLY:
            out[key] = _endpoint(name, study="STUDY_A")
        else:
            out[key] = _endpoint(name)
    out["q_vital_trends"] = _endpoint("vital-trends")
    return out


def with_tables(heads: list[str], sql: str) -> str:
    """Prefix ``sql`` with the fixture's tables as CTEs."""
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE"):
        return "WITH RECURSIVE " + ",\n".join(heads) + ",\n" + body[len("WITH RECURSIVE"):].lstrip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(heads) + ",\n" + body[5:].lstrip()
    return ("WITH " + ",\n".join(heads) + "\n" if heads else "") + body


def queries() -> dict[str, Query]:
    return {
        **_endpoint_queries(),
        **etl_queries.QUERIES,
        **{name: query for name, (query, _, _) in page_queries.PAGES.items()},
        **{name: query for name, (query, _) in retrieval_queries.RETRIEVAL.items()},
    }


def oracle_sql() -> dict[str, str]:
    out = {name: with_tables(duck_ctes(*tables), sql)
           for name, (tables, sql) in oracle_queries.QUERIES.items()}
    for name, (forms, tables, sql) in oracle_etl.QUERIES.items():
        out[name] = with_tables(oracle_etl.heads(forms) + duck_ctes(*tables), sql)
    for name in ("q_dq_missingness", "q_dq_visit_completeness"):  # from summaries of batches, the same
        out[f"{name}_stored"] = out[name]
    for name, (_, tables, sql) in page_queries.PAGES.items():
        out[name] = with_tables(duck_ctes(*tables), sql)
    out.update({name: sql.strip() for name, (_, sql) in retrieval_queries.RETRIEVAL.items() if sql})
    return out
