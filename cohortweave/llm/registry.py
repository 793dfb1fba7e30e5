"""The queries of this folder and of the corpus pipeline, with their SQL where there is any."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: One module an operator; each has QUERIES and ORACLE_SQL.
MODULES = (
    "substring_dedup", "packing", "decontamination", "sharding", "scoring",
    "quality_classifier", "secrets", "language_id", "quality_rules", "jaccard_join",
    "ranked_search", "embedding_dedup", "spelling",
)


def _modules():
    return [importlib.import_module(f"cohortweave.llm.{name}") for name in MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {name: query for m in _modules() for name, query in m.QUERIES.items()} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    import corpus_pipeline

    out = {name: sql.strip() for m in _modules() for name, sql in m.ORACLE_SQL.items()}
    return out | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
