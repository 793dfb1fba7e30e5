"""Unpivoting and loading queries on the wide fixture."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.operators import checks
from cohortweave.operators.dictionary import empty_domains, study_dictionary
from cohortweave.operators.load import (
    build_linkage, normalise_columns, route_rows, skipped_sheets, usable, with_source_study,
)
from cohortweave.operators.subjects import rejected_sightings, resolve_subjects
from cohortweave.operators.unpivot import ROW, pack_forms
from cohortweave.plans import etl, quality
from cohortweave.schema import FACTS, STUDY_A, STUDY_B, STUDY_C, domain_registry
from cohortweave.sources.store import (
    after_stored, cut_lineage, read_domains, read_facts, read_linkage, shared_folder, write_domains, write_facts, write_linkage,
)
from fixtures import oracle_etl
from fixtures.study_data import spark_facts, spark_subjects
from fixtures.wide_data import spark_dictionary, spark_form


def _forms(spark: SparkSession, sf: str, **names: str) -> dict[str, DataFrame]:
    return {form: spark_form(spark, sf, table) for form, table in names.items()}


_A_FORMS = {"AE": "a_ae", "sae": "a_sae", "IE": "a_ie"}


def unpivot_a(spark: SparkSession, sf: str) -> DataFrame:
    return etl.process_forms(STUDY_A, spark_dictionary(spark), _forms(spark, sf, **_A_FORMS))


def unpivot_b(spark: SparkSession, sf: str) -> DataFrame:
    return etl.process_forms(STUDY_B, spark_dictionary(spark),
                             _forms(spark, sf, MH="b_mh", IE="b_ie", DM="b_dm"))


def unpivot_c(spark: SparkSession, sf: str) -> DataFrame:
    return etl.process_record_export(STUDY_C, spark_dictionary(spark), spark_form(spark, sf, "c_main"))


def participant_rows(spark: SparkSession, sf: str) -> DataFrame:
    wide = etl.normalise_headers(spark_form(spark, sf, "c_main"))
    return etl.number_participant_rows(wide).select(ROW, "record_id", "subjid", "visitnum", "seqnum")


def manual_linkage(spark: SparkSession, sf: str) -> DataFrame:
    return etl.unpivot_manual(spark_form(spark, sf, "linkage"))


def no_rows(spark: SparkSession, sf: str) -> DataFrame:
    mapping = study_dictionary(spark_dictionary(spark), STUDY_A)
    forms = {name.upper(): df for name, df in _forms(spark, sf, **_A_FORMS).items()}
    return empty_domains(pack_forms(forms, mapping, STUDY_A), mapping)


def _resolved(spark: SparkSession, sf: str):
    return resolve_subjects(spark_form(spark, sf, "sightings"), "seen")


def _chained(spark: SparkSession, sf: str):
    return resolve_subjects(spark_form(spark, sf, "chained"), "seen")


def _rejected(spark: SparkSession, sf: str) -> DataFrame:
    return rejected_sightings(spark_form(spark, sf, "sightings"), "seen")


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    return _rejected(spark, sf).select("source_study", "seen", "studyid", F.lit(True).alias("rejected"))


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _rejected(spark, sf).select("source_study", "n_rows")


def _loaded(spark: SparkSession, sf: str) -> etl.Loaded:
    parts = {STUDY_A: unpivot_a, STUDY_B: unpivot_b, STUDY_C: unpivot_c}
    return etl.load_checkpoints({study: part(spark, sf) for study, part in parts.items()}, linkage=manual_linkage(spark, sf))


def load_facts(spark: SparkSession, sf: str) -> DataFrame:
    return _loaded(spark, sf).facts.withColumn("visitnum", F.col("visitnum").cast("double"))


def linkage(spark: SparkSession, sf: str) -> DataFrame:
    return build_linkage(manual_linkage(spark, sf), spark_subjects(spark, sf))


def _new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/store-{uuid.uuid4().hex}"


def linkage_stored(spark: SparkSession, sf: str) -> DataFrame:
    """Odd records first, then all, and all once more: a repeated batch leaves the store as it was."""
    path, people = _new_folder(spark), spark_subjects(spark, sf)
    rows = cut_lineage(manual_linkage(spark, sf))
    write_linkage(build_linkage(rows.where("CAST(record_id AS BIGINT) % 2 = 1"), people), path, "one")
    for _ in range(2):
        write_linkage(build_linkage(rows, people, read_linkage(spark, path, without="two")), path, "two")
    return read_linkage(spark, path)


def _two_batches(spark: SparkSession, sf: str) -> tuple[str, DataFrame, DataFrame]:
    facts = spark_facts(spark, sf)
    return _new_folder(spark), facts.where("subject_key % 2 = 1"), facts.where("subject_key % 2 = 0")


def second_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, whose fact ids are moved past the first one's; the second is loaded twice."""
    path, first, second = _two_batches(spark, sf)
    write_facts(first, path, "2024-01")
    for _ in range(2):
        write_facts(after_stored(second, read_facts(spark, path, without="2024-02")), path, "2024-02")
    return read_facts(spark, path).withColumn("visitnum", F.col("visitnum").cast("double"))


def reload_smaller_batch(spark: SparkSession, sf: str) -> DataFrame:
    """A batch loaded again with two domains only leaves nothing of its other domains behind."""
    path, first, second = _two_batches(spark, sf)
    write_facts(first, path, "2024-01")
    write_facts(second, path, "2024-02")
    write_facts(second.where("domain IN ('ae', 'mh')"), path, "2024-02")
    return read_facts(spark, path).withColumn("visitnum", F.col("visitnum").cast("double"))


def _summarised(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """Summaries of two batches that share subjects, visits and domains; the second is replaced by a whole one."""
    path, facts = _new_folder(spark), spark_facts(spark, sf)
    for batch, part in (("one", "fact_id % 3 = 1"), ("two", "fact_id % 3 = 2"), ("two", "fact_id % 3 <> 1")):
        write_facts(facts.where(part), path, batch)
        quality.write_summaries(spark, path, batch)
    return quality.read_summary(spark, path, name)


def batch_checks(spark: SparkSession, sf: str) -> DataFrame:
    """What the write itself saw of a batch with planted violations."""
    dirty = _dirty_facts(spark, sf)
    missing = [f for f in FACTS.fields if f.name not in dirty.columns]
    seen = write_facts(dirty.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]), _new_folder(spark))
    return spark.createDataFrame([tuple(seen.values())], ", ".join(f"{name} long" for name in seen))


def checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """The unpivoted rows, split by domain into the audit checkpoint and read back."""
    path = _new_folder(spark)
    write_domains(unpivot_a(spark, sf).withColumn("source_study", F.lit(STUDY_A)), path)
    return read_domains(spark, path)


def routed(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets with two spellings of one header; a study whose sheets have no variable column loads nothing."""
    sheets = spark_form(spark, sf, "sheets")
    usable_only = {STUDY_A: sheets, STUDY_B: sheets.drop("Standard_VAR", "StandardVAR")}
    canonical = {study: normalise_columns(df, keep=("row_id", "domain")) for study, df in usable_only.items()}
    return route_rows(with_source_study({study: df for study, df in canonical.items() if usable(df)}))


def _dirty_facts(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(oracle_etl.DIRTY_FACTS, facts=spark_facts(spark, sf))


def check_subject_ids(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_subject_ids(
        spark.sql(oracle_etl.DIRTY_SUBJECTS, subjects=spark_subjects(spark, sf)))


QUERIES = {
    "e_unpivot_a": unpivot_a,
    "e_unpivot_b": unpivot_b,
    "e_unpivot_c": unpivot_c,
    "e_positional_pe": lambda spark, sf: unpivot_c(spark, sf).where("domain = 'PE'"),
    "e_positional_vs": lambda spark, sf: unpivot_c(spark, sf).where("domain = 'VS'"),
    "e_participant_rows": participant_rows,
    "e_manual_linkage": manual_linkage,
    "e_empty_domains": no_rows,
    "l_resolve_subjects": lambda spark, sf: _resolved(spark, sf).subjects,
    "l_assign_subjects": lambda spark, sf: _resolved(spark, sf).assigned,
    "l_resolve_chained": lambda spark, sf: _chained(spark, sf).subjects,
    "l_assign_chained": lambda spark, sf: _chained(spark, sf).assigned,
    "l_rejected_sightings": rejected,
    "l_rejected_rows": rejected_rows,
    "l_load_facts": load_facts,
    "l_load_linkage": lambda spark, sf: _loaded(spark, sf).linkage,
    "l_linkage": linkage,
    "l_linkage_stored": linkage_stored,
    "l_load_second_batch": second_batch,
    "l_reload_smaller_batch": reload_smaller_batch,
    "l_batch_checks": batch_checks,
    "q_dq_missingness_stored": lambda spark, sf: quality.missingness_of(_summarised(spark, sf, "counts")),
    "q_dq_visit_completeness_stored": lambda spark, sf: quality.visit_completeness_of(_summarised(spark, sf, "visits")),
    "l_route_rows": routed,
    "l_skipped_sheets": lambda spark, sf: skipped_sheets(spark_form(spark, sf, "sheets")),
    "e_checkpoint": checkpoint,
    "l_check_linkage_pairs": lambda spark, sf: checks.check_unique(linkage(spark, sf).select(
        F.expr("study_a_subject_key div 40").alias("a"), F.expr("study_c_subject_key div 40").alias("c")), ["a", "c"]),
    "l_check_registry": lambda spark, sf: checks.check_registry(
        _dirty_facts(spark, sf), domain_registry(spark)),
    "l_check_not_null": lambda spark, sf: checks.check_not_null(_dirty_facts(spark, sf)),
    "l_check_fk": lambda spark, sf: checks.check_fk(_dirty_facts(spark, sf), spark_subjects(spark, sf)),
    "l_check_subject_ids": check_subject_ids,
}
