"""Stored schemas, study codes and the domain registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STUDY_A, STUDY_B, STUDY_C = "STUDY_A", "STUDY_B", "STUDY_C"
STUDIES = (STUDY_A, STUDY_B, STUDY_C)

VISIT_TYPE = T.DecimalType(10, 2)

SUBJECTS = T.StructType([
    T.StructField("subject_key", T.LongType()),
    T.StructField("source_study", T.StringType()),
    T.StructField("studyid", T.StringType()),
    T.StructField("subjid", T.StringType()),
    T.StructField("scrno", T.StringType()),
    T.StructField("record_id", T.StringType()),
])

FACTS = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("fact_id", T.LongType()),
    T.StructField("subject_key", T.LongType()),
    T.StructField("source_study", T.StringType()),
    T.StructField("standard_var", T.StringType()),
    T.StructField("standard_label", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("value_code", T.StringType()),
    T.StructField("seqnum", T.IntegerType()),
    T.StructField("visitnum", VISIT_TYPE),
])

LINKAGE = T.StructType([
    T.StructField("linkage_id", T.LongType()),
    T.StructField("study_a_subject_key", T.LongType()),
    T.StructField("study_c_subject_key", T.LongType()),
    T.StructField("linkage_type", T.StringType()),
])

#: Columns of a fact that must not be null.
REQUIRED = ("subject_key", "source_study", "standard_var")

#: Fact ids of one study lie between two multiples of this.
ID_SPAN = 1 << 56

# The domains every study collects, and those only STUDY_A collects.
SHARED_DOMAINS = ("dm", "ds", "sv", "mh", "pe", "vs", "be", "bs", "ie", "cm", "eos", "co")
STUDY_A_DOMAINS = ("ex", "ae", "lb")
DOMAINS = SHARED_DOMAINS + STUDY_A_DOMAINS

# Scheduled visits per participant.
EXPECTED_VISITS = {STUDY_A: 13, STUDY_B: 3, STUDY_C: 3}

# Dosing visits and the dose each one gives.
DOSE_OF_VISIT = {2: 1, 6: 2, 11: 3}


def domain_registry(spark: SparkSession) -> DataFrame:
    rows = [(d.upper(), d, ",".join(STUDIES)) for d in SHARED_DOMAINS]
    rows += [(d.upper(), d, f"{STUDY_A} only") for d in STUDY_A_DOMAINS]
    return spark.createDataFrame(rows, "standard_domain string, table_name string, applies_to string")
