"""Readers: dictionaries, wide forms, markdown documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.functions.text import blank_to_null
from cohortweave.operators.unpivot import ROW


def read_dictionary(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """A crosswalk CSV, every column as text, with its row order kept in ``dict_row``."""
    raw = spark.read.csv(path, header=True, encoding=encoding, multiLine=True, escape='"')
    return raw.withColumn("dict_row", F.monotonically_increasing_id())


def read_forms(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> dict[str, DataFrame]:
    """Wide forms by upper-cased name. Cells are read as text, so ``1`` stays ``1``;
    the files carry ``source_row_number``."""
    forms = {}
    for name, path in paths.items():
        df = (spark.read.csv(path, header=True, multiLine=True, escape='"') if fmt == "csv"
              else spark.read.format(fmt).load(path))
        if ROW not in df.columns:
            raise KeyError(f"form {name} has no column {ROW}")
        forms[name.upper()] = df.select(*[
            F.col(f"`{c}`").cast("bigint" if c == ROW else "string").alias(c) for c in df.columns])
    return forms


def read_markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Every ``*.md`` below ``folder``, one whole document per row."""
    raw = spark.read.text(folder, wholetext=True, pathGlobFilter="*.md", recursiveFileLookup=True)
    return raw.select(F.col("_metadata.file_path").alias("doc_id"),
                      blank_to_null(F.col("value")).alias("text"))
