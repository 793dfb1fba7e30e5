"""The fact store: Parquet by domain and study, and the place to cut long lineages."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cohortweave.schema import DOMAINS, FACTS, ID_SPAN, LINKAGE, REQUIRED, SHARED_DOMAINS, STUDIES, STUDY_A

PARTITIONS = ["domain", "source_study"]
BATCH = "batch"

#: A Bloom filter of each row group's subjects, as large as they need: a read of one subject skips the groups without it.
SUBJECT_FILTER = {"parquet.bloom.filter.enabled#subject_key": "true", "parquet.bloom.filter.adaptive.enabled": "true"}

#: Shuffled bytes that a task of a batch's write sorts: about 700,000 facts. Tasks of the usual 64 MB are few and uneven,
#: so cores wait for the last ones, and what they sort fits no cache.
WRITE_BYTES = 16 << 20
TASK_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it for checkpoints. Only a
    local session may fall back to a folder of its own."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="cohortweave-")
        context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a table in the shared folder and read it back.

    Columnar, so later reads are pruned; on shared storage, so it outlives executors; and
    of known size, so joins against it are planned from facts.
    """
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batch_folder(path: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError("a batch is named by letters, digits, '_', '.' and '-'")
    return f"{path}/{BATCH}={batch}"


@contextmanager
def _tasks_of(spark: SparkSession, size: int) -> Iterator[None]:
    """AQE cuts rebalanced rows into tasks of ``size`` shuffled bytes at most inside the ``with``; a smaller size of the session holds."""
    own = spark.conf.get(TASK_BYTES, None)
    number, unit = re.fullmatch(r"(\d+)([kmg]?)b?", str(own or size).lower()).groups()
    spark.conf.set(TASK_BYTES, min(size, int(number) << {"": 0, "k": 10, "m": 20, "g": 30}[unit]))
    try:
        yield
    finally:
        if own is None:
            spark.conf.unset(TASK_BYTES)
        else:
            spark.conf.set(TASK_BYTES, own)


def write_facts(facts: DataFrame, path: str, batch: str = "first") -> dict[str, int]:
    """Store a batch of facts: one directory per batch and in it per (domain, study), sorted by variable and
    subject so that row-group statistics skip reads of one variable, and a Bloom filter reads of one subject.

    Other batches stay as they are. A batch is written as a whole: writing it again replaces all of it, also what the
    new rows have no domain for. The rebalance hint lets AQE size the files
    (``WRITE_BYTES``): a domain or study holding most of the data is split
    over many tasks and files, small ones share a task.

    Returns what was seen of the stored rows on their way (no second scan): their number, and how many break the
    not-null rules or stand in a domain that is not their study's.
    """
    out = facts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FACTS.fields])
    allowed = [(d, s) for s in STUDIES for d in (DOMAINS if s == STUDY_A else SHARED_DOMAINS)]
    known = F.concat_ws("/", "domain", "source_study").isin(*["/".join(pair) for pair in allowed])
    rules = {"n_rows": F.count("*"), **{f"null_{c}": F.count_if(F.col(c).isNull()) for c in REQUIRED},
             "not_in_registry": F.count_if(~known)}
    seen = Observation(f"batch-{uuid.uuid4().hex}")
    checked = out.observe(seen, *[rule.alias(name) for name, rule in rules.items()])
    with _tasks_of(facts.sparkSession, WRITE_BYTES):
        (checked.hint("rebalance", *PARTITIONS)
            .sortWithinPartitions(*PARTITIONS, "standard_var", "subject_key")
            .write.mode("overwrite").options(**SUBJECT_FILTER).partitionBy(*PARTITIONS).parquet(batch_folder(path, batch)))
    try:
        return seen.get
    except Py4JJavaError:  # written, but from a plan that Spark knew to have no rows: such a plan observes nothing
        return dict.fromkeys(rules, 0)


def write_linkage(pairs: DataFrame, path: str, batch: str = "first") -> None:
    """Store a batch of linkage pairs, replacing it if it is there already."""
    out = pairs.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LINKAGE.fields])
    out.write.mode("overwrite").parquet(batch_folder(path, batch))


def _read(spark: SparkSession, path: str, kind: StructType, without: str | None) -> DataFrame:
    stored = spark.read.schema(StructType([*kind.fields, StructField(BATCH, StringType())])).parquet(path)
    if without is not None:
        stored = stored.where(F.col(BATCH) != without)
    return stored.select(*kind.fieldNames())


def read_linkage(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """All stored pairs, or those of every batch but ``without``: what a batch, also a repeated one, must not add again."""
    return _read(spark, path, LINKAGE, without)


def after_stored(facts: DataFrame, stored: DataFrame) -> DataFrame:
    """``facts`` with ids that follow the largest stored id of their domain and study, so that
    a later batch repeats none. ``stored`` is the store without the batch itself
    (``read_facts(..., without=batch)``)."""
    def low(column: str):
        return F.col(column) % F.lit(ID_SPAN)

    # a row per directory of the store: broadcast, or every fact would be shuffled once more, by a few dozen keys
    last = stored.groupBy(*PARTITIONS).agg(F.max(low("fact_id")).alias("_last"))
    return facts.join(F.broadcast(last), PARTITIONS, "left").withColumn(
        "fact_id", F.col("fact_id") + F.coalesce("_last", F.lit(0))).drop("_last")


def write_domains(rows: DataFrame, path: str) -> None:
    """The audit checkpoint between unpivoting and loading, one directory per domain."""
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*PARTITIONS).parquet(path))


def read_facts(spark: SparkSession, path: str, without: str | None = None) -> DataFrame:
    """All stored facts, or those of every batch but ``without``."""
    return _read(spark, path, FACTS, without)


def read_domains(spark: SparkSession, path: str) -> DataFrame:
    """The audit checkpoint with its domains and studies, as text."""
    written = spark.read.parquet(path)
    return written.select(*[F.col(c).cast("string").alias(c) if c in PARTITIONS else F.col(c) for c in written.columns])
