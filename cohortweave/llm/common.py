"""What the operators of this folder share: staged tables, words, batches, hashing."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Texts are handled in slices of about so many bytes inside a task; a longer text is a slice of its own.
SLICE_BYTES = 4_000_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Whole texts, or sets of their n-grams, in one Arrow batch: a few megabytes, not the tens of the usual 10,000 rows.
TEXT_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only a local session (tests) that names none gets a folder of its own, set once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-stages-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def staged(df: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: it is computed
    once, survives lost executors, and its size is known to the planner. ``batch_rows``: rows of an Arrow batch on the
    way (null: the session's), which both the JVM and the Python worker hold, several times over."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    own = spark.conf.get(ARROW_ROWS, None)
    if batch_rows is not None:
        spark.conf.set(ARROW_ROWS, batch_rows)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if batch_rows is not None and own is None:
            spark.conf.unset(ARROW_ROWS)
        elif batch_rows is not None:
            spark.conf.set(ARROW_ROWS, own)
    return spark.read.schema(df.schema).parquet(path)


def staged_by(df: DataFrame, *keys: str) -> DataFrame:
    """Like ``staged``, in buckets of ``keys``, as many as there are shuffle partitions: a later join on
    the keys reads the table without moving it. Rows should already lie by the keys."""
    spark = df.sparkSession
    name = f"llm_{uuid.uuid4().hex}"
    (df.write.option("compression", "zstd").option("path", f"{shared_folder(spark)}/{name}")
       .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).saveAsTable(name))
    return spark.table(name)


class Buckets:
    """Tables in buckets, sorted by their key, for the joins inside a ``with``: each join on the key reads them
    without moving or sorting. At the end their names leave the catalog (a plan made inside must have run)."""

    def __init__(self, spark: SparkSession):
        self.spark, self.names = spark, []

    def __enter__(self) -> Buckets:
        return self

    def __exit__(self, *_) -> None:
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def staged(self, df: DataFrame, key: str, distinct: bool = False) -> DataFrame:
        """``distinct``: of equal rows one, found where they lie by the key."""
        name = f"llm_{uuid.uuid4().hex}"
        self.names.append(name)
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartition(buckets, key)
        rows = rows.distinct() if distinct else rows
        (rows.write.option("compression", "zstd").option("path", f"{shared_folder(self.spark)}/{name}")
           .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
        return self.spark.table(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def binary(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding."""
    if pa.types.is_large_string(column.type):
        return column.cast(pa.large_binary()).to_pylist()
    return column.cast(pa.binary()).to_pylist()


def spans(sizes: Iterable[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items of about ``limit`` bytes each; a larger item is a range of its own."""
    start, held, n = 0, 0, 0
    for n, size in enumerate(sizes, 1):
        if held and held + size > limit:
            yield start, n - 1
            start, held = n - 1, 0
        held += size + 1
    if start < n:
        yield start, n


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of about ``limit`` bytes each."""
    return spans(map(len, texts), limit)


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over an array of unsigned longs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
