"""What the corpus operators share: patterns of the contracts, the shared scratch folder, and row keys."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, and where that is unset a folder in the
    session's warehouse, which they share as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder.rstrip("/") if folder else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/tillroll-shared"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; reruns never meet the files of an earlier run."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """`df` written once as Parquet in the shared folder and read again: lineage ends there, lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def first_of(packed: DataFrame, *keys: str) -> DataFrame:
    """One row for each value of `keys` of (keys, whole): the one whose struct `whole` hashes lowest, so that reruns agree.

    Rows of equal hash are equal in all columns, but for collisions of 64 bits among rows that share the keys.
    """
    parts = packed.schema["whole"].dataType.names
    own = F.xxhash64(*[x for c in parts for x in (F.col(f"whole.`{c}`"), F.col(f"whole.`{c}`").isNull())])
    return packed.groupBy(*keys).agg(F.min_by("whole", own).alias("whole"))


Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return memory that this process has freed to the system; Python workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(scan: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The same scan over batches; when a task is through with it, its memory does not stay with the worker."""

    def run(batches: Batches) -> Batches:
        try:
            yield from scan(batches)
        finally:
            give_back()

    return run


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand at most `rows` rows at once to Python, for rows of megabytes; the setting comes back after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))
