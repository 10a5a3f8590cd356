"""Helpers of the operators: tables, written intermediate results, files in the shared folder."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import is_small
from ..session import configure, work_path

#: Rows of one Arrow batch. Texts can be long, so a batch stays far below the default of 10,000 rows.
BATCH_ROWS = 256

#: Bytes of one Arrow batch, unless a row alone is longer: the arrays of a task grow with the batch.
BATCH_BYTES = 4 * 1024 * 1024

#: Largest lookup that is broadcast; a larger one is joined by shuffle.
LOOKUP_BYTES = 16 * 1024 * 1024


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def give_back() -> None:
    """Hand freed memory of this process back to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_batches(rows: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` whose workers give their freed memory back at the end of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(batches)
        finally:
            give_back()

    return rows.mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a result once into the shared folder and go on from the files: executors may be lost."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame) -> DataFrame:
    """The table with a broadcast hint if its measured size allows one. ``df`` should be written already."""
    return F.broadcast(df) if is_small(df, LOOKUP_BYTES) else df


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder in the shared storage (local path or URI)."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def fresh_folder(spark: SparkSession, name: str) -> str:
    """New folder in the shared storage for files that tasks write themselves."""
    uri = work_path(spark, name)
    system, path = store(uri)
    system.create_dir(path, recursive=True)
    return uri


def attempt_name(prefix: str, number: int, suffix: str) -> str:
    """File name of one task attempt. Only files that a committed table names are read, so a lost or
    repeated attempt leaves at most an unread file behind."""
    return f"{prefix}-{number:06d}-{uuid.uuid4().hex[:12]}{suffix}"
