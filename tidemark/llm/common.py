"""What the training-data operators share."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def project(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns only, matched by exact case and first place.

    Other columns may repeat or differ in case only ("TEXT" beside "text"):
    columns are renamed by place first, so no reference is ambiguous.
    """
    have = df.columns
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"columns {missing} are missing; there are {have}")
    placed = df.toDF(*[f"__c{i}" for i in range(len(have))])
    return placed.select(*[F.col(f"__c{have.index(n)}").alias(n) for n in names])


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is named, and only on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemark_path = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes what written() wrote; for tables that nothing still to be worked out reads."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(df._tidemark_path)
    path.getFileSystem(conf).delete(path, True)


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go as soon as it ends, not when the driver happens to collect its frame.

    A frame that is made outside, as one handed to a caller, keeps them for a second run.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_bytes() -> Column:
    """UTF-8 of the text; null counts as empty."""
    return F.coalesce(F.col("text"), F.lit("")).cast("binary")


def fold(modulus: int) -> Column:
    """crc32 of the doc_id as text, modulo modulus; a null doc_id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """What make gives, kept by this Python worker for its next tasks with the same key.

    One thing is kept at a time, so what an operator remembers bounds the worker's memory.
    """
    kept = sys.modules.setdefault("_tidemark_kept", types.ModuleType("_tidemark_kept"))
    if getattr(kept, "key", None) != key:
        kept.key = kept.value = None
        kept.value = make()
        kept.key = key
    return kept.value


def keep_freed() -> None:
    """Freed memory stays with the process for its next arrays, up to 128 MB, until trim(): else the system clears new pages for each of them."""
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 32 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 128 << 20)  # M_TRIM_THRESHOLD
    except (AttributeError, OSError):
        pass


def trim() -> None:
    """Gives freed memory back to the system, at a task's end: workers live on beside each other."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass
