"""Helpers shared by the operators: inputs, sizing, shared storage, hashing of words."""

from __future__ import annotations

import math
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import DEFAULT_CONF, checkpoint_dir, discard, materialize, ship_package

__all__ = ["prepare", "documents", "table", "input_bytes", "parts_for", "shared_dir", "open_fs", "materialize", "discard",
           "WS", "crc_mod", "batches"]

# ASCII white space that separates words: space and U+0009 to U+000D.
WS = "[\\x20\\x09-\\x0D]+"


def prepare(spark: SparkSession) -> None:
    """Settings and package code that every operator needs; safe to call again. What an operator before it
    has freed on the driver goes back to the system."""
    free_memory()
    for k in ("spark.sql.session.timeZone", "spark.sql.execution.arrow.pyspark.enabled"):
        spark.conf.set(k, DEFAULT_CONF[k])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")  # whole texts: a few MB each
    checkpoint_dir(spark)
    ship_package(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def input_bytes(df: DataFrame) -> int:
    """Size the planner knows for ``df`` (file bytes for a plain scan); no job is run. Where it
    knows none (rows from Python, products of joins), 16 MB for each shuffle partition."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 1 << 56 else int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) << 24


def parts_for(df: DataFrame, bytes_each: int = 16 << 20, least: int = 1) -> int:
    """Partitions so that each holds about ``bytes_each`` of the input's files."""
    return max(least, math.ceil(input_bytes(df) / bytes_each))


def shared_dir(spark: SparkSession, what: str) -> str:
    """A new folder name under the shared checkpoint folder (as a URI with a scheme)."""
    base = checkpoint_dir(spark).rstrip("/")
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base
    return f"{base}/llm/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def open_fs(uri: str):
    """(file system, path) of a URI for use inside tasks; any store that pyarrow knows."""
    from pyarrow import fs
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def crc_id(col: str):
    """Unsigned crc32 of the id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary"))


def crc_mod(col: str, m: int):
    """crc32 of the id written as text, modulo m; a null id counts as the empty text."""
    return crc_id(col) % m


def batches(column):
    """Python strings of an Arrow string column, nulls as empty texts."""
    return ["" if t is None else t for t in column.to_pylist()]


def listed(column) -> list:
    """Python values of an Arrow string or binary column; at a tenth of the time that to_pylist takes."""
    return column.to_numpy(zero_copy_only=False).tolist()


def free_memory() -> None:
    """Give memory that a task (or the driver) has freed back to the system: Python workers live on and serve
    later stages, beside an executor's heap that does not shrink; so does the driver's Python beside its JVM."""
    import ctypes

    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def run_bounds(a: np.ndarray) -> np.ndarray:
    """Start positions of the runs of equal values of ``a``, with len(a) at the end."""
    if not len(a):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(a[1:] != a[:-1]) + 1, [len(a)]])
