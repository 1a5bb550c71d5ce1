"""Helpers shared by the training-data operators.

Row identity.  ``doc_id`` may be null or repeated, so results are carried
back to rows by ``(doc_id, text hash)``, compared null-safe.  Rows that agree
in both get the same result, and every one of them is kept.

Intermediate tables go to the folder that ``spark.checkpoint.dir`` names
(shared by all executors), as compressed Parquet; lineage ends there.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.session import checkpoint_dir

#: Rows of fixed width that may be broadcast after they have been counted.
BROADCAST_ROWS = 1_000_000
#: Bytes that may be broadcast after they have been measured.
BROADCAST_BYTES = 16 << 20


def new_folder(spark: SparkSession, tag: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/leafline-{tag}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, tag: str, batch_rows: int = 2000) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    ``batch_rows`` bounds the rows of an Arrow batch sent to Python meanwhile."""
    spark = df.sparkSession
    path, key = new_folder(spark, tag), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str | Column) -> Column:
    """A null text counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit(""))


def same_row(a: DataFrame, b: DataFrame, *keys: str) -> Column:
    """Null-safe equality of the key columns of two frames."""
    cond = None
    for k in keys:
        c = a[k].eqNullSafe(b[k])
        cond = c if cond is None else cond & c
    return cond


def small_side(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow frame for broadcast if it has at most ``max_rows`` rows.

    The frame is counted first; a larger one is returned unmarked and joins
    by shuffle.  Callers pass fixed-width columns only."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def measured_side(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a frame for broadcast if its rows take at most ``max_bytes``: strings
    by their bytes, other columns as 16 bytes.

    The frame is read once to measure it; a larger one is returned unmarked
    and joins by shuffle, where adaptive execution splits hot keys."""
    width = F.lit(0).cast("bigint")
    for name, kind in df.dtypes:
        width = width + (F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)) + 16 if kind == "string" else F.lit(16))
    size = df.select(width.alias("_w")).agg(F.sum("_w")).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def give_back() -> None:
    """Return freed memory of a Python worker to the machine.

    Workers are used again by later stages and would otherwise keep their greatest size."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not a glibc system
        pass


def giving_back(work: Callable) -> Callable:
    """``work`` over a task's batches; once its own values are gone, their memory goes back to the machine."""
    def run(batches: Iterator) -> Iterator:
        yield from work(batches)
        give_back()

    return run
