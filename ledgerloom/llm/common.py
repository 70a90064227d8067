"""What the operators share: reading tables, written intermediate tables, Arrow helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is written inside goes to Python in batches of so many rows, for rows that hold whole texts."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def parts(df: DataFrame, rows_or_bytes: int, each: int) -> int:
    """Partitions for so much data: at least the session's shuffle setting, more as the data grows."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows_or_bytes // each))


def small(keys: DataFrame, rows: int = 500_000) -> DataFrame:
    """Marked for broadcast if it has at most `rows` rows (of a few numbers each); else joined as the planner sees fit."""
    return F.broadcast(keys) if keys.count() <= rows else keys


def total_bytes(df: DataFrame, column: str = "text") -> int:
    return df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0]


def release() -> None:
    """Return freed memory to the system: workers live on and would keep what their largest batch or group took."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each holds about `limit` bytes of one column, and at least one row."""
    for batch in batches:
        offset = 0
        while offset < batch.num_rows:
            count = batch.num_rows - offset
            while count > 1 and batch.column(column).slice(offset, count).nbytes > limit:
                count = (count + 1) // 2
            yield batch.slice(offset, count)
            offset += count
        release()


def ragged(values, lengths, kind: pa.DataType) -> pa.Array:
    """A list column from all values in one array and the length of each row's list."""
    import numpy as np

    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
