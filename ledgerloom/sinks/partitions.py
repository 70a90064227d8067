"""Month-partitioned Parquet: layout, writing and guarded reading.

A month may hold any share of the rows. The rebalance hint groups rows by month without fixing one
task per month: adaptive execution cuts a large month into several files and packs small ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.errors import MisfiledRows, MissingSource
from ledgerloom.functions.hashing import packed_hash, unpacked_hash
from ledgerloom.sinks.metrics import ROWS, counted_write
from ledgerloom.sources.paths import path_exists

PARTITION_COLUMNS = ("order_year", "order_month")
COMPRESSION = "zstd"  # the text of a hash has four bits to the byte; the default compression leaves it as long as it is


def partition_key(year: Column, month: Column) -> Column:
    return F.concat(F.lit("order_year="), year.cast("string"), F.lit("/order_month="), month.cast("string"))


def partition_name(year: int, month: int) -> str:
    return f"order_year={int(year)}/order_month={int(month)}"


def with_partition(df: DataFrame, timestamp: str = "order_timestamp") -> DataFrame:
    return df.withColumns({"order_year": F.year(timestamp), "order_month": F.month(timestamp)})


def partition_counts(df: DataFrame, timestamp: str = "order_timestamp") -> DataFrame:
    keyed = with_partition(df.select(timestamp), timestamp)
    counts = keyed.groupBy(*PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("partition_key", partition_key(F.col("order_year"), F.col("order_month")))


def outside_month(df: DataFrame, year: int, month: int, timestamp: str = "order_timestamp") -> Column:
    return F.coalesce((F.year(timestamp) != year) | (F.month(timestamp) != month), F.lit(True))


def require_month(df: DataFrame, year: int, month: int, where: str) -> None:
    outside = df.agg(F.count_if(outside_month(df, year, month)).alias("n")).first()["n"]
    if outside:
        raise MisfiledRows(f"{outside} row(s) in {where} do not belong to {year}-{month:02d}")


def packed(df: DataFrame) -> DataFrame:
    """Rows as they go through a shuffle: their hash as bytes."""
    return df.withColumn("record_hash", packed_hash()) if "record_hash" in df.columns else df


def unpacked(df: DataFrame) -> DataFrame:
    return df.withColumn("record_hash", unpacked_hash()) if "record_hash" in df.columns else df


def by_month(df: DataFrame) -> DataFrame:
    return with_partition(df).hint("rebalance", *PARTITION_COLUMNS)


def in_order(df: DataFrame) -> DataFrame:
    return df.sortWithinPartitions(*PARTITION_COLUMNS, "order_timestamp", "order_id")


def arranged(df: DataFrame) -> DataFrame:
    """Rows laid out for a partitioned write: grouped by month, sorted by time and id within a file."""
    return in_order(by_month(df))


def write_months(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Write a new, not yet published location, or with `append` more rows to one; the number of rows written, counted on the way."""
    return counted_write(unpacked(by_month(packed(df))), lambda rows: in_order(rows).write.mode(mode).option(
        "compression", COMPRESSION).partitionBy(*PARTITION_COLUMNS).parquet(path))[ROWS]


def write_manifest(spark: SparkSession, path: str, manifest: str, run: str = "pipeline_run_id") -> DataFrame:
    """Record what a written location holds: (order_year, order_month, partition_key, run, row_count, first_at, last_at), a row for each
    month and run id, from one scan of two columns. The manifest is written last and read back."""
    held = spark.read.parquet(path).groupBy(*PARTITION_COLUMNS, run).agg(
        F.count(F.lit(1)).alias("row_count"), F.min("order_timestamp").alias("first_at"), F.max("order_timestamp").alias("last_at"))
    keyed = held.withColumn("partition_key", partition_key(F.col("order_year"), F.col("order_month")))
    keyed.write.mode("overwrite").parquet(manifest)
    return spark.read.schema(keyed.schema).parquet(manifest)


def read_month_directory(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """Exactly one month folder, checked: it must exist and hold only rows of its month."""
    path = f"{root}/{partition_name(year, month)}"
    if not path_exists(spark, path):
        raise MissingSource(f"partition {year}-{month:02d} not found at {path}")
    rows = spark.read.option("basePath", root).parquet(path)
    require_month(rows, year, month, path)
    return rows


def read_month_pruned(spark: SparkSession, root: str, year: int, month: int) -> DataFrame:
    """Partition filter on the whole dataset: the planner lists and opens only the month's files."""
    month_only = (F.col("order_year") == year) & (F.col("order_month") == month)
    return spark.read.parquet(root).where(month_only)


def month_range(df: DataFrame, year: int, month: int, timestamp: str = "order_timestamp") -> DataFrame:
    """Half-open time range, so row groups are skipped by their min/max statistics."""
    following = (year + 1, 1) if month == 12 else (year, month + 1)
    kind = dict(df.dtypes)[timestamp]
    start, end = (F.lit(f"{y:04d}-{m:02d}-01 00:00:00").cast(kind) for y, m in ((year, month), following))
    return df.where((F.col(timestamp) >= start) & (F.col(timestamp) < end))


def files_read(df: DataFrame) -> DataFrame:
    """(files, bytes) that actually contribute rows to a scan."""
    per_file = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("s"), F.lit(0)).alias("bytes"))
