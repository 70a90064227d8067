"""Raw layer: one immutable landed copy of the sources per run, with record numbers and a manifest."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.errors import MissingSource, SnapshotConflict
from ledgerloom.sources.fingerprint import file_fingerprints
from ledgerloom.sources.paths import layer_path, path_exists
from ledgerloom.sources.raw import POSITION, read_quoted_csv, read_raw_csv, read_raw_json_array, read_raw_json_lines

# In `csv` quoted text may hold line ends. It is scanned twice; `csv_lines` reads files without such texts in one scan.
READERS: dict[str, Callable[[SparkSession, str, Sequence[str] | None], DataFrame]] = {
    "csv": read_quoted_csv,
    "csv_lines": read_raw_csv,
    "json": lambda spark, path, columns: read_raw_json_array(spark, path),
    "jsonl": lambda spark, path, columns: read_raw_json_lines(spark, path),
}


@dataclass(frozen=True)
class Source:
    dataset: str
    path: str
    format: str
    columns: tuple[str, ...] | None = None  # of a CSV source; by default as its first header says


def write_positioned(raw: DataFrame, path: str) -> None:
    """Materialize positioned records plus the small table of splits with their first record number.

    The positions are written before they are used, so a lost executor cannot renumber anything.
    """
    spark = raw.sparkSession
    raw.write.mode("overwrite").parquet(f"{path}/records", compression="zstd")
    blocks = (
        spark.read.parquet(f"{path}/records").groupBy("_file", "_block")
        .agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("records"))
    )
    # Splits are summed up file by file; only the files' totals, one row each, are summed up in one place.
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    files = blocks.groupBy("_file").agg(F.sum("records").alias("_total"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_start", F.coalesce(F.sum("_total").over(earlier), F.lit(0))).drop("_total")
    offset = F.col("_start") + F.coalesce(F.sum("records").over(before), F.lit(0))
    blocks.join(files, "_file").withColumn("_offset", offset).drop("_start").write.mode("overwrite").parquet(f"{path}/blocks")


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """Landed records with `source_record_number`. The split table has a known file size, so the
    planner broadcasts it while it is small and sort-merges beyond the threshold."""
    records = spark.read.parquet(f"{path}/records")
    blocks = spark.read.parquet(f"{path}/blocks").select("_file", "_block", "_first", "_offset")
    number = F.col("_offset") + F.col("_row") - F.col("_first") + 1
    return records.join(blocks, ["_file", "_block"]).withColumn("source_record_number", number).drop(
        *POSITION, "_first", "_offset")


def land(spark: SparkSession, root: str, run_id: str, sources: list[Source]) -> DataFrame:
    """Land all sources of a run and return the manifest.

    The sources are fingerprinted, read, and fingerprinted again; only if both agree is the manifest written, and
    without a manifest nothing can be read. A run that has one accepts the same bytes again and refuses others.
    """
    absent = [s.path for s in sources if not path_exists(spark, s.path)]
    if absent:
        raise MissingSource("nothing to land at " + ", ".join(absent))
    manifest_path = layer_path(root, "raw", run_id, "manifest")
    if path_exists(spark, f"{manifest_path}/_SUCCESS"):
        recorded = spark.read.parquet(manifest_path)
        if not changed_files(recorded, _fingerprints(spark, sources)).isEmpty():
            raise SnapshotConflict(f"{run_id} was landed from other bytes; land these under a run id of their own")
        return recorded

    # Written before anything is read: a lazy one would only be computed afterwards.
    seen_path = layer_path(root, "raw", run_id, "fingerprints")
    _fingerprints(spark, sources).write.mode("overwrite").parquet(seen_path)
    seen = spark.read.parquet(seen_path)
    for source in sources:
        write_positioned(READERS[source.format](spark, source.path, source.columns),
                         layer_path(root, "raw", run_id, source.dataset))
    if not changed_files(seen, _fingerprints(spark, sources)).isEmpty():
        raise SnapshotConflict(f"a source was written to while {run_id} was landing it; nothing of it can be read")
    manifest = seen.join(_landed_counts(spark, root, run_id, sources), ["dataset", "file"], "left")
    manifest = manifest.withColumns({"records": F.coalesce("records", F.lit(0)), "pipeline_run_id": F.lit(run_id)})
    manifest.write.mode("overwrite").parquet(manifest_path)
    return spark.read.parquet(manifest_path)


def read_landed(spark: SparkSession, root: str, run_id: str, dataset: str) -> DataFrame:
    read_manifest(spark, root, run_id)  # without one the landing was refused or never ended
    return read_numbered(spark, layer_path(root, "raw", run_id, dataset))


def read_manifest(spark: SparkSession, root: str, run_id: str) -> DataFrame:
    path = layer_path(root, "raw", run_id, "manifest")
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise MissingSource(f"{run_id} has no landed sources")
    return spark.read.parquet(path)


def changed_files(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Files that are new, gone or hold other bytes than recorded."""
    left = recorded.select("dataset", "file", F.col("sha256").alias("recorded_sha256"))
    right = current.select("dataset", "file", F.col("sha256").alias("current_sha256"))
    both = left.join(right, ["dataset", "file"], "full")
    return both.where(~F.col("recorded_sha256").eqNullSafe(F.col("current_sha256")))


def matches_source(recorded: DataFrame, current: DataFrame) -> DataFrame:
    """Per recorded file: does the landed fingerprint still match the source?"""
    now = current.select("dataset", "file", F.col("sha256").alias("_now"))
    return recorded.join(now, ["dataset", "file"], "left").withColumn(
        "matches_source", F.col("sha256").eqNullSafe(F.col("_now"))).drop("_now")


def _fingerprints(spark: SparkSession, sources: list[Source]) -> DataFrame:
    parts = [file_fingerprints(spark, s.path).select(F.lit(s.dataset).alias("dataset"), "file", "bytes", "sha256", "chunk_bytes")
             for s in sources]
    return _union(parts)


def _landed_counts(spark: SparkSession, root: str, run_id: str, sources: list[Source]) -> DataFrame:
    parts = []
    for s in sources:
        blocks = spark.read.parquet(layer_path(root, "raw", run_id, s.dataset) + "/blocks")
        parts.append(blocks.groupBy(F.col("_file").alias("file")).agg(F.sum("records").alias("records"))
                     .select(F.lit(s.dataset).alias("dataset"), "file", "records"))
    return _union(parts)


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
