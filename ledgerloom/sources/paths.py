"""Where a run keeps its layers, on whatever file system the root names."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import SparkSession


def layer_path(root: str, layer: str, run_id: str, dataset: str | None = None) -> str:
    """Run ids are percent-encoded, so any text is one folder and no two ids share one."""
    return "/".join(filter(None, (root, layer, "run-" + quote(run_id, safe=""), dataset)))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none if it does not exist."""
    if not path_exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return [f.getPath().getName() for f in listed if f.isDirectory()]


def data_files(spark: SparkSession, path: str) -> int:
    """How many files Spark has written into a folder, not counting markers."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    return sum(f.isFile() and f.getPath().getName()[0] not in "._" for f in listed)


def remove(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
