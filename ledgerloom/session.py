"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Timestamps are UTC instants everywhere, so text <-> timestamp conversions must not depend on the
# cluster's local zone. The adaptive settings split hot join keys and hot partition months at run time.
# The JVM does not compile methods of more than 8000 bytes, and the rules of a record in one method have more: beyond that
# size Spark generates them as many small methods.
# Shuffle files are removed when the query that wrote them ends, not when the driver happens to collect garbage: a job of many
# queries then needs the disk of its largest one. What is asked for again is computed again.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(app: str, cpus: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # Stack traces per column expression make building a wide plan slower than running a small one.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="ledgerloom-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for one materialization; never reused, so a rerun cannot read half-written data."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"
