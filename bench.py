"""Headline queries and storage measurements; prints one JSON line.

Reads go to a noop sink, so every row and column is produced and nothing is collected. Each measurement
is one untimed warm-up and the median of the timed runs (BENCH_REPEATS, default 3).
"""

from __future__ import annotations

import json
import os
import sys
import timeit
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import functions as F  # noqa: E402

from ledgerloom.operators import contract  # noqa: E402
from ledgerloom.plans import formats, rawtext, tables  # noqa: E402
from ledgerloom.plans.catalog import MONTH, QUERIES, YEAR  # noqa: E402
from ledgerloom.plans.pipeline import Pipeline  # noqa: E402
from ledgerloom.plans.tables import LIMITS  # noqa: E402
from ledgerloom.session import local_session, scratch_path  # noqa: E402
from ledgerloom.sinks.partitions import write_months  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))

DECLARATIVE = (
    "latest_version_dedup", "superseded_versions", "order_rule_reasons", "order_lines_curated",
    "order_lines_amounts", "record_hashes", "orphan_classification", "contract_check_counts", "upsert_counts",
    "upsert_result", "partition_counts", "month_range_scan", "normalized_documents", "run_state_log",
)


def read_all(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session("bench", CPUS)
    seconds: dict[str, float] = {}
    rows: dict[str, int] = {}

    def measure(name, action, repeats=REPEATS):
        seconds[name] = round(formats.seconds(action, repeats), 4)

    for name in DECLARATIVE:
        measure(name, lambda: read_all(QUERIES[name](spark, SF_DIR)))

    # The curated rows in every storage format.
    base = scratch_path(spark, "bench")
    tables.curated_lines(spark, SF_DIR).write.parquet(f"{base}/curated")
    curated = spark.read.parquet(f"{base}/curated")
    rows["curated"] = curated.count()
    for fmt in formats.FORMATS:
        path = f"{base}/{fmt.name}"
        if fmt.name == "csv_typed_read":
            path = f"{base}/csv"
        else:
            measure(f"{fmt.name}_write", lambda: fmt.write(curated, path))
        frame = fmt.read(spark, path, curated.schema)
        measure(f"{fmt.name}_full_read", lambda: read_all(frame))
        if fmt.name != "csv_typed_read":
            urgent = frame.where(F.col("status") == "1-URGENT")
            measure(f"{fmt.name}_filtered_read", lambda: read_all(urgent))

    # One month, four ways.
    measure("partitioned_write", lambda: write_months(curated, f"{base}/months"))
    for name, frame in formats.month_readers(spark, f"{base}/curated", f"{base}/months", YEAR, MONTH).items():
        measure(f"month_{name}", lambda: read_all(frame))

    # The stages of a run over messy text sources.
    pipe = Pipeline(spark, f"{base}/run", rawtext.sources(spark, SF_DIR), LIMITS)
    timings = {}
    for run_id in ("run_1", "run_2"):
        for stage, func, args in (("extract", pipe.extract, ()), ("transform", pipe.transform, ()),
                                  ("load", pipe.load, ()), ("validate", pipe.validate, ()),
                                  ("load_partition", pipe.load_partition, (YEAR, MONTH))):
            result = {}
            timings[run_id, stage] = timeit.timeit(lambda: result.update(
                pipe.run_stage(stage.replace("_", "-"), run_id, func, *args)), number=1)
            rows[f"{stage}_in"] = result.get("rows_in") or result["rows_out"]
    for stage in ("extract", "transform", "validate"):
        seconds[f"stage_{stage}"] = round(timings["run_2", stage], 4)
    seconds["stage_load_first"] = round(timings["run_1", "load"], 4)
    seconds["stage_load_rerun"] = round(timings["run_2", "load"], 4)
    seconds["stage_load_partition_rerun"] = round(timings["run_2", "load_partition"], 4)
    contract.require_contract(pipe.curated(), LIMITS)

    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 4), "unit": "sec", "queries": seconds,
        "sf": SF_DIR.rsplit("sf", 1)[-1], "rows": rows, "cpus": CPUS, "repeats": REPEATS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
