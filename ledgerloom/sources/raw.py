"""Raw scans: every value as source text, with the position needed to number the records.

`_file`, `_block` and `_row` locate a record: the input split it came from and an id that increases
within that split. `sources.landing` turns them into 1-based record numbers without a global sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.errors import MissingSource
from ledgerloom.sources import splits
from ledgerloom.sources.paths import path_exists

POSITION = ("_file", "_block", "_row")


def require_path(spark: SparkSession, path: str, what: str) -> None:
    if not path_exists(spark, path):
        raise MissingSource(f"{what} not found at {path}")


# Quotes inside quoted text are doubled.
CSV = {"header": "true", "quote": '"', "escape": '"', "encoding": "UTF-8"}


def read_raw_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 multi_line: bool = False) -> DataFrame:
    """Header CSV, all text. Every file's header must be `columns`, by default those of the first file read.

    A record with more fields than the header stops the scan; one with fewer ends in nulls. Files whose quoted text holds line
    ends are read whole (`multi_line`); read line by line, a record that is short of fields stops the scan too, as it may be
    the first half of such a text.
    """
    require_path(spark, path, "CSV source")
    options = CSV | {"multiLine": str(multi_line).lower()}
    names = list(columns or spark.read.options(**options).csv(path).columns)
    fields = [T.StructField(c, T.StringType()) for c in (*names, "_line")]
    rows = spark.read.options(**options).schema(T.StructType(fields)).options(
        enforceSchema="false", columnNameOfCorruptRecord="_line").csv(path)
    # Lines that do not have one field for each column are kept in `_line`; a further parse tells long from short.
    wide = ", ".join(f"c{i} string" for i in range(len(names) + 1))
    more = F.from_csv("_line", wide, {"quote": '"', "escape": '"', "nullValue": "\u0000"})
    long = F.coalesce(more[f"c{len(names)}"].isNotNull(), F.lit(False))
    wrong = long if multi_line else F.col("_line").isNotNull()
    problem = F.concat(F.lit("MalformedSource: "), F.col("_file"), F.lit(" has a record that does not fit its header: "), F.col("_line"))
    checked = F.when(wrong, F.raise_error(problem).cast("string")).otherwise(F.col(names[0]))
    return _positioned(rows).withColumn(names[0], checked).drop("_line")


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV whose quoted texts may hold line ends, all text; a file is read in as many tasks as it has splits.

    The same rows as `read_raw_csv` reads with `multi_line`, for files whose quotes stand around fields and are doubled within.
    A file that ends inside quotes, a header that is not `columns` (by default that of the first file read), and a record with
    more fields than it stop the scan; one with fewer ends in nulls."""
    require_path(spark, path, "CSV source")
    one = CSV | {"multiLine": "true"}
    names = list(columns or spark.read.options(**one).csv(path).columns)
    found = splits.records(spark, path, splits.QuotedLines, "ends inside a quoted text")
    found = found.withColumn("text", F.regexp_replace("text", "\r$", ""))
    parse = {k: v for k, v in one.items() if k != "header"} | {"columnNameOfCorruptRecord": "_line"}
    wide = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)] + [T.StructField("_line", T.StringType())])
    rows = found.withColumn("f", F.from_csv("text", wide.simpleString()[7:-1].replace(":", " "), parse))
    header = F.array(*[F.lower(F.coalesce(F.trim(F.col(f"f.c{i}")), F.lit(""))) for i in range(len(names))])
    wanted = F.array(*[F.lit(n.strip().lower()) for n in names])
    long = F.col(f"f.c{len(names)}").isNotNull()
    problem = F.concat(F.lit("MalformedSource: "), F.col("_file"), F.when(F.col("first"), F.lit(" has another header: ")).otherwise(
        F.lit(" has a record that does not fit its header: ")), F.col("text"))
    wrong = F.coalesce(long, F.lit(False)) | F.col("first") & (header != wanted)
    # The check decides which rows stay, so no reader can prune it away.
    kept = rows.where(F.when(wrong, F.raise_error(problem).cast("boolean")).otherwise(~F.col("first")))
    return kept.select(*[F.col(f"f.c{i}").alias(n) for i, n in enumerate(names)], *POSITION)


def read_raw_json_array(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of records per file -> one row per record, its text in `record`; a file is read in as many tasks as it has splits.

    A file that is not one array, or has an item that is no JSON value, stops the scan. A file of no bytes has no records."""
    require_path(spark, path, "JSON source")
    problem, blanks = "is not one JSON array of records", F.lit(" \t\r\n")
    items = splits.records(spark, path, splits.ArrayItems, problem)
    text = F.trim(F.col("text"), blanks)
    opened = F.when(F.col("first"), F.when(F.startswith(text, F.lit("[")), F.substring(text, 2, 2**31 - 1))).otherwise(text)
    items = items.withColumn("text", opened)
    closed = F.when(F.col("last"), F.when(F.endswith("text", F.lit("]")), F.expr("substring(text, 1, length(text) - 1)"))).otherwise(F.col("text"))
    items = items.withColumn("text", closed)
    # As the one item of an array in an object the text must be a whole value: anything else in it breaks the object.
    items = items.withColumn("value", F.from_json(F.concat(F.lit('{"a":['), F.col("text"), F.lit("]}")), "a array<string>, _bad string",
                                                  {"columnNameOfCorruptRecord": "_bad"}))
    # Parsed before any filter on it: moved below, the filter would parse each value again.
    items = items.select(F.inline(F.array(F.struct("_file", "_block", "_row", "first", "last", "text", "value"))))
    sound = F.col("value._bad").isNull() & (F.size("value.a") == 1)
    nothing = F.col("first") & F.col("last") & (F.trim(F.col("text"), blanks) == "")
    failed = F.raise_error(F.concat(F.lit("MalformedSource: "), F.col("_file"), F.lit(f" {problem}"))).cast("boolean")
    kept = items.where(F.when(F.coalesce(sound, F.lit(False)), F.lit(True)).when(F.coalesce(nothing, F.lit(False)), F.lit(False)).otherwise(failed))
    return kept.select(F.element_at("value.a", 1).alias("record"), *POSITION)


def read_raw_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line -> its text in `record`; splittable."""
    require_path(spark, path, "JSON Lines source")
    lines = spark.read.text(path).withColumnRenamed("value", "record")
    return _positioned(lines.where(F.trim("record") != ""))  # numbered after blank lines are gone


def _positioned(scan: DataFrame) -> DataFrame:
    columns = scan.columns
    return scan.select(
        *columns, F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )


def count_records(raw: DataFrame) -> DataFrame:
    """Records per source file."""
    return raw.groupBy("_file").agg(F.count(F.lit(1)).alias("records"))
