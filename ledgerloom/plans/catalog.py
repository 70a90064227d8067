"""Every registered query: one entry per operator, over whole driver tables or data derived from them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions import clean_text, collapse_spaces, parse_number, parse_utc, title_case
from ledgerloom.functions.hashing import TIMESTAMP_FORMAT, business_hash, packed_hash, unpacked_hash
from ledgerloom.functions.money import add_amounts
from ledgerloom.operators import contract, curate, merge, staging
from ledgerloom.operators.median import exact_median
from ledgerloom.operators.rules import not_in
from ledgerloom.operators.versions import duplicate_keys, duplicate_members, superseded
from ledgerloom.plans import formats, rawtext, report, tables
from ledgerloom.plans.pipeline import Pipeline
from ledgerloom.plans.tables import AT, LIMITS, LINE_COLUMNS, LINE_KEY, LINE_VERSION, OLD_RUN, RUN, table
from ledgerloom.session import configure, scratch_path
from ledgerloom.sinks import commits, history, partitions
from ledgerloom.sinks.table import MonthlyTable
from ledgerloom.sources.fingerprint import file_fingerprints
from ledgerloom.sources.landing import changed_files
from ledgerloom.sources.raw import count_records

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The month used where one month is asked for.
YEAR, MONTH = 1998, 3


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    QUERIES[build.__name__] = run
    return build


def as_text(name: str) -> Column:
    return F.date_format(F.col(name), TIMESTAMP_FORMAT).alias(name)


def _text_times(df: DataFrame) -> DataFrame:
    times = [n for n, t in df.dtypes if t.startswith("timestamp")]
    return df.withColumns({n: F.date_format(F.col(n), TIMESTAMP_FORMAT) for n in times})


# ------------------------------------------------------------------ versions

@query
def latest_version_dedup(spark, sf_dir):
    return _text_times(tables.current_lines(spark, sf_dir))


@query
def superseded_versions(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return _text_times(superseded(lines, list(LINE_KEY), tables.newest_first()))


@query
def duplicate_line_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), list(LINE_KEY))


@query
def duplicate_line_members(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return _text_times(duplicate_members(lines, list(LINE_KEY)))


@query
def duplicate_version_report(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(tables.line_id().alias("order_id"), "l_shipdate", "l_quantity")
    kept = tables.current_lines(spark, sf_dir).select(tables.line_id().alias("order_id"), "l_shipdate")
    return _text_times(report.duplicate_versions(lines, kept, "order_id", "l_shipdate"))


# ------------------------------------------------------------------ rules and staging

@query
def order_rule_reasons(spark, sf_dir):
    return tables.judged_lines(spark, sf_dir).select("order_id", "route", "reason_codes", "reason_detail")


@query
def staged_orders(spark, sf_dir):
    classified = staging.classify(rawtext.numbered(spark, sf_dir, "orders"), staging.orders(LIMITS))
    staged = staging.staged_rows(classified, staging.orders(LIMITS), RUN, AT)
    return _text_times(staged.drop("staged_at_utc"))


@query
def order_quarantine(spark, sf_dir):
    spec = staging.orders(LIMITS)
    classified = staging.classify(rawtext.numbered(spark, sf_dir, "orders"), spec)
    return staging.quarantine_rows(classified, spec, RUN, AT).drop("quarantined_at_utc")


@query
def version_gate_rejects(spark, sf_dir):
    raw = rawtext.numbered(spark, sf_dir, "orders")
    keyed = raw.select("source_record_number", clean_text(F.col("order_id")).alias("order_id"),
                       parse_utc(F.col("updated_at")).alias("updated_at"), F.col("updated_at").alias("raw_updated_at"))
    gated = staging.version_gate(keyed, "order_id", F.coalesce("raw_updated_at", F.lit("")))
    return gated.where(F.col("gate_codes") != "").select("source_record_number", "order_id", "gate_codes")


@query
def staged_customers(spark, sf_dir):
    staged, _ = staging.stage(rawtext.numbered(spark, sf_dir, "customers"), staging.customers(), RUN, AT)
    return _text_times(staged.drop("staged_at_utc"))


@query
def customer_quarantine(spark, sf_dir):
    _, rejected = staging.stage(rawtext.numbered(spark, sf_dir, "customers"), staging.customers(), RUN, AT)
    return rejected.drop("quarantined_at_utc")


@query
def staged_products(spark, sf_dir):
    staged, _ = staging.stage(rawtext.numbered(spark, sf_dir, "products"), staging.products(), RUN, AT)
    return _text_times(staged.drop("staged_at_utc"))


@query
def staged_products_json_lines(spark, sf_dir):
    staged, _ = staging.stage(rawtext.numbered(spark, sf_dir, "products_lines"), staging.products(), RUN, AT)
    return _text_times(staged.drop("staged_at_utc"))


@query
def product_quarantine(spark, sf_dir):
    _, rejected = staging.stage(rawtext.numbered(spark, sf_dir, "products"), staging.products(), RUN, AT)
    return rejected.drop("quarantined_at_utc")


def _classified(spark, sf_dir, *only: str) -> dict[str, DataFrame]:
    specs = {"customers": staging.customers(), "products": staging.products(), "orders": staging.orders(LIMITS)}
    return {n: staging.classify(rawtext.numbered(spark, sf_dir, n), s, *only) for n, s in specs.items()}


def _staging_quarantine(spark, sf_dir) -> DataFrame:
    specs = {"customers": staging.customers(), "products": staging.products(), "orders": staging.orders(LIMITS)}
    parts = [staging.quarantine_rows(c, specs[n], RUN, AT) for n, c in _classified(spark, sf_dir).items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _raw_counts(spark, sf_dir) -> DataFrame:
    parts = [rawtext.numbered(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("raw")).select(
        F.lit(n).alias("dataset"), "raw") for n in ("customers", "products", "orders")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def route_reconciliation(spark, sf_dir):
    routes = [c.groupBy("route").agg(F.count(F.lit(1)).alias("row_count"))
              .select(F.lit(n).alias("dataset"), "route", "row_count")
              for n, c in _classified(spark, sf_dir, "route").items()]
    specs = {"customers": staging.customers(), "products": staging.products(), "orders": staging.orders(LIMITS)}
    replaced = [staging.superseded_count(rawtext.numbered(spark, sf_dir, n), s) for n, s in specs.items()]
    return report.reconciliation(_raw_counts(spark, sf_dir), reduce(DataFrame.unionByName, routes),
                                 reduce(DataFrame.unionByName, replaced))


@query
def quarantine_by_reason(spark, sf_dir):
    return report.quarantine_counts(_staging_quarantine(spark, sf_dir))


@query
def rejected_keys(spark, sf_dir):
    return curate.rejected_keys(_staging_quarantine(spark, sf_dir))


@query
def missing_email_customers(spark, sf_dir):
    staged, _ = staging.stage(rawtext.numbered(spark, sf_dir, "customers"), staging.customers(), RUN, AT)
    flagged = staged.where("is_email_missing")
    return flagged.select("customer_id", "first_name", "last_name", "email", "is_email_missing", "city")


# ------------------------------------------------------------------ raw sources

@query
def raw_order_records(spark, sf_dir):
    return rawtext.numbered(spark, sf_dir, "orders").select(
        "source_record_number", *[F.coalesce(c, F.lit("")).alias(c) for c in staging.ORDER_SOURCE])


@query
def raw_product_records(spark, sf_dir):
    return rawtext.numbered(spark, sf_dir, "products").select("source_record_number", "record")


@query
def quoted_document_records(spark, sf_dir):
    """Records of CSV files whose quoted texts hold line ends, read in splits and numbered."""
    return rawtext.numbered(spark, sf_dir, "documents").select(
        "source_record_number", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sha256"))


@query
def raw_record_counts(spark, sf_dir):
    from ledgerloom.sources.raw import read_raw_csv, read_raw_json_array

    parts = {"customers": read_raw_csv(spark, rawtext.customers_csv(spark, sf_dir)),
             "products": read_raw_json_array(spark, rawtext.products_json(spark, sf_dir)),
             "orders": read_raw_csv(spark, rawtext.orders_csv(spark, sf_dir))}
    counted = [count_records(df).agg(F.sum("records").alias("records")).select(F.lit(n).alias("dataset"), "records")
               for n, df in parts.items()]
    return counted[0].unionByName(counted[1]).unionByName(counted[2])


@query
def source_fingerprints(spark, sf_dir):
    """Byte size and SHA-256 of every table file; no SQL over the tables can see the files."""
    return file_fingerprints(spark, sf_dir)


@query
def source_changes(spark, sf_dir):
    """Landing check: files that are gone, new or of other bytes, between two states of one source."""
    seen = [_bucket_fingerprints(spark, path(spark, sf_dir)).withColumnRenamed("bucket", "file").withColumn(
        "dataset", F.lit("products")) for path in (rawtext.products_json, rawtext.products_json_later)]
    return changed_files(*seen).select(F.col("file").alias("bucket"), "recorded_sha256", "current_sha256")


def _bucket_fingerprints(spark, path) -> DataFrame:
    bucket = F.regexp_extract("file", "bucket=([^/]+)/", 1).alias("bucket")
    return file_fingerprints(spark, path).select(bucket, "bytes", "sha256")


@query
def written_fingerprints(spark, sf_dir):
    """Byte size and SHA-256 of files whose bytes follow from the tables."""
    return _bucket_fingerprints(spark, rawtext.products_json(spark, sf_dir))


@query
def chunked_fingerprints(spark, sf_dir):
    """Trees of chunk digests, as for files above a row's size, of files whose bytes follow from the tables."""
    bucket = F.regexp_extract("file", "bucket=([^/]+)/", 1).alias("bucket")
    return file_fingerprints(spark, rawtext.products_json(spark, sf_dir), whole=0, chunk=4096).select(bucket, "bytes", "sha256", "chunk_bytes")


@query
def superseded_copies(spark, sf_dir):
    """Superseded versions among rows with nulls, of which a third are there twice."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") < 7, F.col("l_linenumber")).alias("line"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("quantity"), "l_partkey")
    copied = lines.unionByName(lines.where("l_orderkey % 3 = 0"))
    order = [F.col("quantity").desc_nulls_last(), F.col("l_partkey").desc()]
    return superseded(copied, ["l_orderkey", "line"], order)


# ------------------------------------------------------------------ text, time, number, JSON

@query
def normalized_documents(spark, sf_dir):
    """Trim and collapse whitespace of whole texts; the digest stands for the text."""
    cleaned = collapse_spaces(clean_text(F.col("text")))
    return table(spark, sf_dir, "documents").select("doc_id", cleaned.alias("t")).select(
        "doc_id", F.length("t").cast("bigint").alias("n_clean"), F.sha2("t", 256).alias("digest"))


@query
def title_cased_documents(spark, sf_dir):
    titled = title_case(collapse_spaces(clean_text(F.col("text"))))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(titled, 256).alias("digest"))


@query
def title_cased_parts(spark, sf_dir):
    noisy = F.concat(F.lit(" \t"), F.upper("p_name"), F.lit("  o'neil-"), F.lower("p_type"), F.lit(" 3rd "))
    return table(spark, sf_dir, "part").select(
        "p_partkey", title_case(collapse_spaces(clean_text(noisy))).alias("title"),
        F.lower(clean_text(noisy)).alias("lowered"), F.upper(clean_text(noisy)).alias("uppered"))


@query
def iso_timestamps(spark, sf_dir):
    raw = rawtext.raw_text(spark, sf_dir, "orders")
    return raw.select("l_orderkey", "l_linenumber", "order_timestamp",
                      F.date_format(parse_utc(F.col("order_timestamp")), TIMESTAMP_FORMAT).alias("utc"))


@query
def coerced_numbers(spark, sf_dir):
    number = parse_number(F.col("quantity"))
    infinite = F.coalesce(number == float("inf"), F.lit(False))
    return rawtext.raw_text(spark, sf_dir, "orders").select(
        "l_orderkey", "l_linenumber", "quantity", infinite.alias("is_infinite"),
        F.when(~infinite, number).alias("number"), parse_number(F.col("discount_pct")).alias("fraction"))


@query
def flattened_event_props(spark, sf_dir):
    props = F.from_json("props", "k bigint, active boolean")
    return table(spark, sf_dir, "events").select(
        "event_id", props["k"].alias("k"), props["active"].alias("active"))


# ------------------------------------------------------------------ curated rows

def _curated_view(df: DataFrame) -> DataFrame:
    return _text_times(df.drop("processed_at_utc"))


@query
def order_lines_curated(spark, sf_dir):
    return _curated_view(tables.curated_lines(spark, sf_dir))


@query
def order_lines_amounts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"), F.col("l_discount").alias("discount_pct"))
    return add_amounts(lines)


@query
def record_hashes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"), "left")
    columns = ("order_id", "product_id", "brand", "quantity", "unit_price", "discount_pct", "status",
               "order_timestamp")
    shaped = lines.select(
        tables.line_id().alias("order_id"), F.col("l_partkey").alias("product_id"), F.col("p_brand").alias("brand"),
        F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount_pct"), F.nullif(F.col("l_returnflag"), F.lit("N")).alias("status"),
        F.col("l_shipdate").alias("order_timestamp"))
    return shaped.select("order_id", business_hash(columns).alias("record_hash"))


def _routed_with_unknowns(spark, sf_dir) -> DataFrame:
    """Some nations and part sizes are missing from the sources altogether: true orphans."""
    customers = tables.judged_customers(spark, sf_dir).where(F.col("c_nationkey") != 24)
    products = tables.judged_products(spark, sf_dir).where(F.col("p_size") != 1)
    dimensions = tables.staged_dimensions(customers, products)
    staged = tables.staged_lines(tables.judged_lines(spark, sf_dir))
    return curate.join_references(staged, *dimensions, tables.dimension_rejects(customers, products))


@query
def orphan_classification(spark, sf_dir):
    routed = _routed_with_unknowns(spark, sf_dir)
    return routed.select("order_id", "customer_id", "product_id", "route", "reason_codes", "reason_detail")


@query
def orphan_quarantine(spark, sf_dir):
    routed = _routed_with_unknowns(spark, sf_dir).withColumn("source_record_number", F.lit(0).cast("bigint"))
    return curate.orphan_rows(routed, RUN, AT).drop("quarantined_at_utc", "source_record_number")


@query
def example_per_reason(spark, sf_dir):
    routed = _routed_with_unknowns(spark, sf_dir).withColumn("source_record_number", F.lit(0).cast("bigint"))
    examples = report.quarantine_examples(curate.orphan_rows(routed, RUN, AT))
    return examples.select("layer", "reason_codes", "business_key")


@query
def cardinality_guard(spark, sf_dir):
    """Keys that would multiply a many-to-one join: none for the dimensions, some for order headers."""
    checks = [("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")]
    parts = [duplicate_keys(table(spark, sf_dir, t), [k]).agg(
        F.count(F.lit(1)).alias("duplicated_keys"), F.coalesce(F.sum("versions"), F.lit(0)).alias("row_count"))
        .select(F.lit(t).alias("dataset"), "duplicated_keys", "row_count") for t, k in checks]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


# ------------------------------------------------------------------ contract

@query
def contract_violations(spark, sf_dir):
    return contract.contract_violations(tables.unchecked_lines(spark, sf_dir), LIMITS).drop("check_no")


@query
def contract_check_counts(spark, sf_dir):
    return contract.violation_counts(tables.unchecked_lines(spark, sf_dir), LIMITS).select("message", "bad_rows")


@query
def contract_clean_batch(spark, sf_dir):
    """The curated rows keep the contract: no check has a violation."""
    counts = contract.violation_counts(tables.curated_lines(spark, sf_dir), LIMITS)
    return counts.agg(F.sum("bad_rows").alias("bad_rows"), F.count(F.lit(1)).alias("checks"))


@query
def predicate_counts(spark, sf_dir):
    q, ship = F.col("l_quantity"), F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"),
        F.col("l_orderkey") == F.col("o_orderkey"), "left")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("1998-03-01 00:00:00", "1998-04-01 00:00:00"))
    return lines.agg(
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        F.count_if(F.col("o_orderkey").isNull()).alias("without_header"),
        F.count_if(~q.between(1, 45)).alias("outside_range"),
        F.count_if(not_in(F.col("o_orderpriority"), LIMITS.statuses)).alias("status_not_allowed"),
        F.count_if((q / 2) % 1 != 0).alias("odd_quantity"),
        F.count_if(F.rlike("o_orderpriority", F.lit("^[0-9]-[A-Z]+$"))).alias("plain_priority"),
        F.count_if(~F.col("l_returnflag").eqNullSafe(F.nullif(F.col("l_linestatus"), F.lit("O")))).alias("distinct_flags"),
        F.count_if((ship >= start) & (ship < end)).alias("in_month"),
    )


@query
def key_counts_and_nulls(spark, sf_dir):
    ids = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_tax") != 0.08, tables.line_id()).alias("order_id"))
    return contract.key_summary(ids)


@query
def table_rule_violations(spark, sf_dir):
    rows = tables.unchecked_lines(spark, sf_dir)
    return rows.agg(F.count_if(contract.table_rule_violated(LIMITS)).alias("violations"),
                    F.count(F.lit(1)).alias("row_count"))


@query
def table_against_run(spark, sf_dir):
    return contract.compare_with_expected(_tampered(spark, sf_dir), tables.curated_lines(spark, sf_dir))


def _tampered(spark, sf_dir) -> DataFrame:
    """The older table state in which some stored rows were edited without a new hash."""
    edited = F.when(F.col("quantity") == 7, F.lit("Edited")).otherwise(F.col("customer_city"))
    return tables.previous_lines(spark, sf_dir).withColumn("customer_city", edited)


@query
def missing_order_ids(spark, sf_dir):
    return contract.missing_ids(tables.previous_lines(spark, sf_dir), tables.curated_lines(spark, sf_dir))


@query
def differing_order_ids(spark, sf_dir):
    return contract.differing_ids(tables.previous_lines(spark, sf_dir), tables.curated_lines(spark, sf_dir))


@query
def rows_by_key_list(spark, sf_dir):
    found = contract.restrict_to_keys(tables.previous_lines(spark, sf_dir), tables.curated_lines(spark, sf_dir))
    return found.select("order_id", "record_hash")


@query
def row_set_equality(spark, sf_dir):
    new = _written(spark, sf_dir, "curated", tables.curated_lines)
    old = _written(spark, sf_dir, "previous", tables.previous_lines)
    same = contract.row_set_difference(new, new.select("order_id", "record_hash").repartition("record_hash"))
    return same.withColumn("pair", F.lit("same")).unionByName(
        contract.row_set_difference(new, old).withColumn("pair", F.lit("old")))


# ------------------------------------------------------------------ merge

@query
def upsert_actions(spark, sf_dir):
    return merge.merge_actions(tables.curated_lines(spark, sf_dir), tables.previous_lines(spark, sf_dir))


@query
def upsert_counts(spark, sf_dir):
    return merge.action_counts(
        merge.batch_actions(tables.curated_lines(spark, sf_dir), tables.previous_lines(spark, sf_dir)))


@query
def upsert_result(spark, sf_dir):
    return _curated_view(merge.merged_rows(*tables.curated_and_previous(spark, sf_dir)))


@query
def upsert_rerun(spark, sf_dir):
    """Merging the same batch into its own result writes nothing."""
    batch = tables.curated_lines(spark, sf_dir)
    merged = merge.merged_rows(batch, tables.previous_lines(spark, sf_dir))
    return merge.action_counts(merge.batch_actions(batch, merged))


@query
def upsert_drift_repair(spark, sf_dir):
    """Only rows whose stored hash drifted are written again."""
    batch = tables.curated_lines(spark, sf_dir)
    drifted = batch.withColumn("record_hash", F.when(F.col("quantity") == 11, F.reverse("record_hash")).otherwise(
        F.col("record_hash")))
    return merge.action_counts(merge.batch_actions(batch, drifted))


@query
def rows_written_per_run(spark, sf_dir):
    merged = merge.merged_rows(tables.curated_lines(spark, sf_dir), tables.previous_lines(spark, sf_dir))
    return history.rows_written_per_run(merged)


def _written(spark, sf_dir, label: str, build: Callable) -> DataFrame:
    """A frame written once, so a loader reads the same rows at every step. Its hashes are as text twice as long as they need be, which
    only a compression of single bits undoes."""
    path = rawtext.once(spark, sf_dir, label, lambda p: build(spark, sf_dir).write.option("compression", partitions.COMPRESSION).parquet(p))
    return spark.read.parquet(path)


# The driver tables key customers and parts by number and keep zone-less timestamps.
_STORED_SCHEMA = curate.CURATED_SCHEMA.replace("_id string", "_id bigint").replace(
    "order_id bigint", "order_id string").replace("run_id bigint", "run_id string").replace(
    "order_timestamp timestamp", "order_timestamp timestamp_ntz").replace(
    "source_updated_at timestamp", "source_updated_at timestamp_ntz")


def _merged_table(spark, sf_dir) -> MonthlyTable:
    stored = MonthlyTable(spark, scratch_path(spark, "sales"), _STORED_SCHEMA)
    stored.replace(_written(spark, sf_dir, "previous", tables.previous_lines), OLD_RUN)
    stored.upsert(_written(spark, sf_dir, "curated", tables.curated_lines), RUN)
    return stored


@query
def table_upsert(spark, sf_dir):
    """The same merge on disk: published files of the month-partitioned table."""
    return _curated_view(_merged_table(spark, sf_dir).read())


@query
def table_load_log(spark, sf_dir):
    stored = _merged_table(spark, sf_dir)
    stored.upsert(_written(spark, sf_dir, "curated", tables.curated_lines), "run_again")
    return stored.commits().select("version", "pipeline_run_id", "load_scope", "row_count", "rows_inserted",
                                   "rows_updated", "rows_unchanged")


@query
def partition_load(spark, sf_dir):
    """One month loaded on its own, twice, into an empty table."""
    stored = MonthlyTable(spark, scratch_path(spark, "month-load"), _STORED_SCHEMA)
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    batch = partitions.month_range(rows, YEAR, MONTH)
    stored.load_month(batch, YEAR, MONTH, "run_1")
    stored.load_month(batch, YEAR, MONTH, "run_2")
    return stored.partition_loads().drop("loaded_at_utc")


@query
def partition_provenance(spark, sf_dir):
    """Which runs produced the rows of each month of the merged table."""
    merged = merge.merged_rows(tables.curated_lines(spark, sf_dir), tables.previous_lines(spark, sf_dir))
    keyed = partitions.with_partition(merged)
    return keyed.groupBy("order_year", "order_month").agg(
        F.array_join(F.array_sort(F.collect_set("pipeline_run_id")), ",").alias("runs"),
        F.count_distinct("pipeline_run_id").alias("run_count"))


# ------------------------------------------------------------------ partitions

def _dated_lines(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        tables.line_id().alias("order_id"), F.col("l_shipdate").alias("order_timestamp"), "l_quantity",
        "l_extendedprice")


def _partitioned(spark, sf_dir) -> str:
    return rawtext.once(spark, sf_dir, "months",
                         lambda p: partitions.write_months(_dated_lines(spark, sf_dir), p))


@query
def partition_counts(spark, sf_dir):
    return partitions.partition_counts(_dated_lines(spark, sf_dir))


@query
def partition_manifest(spark, sf_dir):
    """Rows per month as read back from the partitioned files."""
    stored = spark.read.parquet(_partitioned(spark, sf_dir))
    counts = stored.groupBy(*partitions.PARTITION_COLUMNS).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.withColumn("partition_key", partitions.partition_key(F.col("order_year"), F.col("order_month")))


@query
def partition_run_manifest(spark, sf_dir):
    """Lines of two runs written by month; the manifest of the written files, with the run ids they hold."""
    run = F.when(F.col("l_linenumber") % 2 == 0, "run_even").otherwise("run_odd")
    lines = table(spark, sf_dir, "lineitem").select(
        tables.line_id().alias("order_id"), F.col("l_shipdate").alias("order_timestamp"), run.alias("pipeline_run_id"))
    path = scratch_path(spark, "manifest")
    partitions.write_months(lines, f"{path}/rows")
    return _text_times(partitions.write_manifest(spark, f"{path}/rows", f"{path}/manifest"))


@query
def partition_bounds(spark, sf_dir):
    keyed = partitions.with_partition(_dated_lines(spark, sf_dir))
    bounds = keyed.groupBy("order_year", "order_month").agg(
        F.min("order_timestamp").alias("first_at"), F.max("order_timestamp").alias("last_at"))
    return _text_times(bounds)


@query
def month_range_scan(spark, sf_dir):
    return _text_times(partitions.month_range(_dated_lines(spark, sf_dir), YEAR, MONTH))


@query
def month_partition_scan(spark, sf_dir):
    return _text_times(partitions.read_month_pruned(spark, _partitioned(spark, sf_dir), YEAR, MONTH))


@query
def month_directory_read(spark, sf_dir):
    return _text_times(partitions.read_month_directory(spark, _partitioned(spark, sf_dir), YEAR, MONTH))


@query
def misfiled_rows(spark, sf_dir):
    """Lines filed under the month of their order date that ship in another month."""
    lines = tables.as_orders(tables.with_headers(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), spark, sf_dir))
    filed = partitions.with_partition(lines)
    outside = partitions.outside_month(filed, F.col("order_year"), F.col("order_month"), "updated_at")
    return filed.groupBy("order_year", "order_month").agg(
        F.count_if(outside).alias("misfiled"), F.count(F.lit(1)).alias("row_count"))


@query
def month_read_comparison(spark, sf_dir):
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    compared = formats.compare_month_reads(rows, scratch_path(spark, "month-reads"), YEAR, MONTH, repeats=1)
    whole = F.max("bytes_in_files_read").over(Window.partitionBy(F.lit(0)))  # four rows
    fewer = (F.col("bytes_in_files_read") > 0) & (F.col("bytes_in_files_read") < whole)
    return compared.select("scenario", "partition_key", "row_count", fewer.alias("reads_less"))


# ------------------------------------------------------------------ formats

@query
def format_row_sets(spark, sf_dir):
    """CSV, typed CSV, JSON Lines and Parquet hold the same rows."""
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    frames = formats.materialize(rows, scratch_path(spark, "formats"))
    parts = [_hash_summary(df).withColumn("storage_type", F.lit(name)) for name, df in frames.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _hash_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct hashes and the first of them. Nothing but the hashes is shuffled, as bytes: the first is found among the groups."""
    counted = df.groupBy(packed_hash().alias("record_hash")).agg(F.count(F.lit(1)).alias("n"))
    return counted.select("n", unpacked_hash().alias("hash")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("hash").alias("hashes"), F.min("hash").alias("first_hash"))


@query
def format_comparison(spark, sf_dir):
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    results = formats.compare_formats(rows, scratch_path(spark, "compare"), "1-URGENT", repeats=1)
    return results.select("storage_type", "row_count", "filtered_row_count", (F.col("stored_bytes") > 0).alias("has_bytes"), "dtypes")


@query
def typed_csv_scan(spark, sf_dir):
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    path = rawtext.once(spark, sf_dir, "curated-csv", lambda p: formats._write_csv(rows, p))
    return _curated_view(formats.read_csv_typed(spark, path, rows.schema))


@query
def json_lines_scan(spark, sf_dir):
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    path = rawtext.once(spark, sf_dir, "curated-jsonl", lambda p: formats._write_json_lines(rows, p, compression="gzip"))
    return _curated_view(formats.read_json_lines(spark, path, rows.schema))


@query
def status_filter_scan(spark, sf_dir):
    rows = _written(spark, sf_dir, "curated", tables.curated_lines)
    return _curated_view(rows.where(F.col("status") == "1-URGENT"))


@query
def median_measurements(spark, sf_dir):
    medians = exact_median(table(spark, sf_dir, "events"), "event_type", "value")
    return medians.select("event_type", F.round("median", 6).alias("median_value"))


# ------------------------------------------------------------------ history

def _stage_events(spark, sf_dir) -> DataFrame:
    """User events read as stage events: user = run, type = stage, and the type decides the status."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    status = F.when(F.col("event_type") == "error", history.FAILED).when(
        F.col("event_type") == "view", history.RUNNING).otherwise(history.SUCCESS)
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", "user_id", "event_type").alias("attempt_id"),
        F.concat(F.lit("run_"), F.col("user_id")).alias("pipeline_run_id"), F.col("event_type").alias("stage"),
        F.lit(1).alias("attempt"), F.col("event_id").cast("bigint").alias("event_no"), status.alias("status"),
        F.col("ts").alias("at_utc"), k.alias("rows_in"), (k * 2).alias("rows_out"),
        F.when(F.col("event_type") == "click", k).alias("rows_staging"),
        F.when(F.col("event_type") == "purchase", k).alias("rows_curated"),
        F.when(F.col("event_type") == "error", k).alias("rows_quarantined"),
        F.concat(F.lit("event "), F.col("event_id")).alias("message"))


@query
def stage_attempt_log(spark, sf_dir):
    return _text_times(history.stage_attempts(_stage_events(spark, sf_dir)))


@query
def run_state_log(spark, sf_dir):
    return _text_times(history.run_states(_stage_events(spark, sf_dir)))


@query
def audit_trail_checks(spark, sf_dir):
    """Per run: attempts, successful loads and attempts left open."""
    attempts = history.stage_attempts(_stage_events(spark, sf_dir))
    return attempts.groupBy("pipeline_run_id").agg(*history.audit_measures("purchase"))


@query
def latest_run_pointers(spark, sf_dir):
    marks = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("layer"), F.concat(F.lit("run_"), F.col("user_id")).alias("pipeline_run_id"),
        F.col("ts").alias("marked_at_utc"))
    return _text_times(history.latest_runs(marks))


@query
def partition_load_history(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("bigint")
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("version"), F.col("ts").alias("committed_at_utc"),
        F.concat(F.lit("run_"), F.col("user_id")).alias("pipeline_run_id"),
        F.when(F.col("event_type") == "view", "full").otherwise(
            partitions.partition_key(F.year("ts"), F.dayofmonth("ts"))).alias("load_scope"),
        (k * 3).alias("row_count"), k.alias("rows_inserted"), (k + 1).alias("rows_updated"),
        (k * 2).alias("rows_unchanged"))
    return _text_times(commits.partition_loads(log))


# ------------------------------------------------------------------ whole runs

def _run_all(spark, sf_dir) -> Pipeline:
    pipe = Pipeline(spark, scratch_path(spark, "run"), rawtext.sources(spark, sf_dir), LIMITS)
    pipe.run_all("run_1")
    return pipe


@query
def written_row_counts(spark, sf_dir):
    """Rows each dataset writes to staging, counted by the writing tasks themselves: no job reads them again."""
    pipe = Pipeline(spark, scratch_path(spark, "run"), rawtext.sources(spark, sf_dir), LIMITS)
    pipe.extract("run_1")
    found = [{"dataset": s.dataset, **pipe.write_classified("run_1", s.dataset, AT)} for s in pipe.sources]  # three datasets
    return spark.createDataFrame(found, "dataset string, rows_out bigint, staged bigint, quarantined bigint")


def _transformed(spark, sf_dir) -> Pipeline:
    pipe = Pipeline(spark, scratch_path(spark, "run"), rawtext.sources(spark, sf_dir), LIMITS)
    pipe.extract("run_1")
    pipe.transform("run_1")
    return pipe


@query
def quarantine_report(spark, sf_dir):
    """Both layers of a run's quarantine: every staging reject and the first curated one of each reason, with the numbers
    of their raw records."""
    examples = report.quarantine_examples(_transformed(spark, sf_dir).quarantine("run_1"))
    return examples.select("layer", "dataset", "business_key", "source_record_number", "reason_codes")


@query
def run_measures(spark, sf_dir):
    """All counts of a run in one table."""
    return _transformed(spark, sf_dir).measures("run_1")


@query
def full_run_reconciliation(spark, sf_dir):
    """Land, transform, load and validate all derived sources; the reconciliation of the run."""
    return _run_all(spark, sf_dir).summary("run_1")


@query
def curated_lookup(spark, sf_dir):
    """A few named lines in key order."""
    rows = tables.curated_lines(spark, sf_dir)
    found = report.point_lookup(rows, "order_id", ["1-3", "1013-3", "1070-2", "1119-1", "1153-5", "1204-6", "1250-5", "1306-5"])
    return found.select("order_id", "quantity", "unit_price", "net_amount", "status", "record_hash")


@query
def layer_counts(spark, sf_dir):
    """Rows that reach each layer: versions, latest, staged, curated, orphaned."""
    judged = tables.judged_lines(spark, sf_dir)
    staged = judged.agg(F.count(F.lit(1)).alias("latest"), F.count_if(F.col("route") == staging.STAGED).alias("staged"))
    routed = tables.routed_lines(spark, sf_dir).agg(
        F.count_if(F.col("route") == curate.CURATED).alias("curated"),
        F.count_if(F.col("route") == curate.ORPHAN).alias("orphaned"))
    raw = table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("raw"))
    parts = [df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("layer"), F.col(c).alias("row_count"))
                                           for c in df.columns])).alias("r")).select("r.*")
             for df in (raw, staged, routed)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
