"""Curated order lines: many-to-one joins, orphan classification, amounts and content hash.

Each dimension is looked up once. The lookup side holds one row per business key, staged or rejected,
so a single left join tells matched, rejected-upstream and unknown references apart; there is no second
pass over the fact rows. No broadcast is forced: the planner broadcasts a lookup only when its measured
size is below spark.sql.autoBroadcastJoinThreshold, and otherwise sort-merges with skew splitting.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.hashing import CURATED_COLUMNS, business_hash
from ledgerloom.functions.money import add_amounts
from ledgerloom.operators.rules import Rule, reason_codes, reason_detail
from ledgerloom.operators.staging import quarantine_frame
from ledgerloom.operators.versions import latest_version, require_unique

# The staged order columns an orphan keeps as its source record.
ORPHAN_RECORD = (
    "order_id", "customer_id", "product_id", "order_timestamp", "quantity", "unit_price", "discount_pct",
    "status", "updated_at",
)
CURATED_SCHEMA = (
    "order_id string, customer_id string, product_id string, order_timestamp timestamp, customer_city string, "
    "customer_tier string, product_name string, category string, brand string, quantity bigint, "
    "unit_price decimal(14,2), discount_pct decimal(6,4), gross_amount decimal(16,2), "
    "discount_amount decimal(16,2), net_amount decimal(16,2), status string, source_updated_at timestamp, "
    "pipeline_run_id string, processed_at_utc timestamp, record_hash string"
)
ROUTED_SCHEMA = (
    "product_id string, customer_id string, order_id string, order_timestamp timestamp, quantity bigint, "
    "unit_price double, discount_pct double, status string, updated_at timestamp, source_record_number bigint, "
    "customer_city string, customer_tier string, product_name string, category string, brand string, "
    "reason_codes string, reason_detail string, route string"
)
# What `curated_rows` reads of routed rows.
MEASURED_FROM = (
    "order_id", "customer_id", "product_id", "order_timestamp", "customer_city", "customer_tier", "product_name", "category", "brand",
    "quantity", "unit_price", "discount_pct", "status", "updated_at", "route",
)
CURATED, ORPHAN = "curated", "orphan"


def customer_dimension(staged: DataFrame) -> DataFrame:
    return staged.select("customer_id", F.col("city").alias("customer_city"), "customer_tier")


def product_dimension(staged: DataFrame) -> DataFrame:
    return staged.select("product_id", "product_name", F.col("category_name").alias("category"), "brand")


def rejected_keys(quarantine: DataFrame) -> DataFrame:
    """(dataset, business_key) -> reason_codes of its last rejected record.

    A key's early rejects (no version timestamp) come before its judged latest version; within a phase
    the later record wins. Aggregated map-side, so a key rejected a billion times is still one row per task.
    """
    judged = ~F.col("reason_codes").contains("invalid_updated_at")
    return (
        quarantine.where((F.col("layer") == "staging") & F.col("business_key").isNotNull())
        .groupBy("dataset", "business_key")
        .agg(F.max_by("reason_codes", F.struct(judged, F.col("source_record_number"))).alias("reason_codes"))
    )


def lookup(dimension: DataFrame, key: str, entity: str, rejected: DataFrame | None) -> DataFrame:
    """Dimension rows plus upstream-rejected keys that have no staged row; `_<entity>` tells which."""
    marker, reason = f"_{entity}", f"_{entity}_reason"
    known = dimension.withColumns({marker: F.lit("staged"), reason: F.lit(None).cast("string")})
    if rejected is None:
        return known
    upstream = (
        rejected.where(F.col("dataset") == f"{entity}s")
        .select(F.col("business_key").alias(key), F.lit("rejected").alias(marker),
                F.col("reason_codes").alias(reason))
    )
    both = known.unionByName(upstream, allowMissingColumns=True)
    return latest_version(both, [key], [F.col(marker).desc()])  # 'staged' sorts after 'rejected'


def join_references(orders: DataFrame, customers: DataFrame, products: DataFrame,
                    rejected: DataFrame | None = None) -> DataFrame:
    """Orders with both lookups attached and a `route`: curated, or orphan with its reasons.

    `customers` / `products` are dimensions with unique keys (`require_unique` checks it).
    """
    joined = (
        orders.join(lookup(customers, "customer_id", "customer", rejected), "customer_id", "left")
        .join(lookup(products, "product_id", "product", rejected), "product_id", "left")
    )
    rules = [*_reference_rules("customer"), *_reference_rules("product")]
    routed = joined.withColumns({"reason_codes": reason_codes(rules), "reason_detail": reason_detail(rules)})
    return routed.withColumn("route", F.when(F.col("reason_codes") == "", CURATED).otherwise(ORPHAN)).drop(
        "_customer", "_customer_reason", "_product", "_product_reason")


def _reference_rules(entity: str) -> list[Rule]:
    key, marker = f"{entity}_id", F.col(f"_{entity}")
    named = F.concat(F.lit(f"{key} "), F.col(key))
    return [
        Rule(f"{entity}_rejected_in_staging", marker == "rejected",
             F.concat(named, F.lit(" exists in the source but was quarantined in staging ("),
                      F.col(f"_{entity}_reason"), F.lit(")"))),
        Rule(f"orphan_{key}", marker.isNull(), F.concat(named, F.lit(f" not found in staging {entity}s"))),
    ]


def curated_rows(routed: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Matched rows with exact amounts, audit columns and content hash, in curated column order."""
    return measured(routed.where(F.col("route") == CURATED), run_id, at).select(*CURATED_COLUMNS)


def measured(matched: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Amounts, audit columns and hash added to joined rows."""
    audited = add_amounts(matched).withColumns({
        "source_updated_at": F.col("updated_at"),
        "pipeline_run_id": F.lit(run_id),
        "processed_at_utc": F.lit(at).cast("timestamp"),
    })
    return audited.withColumn("record_hash", business_hash())


def orphan_source_record() -> Column:
    """The staged order as JSON text, timestamps ISO-8601, missing values null."""
    as_json = {"order_timestamp": iso_text("order_timestamp"), "updated_at": iso_text("updated_at")}
    image = F.struct(*[as_json.get(c, F.col(c)).alias(c) for c in ORPHAN_RECORD])
    return F.to_json(image, {"ignoreNullFields": "false"})


def iso_text(name: str) -> Column:
    """Microseconds only when there are some, offset always written."""
    col = F.col(name)
    whole = F.date_trunc("second", col) == col
    return F.concat(
        F.when(whole, F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.lit("+00:00"),
    )


def orphan_rows(routed: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """Orders whose references are missing, as quarantine rows."""
    orphans = routed.where(F.col("route") == ORPHAN)
    shaped = orphans.withColumns({"business_key": F.col("order_id"), "source_record": orphan_source_record()})
    return quarantine_frame(shaped, "curated", "orders", run_id, at)


def build_curated(orders: DataFrame, customers: DataFrame, products: DataFrame, run_id: str, at: datetime,
                  staging_quarantine: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(curated, quarantine) from the three staging tables. Fails if a dimension key is not unique."""
    require_unique(customers, ["customer_id"], "staging customers")
    require_unique(products, ["product_id"], "staging products")
    rejected = None if staging_quarantine is None else rejected_keys(staging_quarantine)
    routed = join_references(orders, customer_dimension(customers), product_dimension(products), rejected)
    return curated_rows(routed, run_id, at), orphan_rows(routed, run_id, at)
