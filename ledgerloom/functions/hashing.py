"""Content hash of a curated row: the same bytes whatever format the row was read from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The curated columns, their canonical text formats and the digest pattern.
CURATED_COLUMNS = (
    "order_id", "customer_id", "product_id", "order_timestamp", "customer_city", "customer_tier",
    "product_name", "category", "brand", "quantity", "unit_price", "discount_pct", "gross_amount",
    "discount_amount", "net_amount", "status", "source_updated_at", "pipeline_run_id",
    "processed_at_utc", "record_hash",
)
RUN_METADATA = ("pipeline_run_id", "processed_at_utc", "record_hash")
BUSINESS_COLUMNS = tuple(c for c in CURATED_COLUMNS if c not in RUN_METADATA)
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
DIGEST_PATTERN = "^[0-9a-f]{64}$"

_AS_TEXT = {
    "order_timestamp": lambda c: F.date_format(c, TIMESTAMP_FORMAT),
    "source_updated_at": lambda c: F.date_format(c, TIMESTAMP_FORMAT),
    "unit_price": lambda c: c.cast("decimal(18,2)").cast("string"),
    "gross_amount": lambda c: c.cast("decimal(18,2)").cast("string"),
    "discount_amount": lambda c: c.cast("decimal(18,2)").cast("string"),
    "net_amount": lambda c: c.cast("decimal(18,2)").cast("string"),
    "discount_pct": lambda c: c.cast("decimal(10,4)").cast("string"),
    "quantity": lambda c: c.cast("bigint").cast("string"),
}


def canonical_columns(columns: Iterable[str] = BUSINESS_COLUMNS) -> list[Column]:
    """Every column as canonical text, sorted by name; null stays null."""
    text = lambda name: _AS_TEXT.get(name, lambda c: c.cast("string"))(F.col(name)).alias(name)
    return [text(name) for name in sorted(columns)]


def business_hash(columns: Iterable[str] = BUSINESS_COLUMNS) -> Column:
    """SHA-256 of the row as compact JSON with sorted keys. Run metadata is not part of it."""
    payload = F.to_json(F.struct(*canonical_columns(columns)), {"ignoreNullFields": "false"})
    return F.sha2(payload, 256)


def is_sha256(col: Column) -> Column:
    return F.rlike(col, F.lit(DIGEST_PATTERN))


def packed_hash(name: str = "record_hash") -> Column:
    """A content hash as bytes, half as long as its text; any other text as it is. Unlike texts give unlike bytes."""
    text = F.col(name).cast("string")
    packed = F.when(is_sha256(text), F.concat(F.unhex(F.lit("01")), F.unhex(text)))
    return F.coalesce(packed, F.concat(F.unhex(F.lit("00")), text.cast("binary")))  # the pattern lets a line end pass, unhex does not


def unpacked_hash(name: str = "record_hash") -> Column:
    """The text that `packed_hash` made bytes of."""
    rest = F.substring(name, 2, 2**31 - 1)
    return F.when(F.substring(name, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
