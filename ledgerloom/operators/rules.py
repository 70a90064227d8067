"""Validity rules as data: an ordered list of (code, failed, detail) evaluated in one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    code: str
    failed: Column
    detail: Column


@dataclass(frozen=True)
class Limits:
    """Configurable bounds of the order rules. The defaults."""

    statuses: tuple[str, ...] = ("PENDING", "PAID", "PACKED", "SHIPPED", "DELIVERED", "CANCELLED")
    min_quantity: int = 1
    max_quantity: int = 20


DEFAULT_LIMITS = Limits()
# Digits, two of them behind the point, of the stored unit prices and amounts.
PRICE_DIGITS, AMOUNT_DIGITS = 14, 16


def not_in(col: Column, allowed: Sequence[str]) -> Column:
    """Missing counts as not allowed."""
    return ~F.coalesce(col.isin(list(allowed)), F.lit(False))


def reason_codes(rules: Sequence[Rule]) -> Column:
    """Codes of the failed rules in rule order, joined by ';' (empty text = valid).

    A predicate that comes out null does not fail the record, as in any CASE.
    """
    return _joined([F.when(r.failed, F.lit(r.code)) for r in rules], ";")


def reason_detail(rules: Sequence[Rule]) -> Column:
    return _joined([F.when(r.failed, r.detail) for r in rules], "; ")


def _joined(parts: list[Column], separator: str) -> Column:
    return F.concat_ws(separator, *parts) if parts else F.lit("")


def shown(name: str, raw: Column, text: str) -> Column:
    return F.concat(F.lit(f"{name}="), raw, F.lit(f" {text}"))


# ------------------------------------------------------------------ rule sets

def version_rules(key: str, shown_updated_at: Column) -> list[Rule]:
    """A record without a key or a version timestamp cannot take part in deduplication."""
    return [
        Rule(f"missing_{key}", F.col(key).isNull(), F.lit(f"{key} is blank")),
        Rule("invalid_updated_at", F.col("updated_at").isNull(),
             shown("updated_at", shown_updated_at, "is missing or not ISO-8601")),
    ]


def customer_rules(present: Column, shown_created_at: Column) -> list[Rule]:
    """`present`: the source had some text. A missing creation time is fine, an unreadable one is not."""
    return [
        Rule("invalid_created_at", F.col("created_at").isNull() & present,
             shown("created_at", shown_created_at, "is not an ISO-8601 timestamp")),
    ]


def product_rules(shown_price: Column) -> list[Rule]:
    price = F.col("unit_price")
    return [
        Rule("invalid_unit_price", price.isNull(), shown("unit_price", shown_price, "is missing or not numeric")),
        Rule("negative_unit_price", price < 0, shown("unit_price", shown_price, "is negative")),
    ]


@dataclass(frozen=True)
class ShownOrder:
    """How the raw order values appear in reason details."""

    order_timestamp: Column
    quantity: Column
    unit_price: Column
    discount_pct: Column
    status: Column
    limits: Limits = field(default=DEFAULT_LIMITS)


def order_rules(raw: ShownOrder) -> list[Rule]:
    """The eight order rules over the typed columns. A price is also invalid if it, or the amount it makes, does not fit
    the stored decimals."""
    lo, hi = raw.limits.min_quantity, raw.limits.max_quantity
    qty, price, pct = F.col("quantity"), F.col("unit_price"), F.col("discount_pct")
    cents = F.rint(price * 100)
    amount = F.when(qty.between(lo, hi), cents * qty)  # of a quantity that is none, another rule speaks
    too_large = (cents >= 10.0**PRICE_DIGITS) | (amount >= 10.0**AMOUNT_DIGITS)
    return [
        Rule("missing_customer_id", F.col("customer_id").isNull(), F.lit("customer_id is blank")),
        Rule("missing_product_id", F.col("product_id").isNull(), F.lit("product_id is blank")),
        Rule("invalid_order_timestamp", F.col("order_timestamp").isNull(),
             shown("order_timestamp", raw.order_timestamp, "is missing or not ISO-8601")),
        Rule("invalid_quantity", qty.isNull() | (qty % 1 != 0),
             shown("quantity", raw.quantity, "is not a whole number")),
        Rule("quantity_out_of_range", (qty < lo) | (qty > hi),
             shown("quantity", raw.quantity, f"outside allowed range {lo}..{hi}")),
        Rule("invalid_unit_price", price.isNull() | (price < 0) | too_large,
             shown("unit_price", raw.unit_price, "is missing, not numeric, or negative")),
        Rule("invalid_discount_pct", pct.isNull() | (pct < 0) | (pct > 1),
             shown("discount_pct", raw.discount_pct, "is not a fraction between 0 and 1")),
        Rule("invalid_status", not_in(F.col("status"), raw.limits.statuses),
             shown("status", raw.status, "is not an allowed status")),
    ]
