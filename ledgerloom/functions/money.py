"""Exact money arithmetic in integer cents."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BP_PER_UNIT = 10_000  # discount fractions are kept to four decimals (basis points)


def to_cents(amount: Column) -> Column:
    """Half-even to the cent, as a bigint; null beyond it. (`round` would be half-up, a decimal cast too.)"""
    return F.rint(amount * 100).try_cast("bigint")


def to_basis_points(fraction: Column) -> Column:
    return F.rint(fraction * BP_PER_UNIT).cast("bigint")


def _div(a: Column, b: int) -> Column:
    return F.call_function("div", a, F.lit(b).cast("bigint"))


def discount_cents(gross: Column, bp: Column) -> Column:
    """Half-up (gross * bp) / 10000 without forming the product, so it cannot overflow a bigint."""
    whole, rest = _div(gross, BP_PER_UNIT), gross % BP_PER_UNIT
    return whole * bp + _div(rest * bp + BP_PER_UNIT // 2, BP_PER_UNIT)


def cents_to_decimal(cents: Column, precision: int = 16) -> Column:
    return (cents.try_cast("decimal(18,0)") * F.lit(Decimal("0.01"))).try_cast(f"decimal({precision},2)")


def add_amounts(df: DataFrame) -> DataFrame:
    """Replace unit_price / discount_pct by exact decimals and add gross, discount and net amounts.

    The price is rounded half-even to the cent, the rate half-even to the basis point, the discount
    half-up to the cent; net is the difference, so the three always add up.
    """
    cents = df.withColumns({
        "_price": to_cents(F.col("unit_price")),
        "_bp": to_basis_points(F.col("discount_pct")),
    }).withColumn("_gross", F.col("quantity").cast("bigint") * F.col("_price"))
    cents = cents.withColumn("_discount", discount_cents(F.col("_gross"), F.col("_bp")))
    return cents.withColumns({
        "unit_price": cents_to_decimal(F.col("_price"), 14),
        "discount_pct": (F.col("_bp").cast("decimal(10,0)") * F.lit(Decimal("0.0001"))).cast("decimal(6,4)"),
        "gross_amount": cents_to_decimal(F.col("_gross")),
        "discount_amount": cents_to_decimal(F.col("_discount")),
        "net_amount": cents_to_decimal(F.col("_gross") - F.col("_discount")),
    }).drop("_price", "_bp", "_gross", "_discount")
