"""Driver tables seen as the sources of the pipeline.

`lineitem` holds several versions of an order line, told apart by ship date; `orders` carries customer,
order date and status; `customer` and `part` are the dimensions. The rules below break on real rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.text import python_repr, title_case
from ledgerloom.operators import curate, staging
from ledgerloom.operators.rules import Limits, Rule, ShownOrder, order_rules, reason_codes
from ledgerloom.operators.versions import latest_version

LIMITS = Limits(statuses=("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"), min_quantity=1, max_quantity=45)
RUN, OLD_RUN = "run_new", "run_old"
AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

LINE_KEY = ("l_orderkey", "l_linenumber")
# Ship date is the version; the remaining columns make the order total.
LINE_VERSION = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                "l_returnflag", "l_linestatus")
LINE_COLUMNS = LINE_KEY + LINE_VERSION


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def newest_first() -> list[Column]:
    return [F.col(c).desc() for c in LINE_VERSION]


def oldest_first() -> list[Column]:
    return [F.col(c).asc() for c in LINE_VERSION]


def line_id() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def current_lines(spark: SparkSession, sf_dir: str, order: list[Column] | None = None) -> DataFrame:
    """One version per order line, deduplicated before the join so the join moves fewer rows."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return latest_version(lines, list(LINE_KEY), order or newest_first())


def with_headers(lines: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order; `_order` tells the rows of orders apart, should a key repeat."""
    headers = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", F.monotonically_increasing_id().alias("_order"))
    return lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")


def current_orders(spark: SparkSession, sf_dir: str, order: list[Column] | None = None) -> DataFrame:
    """One version per order line and row of orders, in the shape of staged orders.

    The versions are joined before the latest is taken: a join by shuffle leaves all of an order in one task, so nothing is shuffled
    again for the latest, and a hot order is split by the join and limited per task before it is gathered."""
    lines = with_headers(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), spark, sf_dir)
    return as_orders(latest_version(lines, [*LINE_KEY, "_order"], order or newest_first()))


def as_orders(lines: DataFrame, *also: str) -> DataFrame:
    """Lines with their order in the shape of staged orders, before the rules."""
    return lines.select(
        *also,
        line_id().alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"), F.col("o_orderdate").alias("order_timestamp"),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount_pct"), F.upper("o_orderpriority").alias("status"),
        F.col("l_shipdate").alias("updated_at"),
    )


def line_rules() -> list[Rule]:
    def shown(name: str) -> Column:
        return python_repr(F.col(name).cast("string"))

    return order_rules(ShownOrder(shown("order_timestamp"), shown("quantity"), shown("unit_price"),
                                  shown("discount_pct"), shown("status"), LIMITS))


def judged_lines(spark: SparkSession, sf_dir: str, order: list[Column] | None = None) -> DataFrame:
    return judged(current_orders(spark, sf_dir, order))


def judged(lines: DataFrame) -> DataFrame:
    gated = staging.version_gate(lines, "order_id", python_repr(F.col("updated_at").cast("string")))
    return staging.judge(gated, line_rules())


def staged_lines(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("route") == staging.STAGED).withColumn("quantity", F.col("quantity").cast("bigint"))


def _judged_dimension(df: DataFrame, rule: Rule) -> DataFrame:
    return df.withColumn("reason_codes", reason_codes([rule]))


def judged_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer with a negative balance is rejected in staging."""
    rule = Rule("negative_balance", F.col("c_acctbal") < 0, F.lit("balance is negative"))
    return _judged_dimension(table(spark, sf_dir, "customer"), rule).select(
        F.col("c_custkey").alias("customer_id"), title_case(F.col("c_mktsegment")).alias("city"),
        F.concat(F.lit("tier "), F.col("c_nationkey").cast("string")).alias("customer_tier"), "c_nationkey",
        "reason_codes")


def judged_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An oversized part is rejected in staging."""
    rule = Rule("oversized", F.col("p_size") > 45, F.lit("size is above 45"))
    return _judged_dimension(table(spark, sf_dir, "part"), rule).select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category_name"), F.col("p_brand").alias("brand"), "p_size", "reason_codes")


def staged_dimensions(customers: DataFrame, products: DataFrame) -> tuple[DataFrame, DataFrame]:
    valid = F.col("reason_codes") == ""
    return (curate.customer_dimension(customers.where(valid)), curate.product_dimension(products.where(valid)))


def dimension_rejects(customers: DataFrame, products: DataFrame) -> DataFrame:
    """(dataset, business_key, reason_codes) of the rejected dimension rows; keys are unique here."""
    parts = [df.where(F.col("reason_codes") != "").select(
        F.lit(name).alias("dataset"), F.col(key).alias("business_key"), "reason_codes")
        for df, name, key in ((customers, "customers", "customer_id"), (products, "products", "product_id"))]
    return parts[0].unionByName(parts[1])


def routed_lines(spark: SparkSession, sf_dir: str, order: list[Column] | None = None) -> DataFrame:
    return _routed(spark, sf_dir, judged_lines(spark, sf_dir, order))


def _routed(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    customers, products = judged_customers(spark, sf_dir), judged_products(spark, sf_dir)
    dimensions = staged_dimensions(customers, products)
    return curate.join_references(staged_lines(lines), *dimensions, dimension_rejects(customers, products))


def curated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: latest version, rules, references, amounts and hash of every order line."""
    return curate.curated_rows(routed_lines(spark, sf_dir), RUN, AT)


def previous_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the oldest versions: the table state an upsert of `curated_lines` meets."""
    return curate.curated_rows(routed_lines(spark, sf_dir, oldest_first()), OLD_RUN, AT)


def first_and_last_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest and the oldest version of each order line and row of orders; `side` is `new`, `old`, or `both` for a line where they are the
    same. A version is the largest or smallest of its columns in their order, so tasks pass on one of each."""
    lines = with_headers(table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS), spark, sf_dir)
    headers = [c for c in lines.columns if c not in (*LINE_COLUMNS, "_order")]
    version = F.struct(*LINE_VERSION)
    ends = lines.groupBy(*LINE_KEY, "_order").agg(
        F.max(version).alias("newest"), F.min(version).alias("oldest"), *[F.first(c).alias(c) for c in headers])

    def side(name: str, which: str) -> Column:
        return F.struct(F.lit(name).alias("side"), *[F.col(f"{which}.{c}").alias(c) for c in LINE_VERSION])

    same = F.col("newest").eqNullSafe(F.col("oldest"))
    sides = F.when(same, F.array(side("both", "newest"))).otherwise(F.array(side("new", "newest"), side("old", "oldest")))
    return as_orders(ends.select(*LINE_KEY, *headers, F.inline(sides)), "side")


def curated_and_previous(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """`curated_lines` and `previous_lines` for a plan that reads both: lines, customers and parts are joined once, for the rows of
    both sides together, and a line of one version is one row."""
    routed = _routed(spark, sf_dir, judged(first_and_last_orders(spark, sf_dir)))
    settled = staging.settled(routed.select("side", *curate.MEASURED_FROM))
    return (curate.curated_rows(settled.where(F.col("side") != "old"), RUN, AT),
            curate.curated_rows(settled.where(F.col("side") != "new"), OLD_RUN, AT))


def unchecked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line version in curated form without dedup or rules, and with some columns damaged."""
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    headers = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand")
    joined = lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left").join(
        parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    shaped = joined.select(
        "l_tax", "l_quantity", line_id().alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"), F.col("o_orderdate").alias("order_timestamp"),
        F.col("l_returnflag").alias("customer_city"), F.col("l_linestatus").alias("customer_tier"),
        F.col("p_name").alias("product_name"), F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("l_quantity").cast("bigint").alias("quantity"), F.col("l_extendedprice").alias("unit_price"),
        F.col("l_discount").alias("discount_pct"), F.col("o_orderpriority").alias("status"),
        F.col("l_shipdate").alias("updated_at"), F.lit("curated").alias("route"))
    damaged = curate.measured(shaped, RUN, AT).withColumns({
        "net_amount": F.when(F.col("l_tax") == 0.08, F.col("net_amount") + F.lit("0.01").cast("decimal(16,2)"))
        .otherwise(F.col("net_amount")).cast("decimal(16,2)"),
        "record_hash": F.when(F.col("l_tax") == 0.07, F.upper("record_hash")).otherwise(F.col("record_hash")),
        "source_updated_at": F.when(~((F.col("l_tax") == 0.05) & (F.col("l_quantity") == 2)),
                                    F.col("source_updated_at")),
    })
    return damaged.select(*curate.CURATED_COLUMNS)
