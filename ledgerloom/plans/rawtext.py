"""Raw source files derived from the driver tables: messy CSV text, JSON arrays and JSON Lines.

The SELECTs are plain SQL that Spark and any other engine read alike, so a check can start from the same
text. Every row of the tables is used; the defects follow from column values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.staging import CUSTOMER_SOURCE, ORDER_SOURCE
from ledgerloom.plans.tables import LINE_COLUMNS, table
from ledgerloom.session import scratch_path
from ledgerloom.sources.landing import Source, read_numbered, write_positioned
from ledgerloom.sources.raw import read_quoted_csv, read_raw_csv, read_raw_json_array, read_raw_json_lines

_DAY = "cast(cast(o_orderdate AS date) AS string)"

RAW_ORDERS = f"""
SELECT {', '.join(LINE_COLUMNS)},
  CASE WHEN l_tax = 0.08 AND l_quantity = 50 THEN '  '
       ELSE chr(9) || l_orderkey || '-' || l_linenumber || chr(160) END AS order_id,
  CASE WHEN l_tax = 0.07 AND l_quantity = 49 THEN '' ELSE 'C' || o_custkey END AS customer_id,
  CASE WHEN l_tax = 0.06 AND l_quantity = 48 THEN ' ' ELSE 'P' || l_partkey END AS product_id,
  CASE l_linenumber
    WHEN 1 THEN {_DAY} || 'T18:00:00+08:00'
    WHEN 2 THEN replace({_DAY}, '-', '')
    WHEN 3 THEN {_DAY}
    WHEN 4 THEN {_DAY} || 'T06:30:00.250Z'
    WHEN 5 THEN {_DAY} || ' 23:59:59-0130'
    WHEN 6 THEN CASE WHEN l_tax = 0.05 THEN 'T10:00' ELSE {_DAY} || 'T07Z' END
    ELSE CASE WHEN l_tax = 0.04 THEN 'not-a-date' ELSE replace({_DAY}, '-', '/') || 'T01:02:03' END
  END AS order_timestamp,
  CASE WHEN l_quantity = 1 AND l_discount = 0.1 THEN 'two'
       WHEN l_quantity = 2 AND l_discount = 0.09 THEN '25.5'
       WHEN l_quantity = 3 AND l_discount = 0.08 THEN 'inf'
       WHEN l_quantity = 4 AND l_discount = 0.07 THEN '1d'
       ELSE ' ' || cast(l_quantity AS string) END AS quantity,
  CASE WHEN l_quantity = 5 AND l_discount = 0.06 THEN '-1.0'
       WHEN l_quantity = 6 AND l_discount = 0.05 THEN 'free'
       WHEN l_quantity = 7 AND l_discount = 0.04 THEN ''
       ELSE cast(l_extendedprice AS string) END AS unit_price,
  CASE WHEN l_quantity = 8 AND l_discount = 0.03 THEN '1.5'
       WHEN l_quantity = 9 AND l_discount = 0.02 THEN 'nan'
       ELSE cast(l_discount AS string) END AS discount_pct,
  ' ' || lower(o_orderpriority) || chr(9) AS status,
  CASE WHEN l_tax = 0.03 AND l_quantity = 47 THEN 'yesterday'
       ELSE cast(cast(l_shipdate AS date) AS string) || 'T00:00:00Z' END AS updated_at
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
"""

_CUSTOMER = """
SELECT c_custkey, {version} AS version, c_acctbal, c_nationkey, c_mktsegment, c_name,
  ' C' || c_custkey || ' ' AS customer_id,
  chr(160) || c_name AS first_name,
  CASE WHEN c_nationkey = 3 THEN '' ELSE 'Version {version}' END AS last_name,
  CASE WHEN c_nationkey = 7 THEN ' ' ELSE ' ' || c_mktsegment || '.' || c_custkey || '@EXAMPLE.COM ' END AS email,
  '  ' || lower(c_mktsegment) || '   o' || chr(39) || 'neil-CITY ' AS city,
  c_mktsegment AS customer_tier,
  CASE WHEN c_acctbal < -900 THEN 'unknown' WHEN c_nationkey = 5 THEN ''
       ELSE '2020-01-01T12:00:00+05:30' END AS created_at,
  CASE WHEN c_nationkey = 11 AND c_acctbal > 9000 THEN '2024-13-01' ELSE '2024-0{version}-01' END AS updated_at
FROM customer {filter}
"""
RAW_CUSTOMERS = (_CUSTOMER.format(version=1, filter="") + " UNION ALL "
                 + _CUSTOMER.format(version=2, filter="WHERE c_acctbal > 5000"))

_PRODUCT = """
SELECT p_partkey, {version} AS version, p_size, p_name, p_brand, p_type, p_retailprice,
  '{{"product_id":"P' || p_partkey || '","name":" ' || p_name || '{suffix}","brand":"' || p_brand || '","category":' ||
  CASE WHEN p_size = 7 THEN '"none"'
       ELSE '{{"name":"' || p_type || '","department":"D' || p_size || '"}}' END ||
  ',"unit_price":' ||
  CASE WHEN p_size = 13 THEN '"free"' WHEN p_size = 14 THEN '-' || cast(p_retailprice AS string)
       WHEN p_size = 15 THEN 'null' WHEN p_size = 16 THEN '"' || cast(p_retailprice AS string) || '"'
       ELSE cast(p_retailprice AS string) END ||
  ',"active":' || CASE WHEN p_size = 1 THEN '"yes"' WHEN p_size = 2 THEN 'false' ELSE 'true' END ||
  ',"updated_at":' || CASE WHEN p_size = 3 THEN 'null' ELSE '"2024-0{version}-01"' END || '}}' AS record
FROM part {filter}
"""
RAW_PRODUCTS = (_PRODUCT.format(version=1, suffix="", filter="") + " UNION ALL "
                + _PRODUCT.format(version=2, suffix=" rev2", filter="WHERE p_size > 40"))

# Records per JSON array file: an array is read by one task, so its size is fixed.
ARRAY_PARTS = 1000

_paths: dict[tuple[str, str, str], str] = {}


def once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Materialize a derived source once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _paths:
        path = scratch_path(spark, label)
        write(path)
        _paths[key] = path
    return _paths[key]


def raw_text(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    if dataset == "orders":
        return spark.sql(RAW_ORDERS.replace("FROM lineitem LEFT JOIN orders", "FROM {l} LEFT JOIN {o}"),
                         l=table(spark, sf_dir, "lineitem"), o=table(spark, sf_dir, "orders"))
    if dataset == "customers":
        return spark.sql(RAW_CUSTOMERS.replace("FROM customer", "FROM {c}"), c=table(spark, sf_dir, "customer"))
    # Braces are literal JSON here, so the table goes in as a view instead of a placeholder.
    table(spark, sf_dir, "part").createOrReplaceTempView("ledgerloom_part")
    return spark.sql(RAW_PRODUCTS.replace("FROM part", "FROM ledgerloom_part"))


def _write_csv(df: DataFrame, path: str, **options: str) -> None:
    df.write.options(header="true", escape='"', ignoreLeadingWhiteSpace="false",
                     ignoreTrailingWhiteSpace="false", emptyValue="", **options).csv(path)


def ordered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw orders in line order. The columns of the tables are sorted, and spelled as text behind the sort: the text is
    three times as long."""
    headers = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS).join(headers, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    text = RAW_ORDERS.replace("FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey", "FROM {joined}")
    return spark.sql(text, joined=lines.drop("o_orderkey").orderBy(*LINE_COLUMNS))


def orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """Files in line order, so a record number is the position of its row in that order. Compressed, a file is one split: of the
    size of a sorted range. The fastest level takes half the time of the usual one, and a third more bytes."""
    def write(path: str) -> None:
        _write_csv(ordered_orders(spark, sf_dir).select(*ORDER_SOURCE), path, **{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"})

    return once(spark, sf_dir, "orders-csv", write)


def customers_csv(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        ordered = raw_text(spark, sf_dir, "customers").orderBy("c_custkey", "version")
        _write_csv(ordered.select(*CUSTOMER_SOURCE), path)

    return once(spark, sf_dir, "customers-csv", write)


def documents_csv(spark: SparkSession, sf_dir: str) -> str:
    """Whole texts in quotes, with their line ends and quotes, in the order of the ids."""
    def write(path: str) -> None:
        docs = table(spark, sf_dir, "documents").orderBy("doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        docs.write.options(header="true", escape='"', quoteAll="true", ignoreLeadingWhiteSpace="false",
                           ignoreTrailingWhiteSpace="false", emptyValue="").csv(path)

    return once(spark, sf_dir, "documents-csv", write)


def products_json(spark: SparkSession, sf_dir: str) -> str:
    """JSON arrays of at most a fixed number of parts each, in part order."""
    def write(path: str) -> None:
        bucket = F.lpad(F.floor(F.col("p_partkey") / ARRAY_PARTS).cast("string"), 9, "0")
        keyed = raw_text(spark, sf_dir, "products").select(
            bucket.alias("bucket"), F.struct("p_partkey", "version", "record").alias("r"))
        arrays = keyed.groupBy("bucket").agg(F.array_sort(F.collect_list("r")).alias("rs"))
        text = F.concat(F.lit("["), F.array_join(F.transform("rs", lambda r: r["record"]), ",\n "), F.lit("]"))
        arrays.select("bucket", text.alias("value")).write.partitionBy("bucket").text(path)

    return once(spark, sf_dir, "products-json", write)


def products_json_later(spark: SparkSession, sf_dir: str) -> str:
    """The same files after a change: the first is gone, every second one of the others ends in a blank, one is new."""
    def write(path: str) -> None:
        files = spark.read.text(products_json(spark, sf_dir), wholetext=True).where("bucket > 0")
        text = F.concat(F.rtrim("value", F.lit("\n")), F.when(F.col("bucket") % 2 == 1, F.lit(" ")).otherwise(F.lit("")))
        new = table(spark, sf_dir, "region").agg(F.concat(F.lit("["), F.count(F.lit(1)), F.lit("]")).alias("value"))
        kept = files.select(F.lpad(F.col("bucket").cast("string"), 9, "0").alias("bucket"), text.alias("value"))
        kept.unionByName(new.select(F.lit("n").alias("bucket"), "value")).repartition("bucket").write.partitionBy("bucket").text(path)

    return once(spark, sf_dir, "products-json-later", write)


def products_json_lines(spark: SparkSession, sf_dir: str) -> str:
    def write(path: str) -> None:
        raw_text(spark, sf_dir, "products").orderBy("p_partkey", "version").select("record").write.text(path)

    return once(spark, sf_dir, "products-jsonl", write)


def sources(spark: SparkSession, sf_dir: str) -> list[Source]:
    return [Source("customers", customers_csv(spark, sf_dir), "csv_lines", CUSTOMER_SOURCE),
            Source("products", products_json(spark, sf_dir), "json"),
            Source("orders", orders_csv(spark, sf_dir), "csv_lines", ORDER_SOURCE)]


def numbered(spark: SparkSession, sf_dir: str, dataset: str) -> DataFrame:
    """Numbered raw records of one derived source."""
    readers = {
        "orders": lambda: read_raw_csv(spark, orders_csv(spark, sf_dir), ORDER_SOURCE),
        "customers": lambda: read_raw_csv(spark, customers_csv(spark, sf_dir)),
        "documents": lambda: read_quoted_csv(spark, documents_csv(spark, sf_dir), ["doc_id", "text"]),
        "products": lambda: read_raw_json_array(spark, products_json(spark, sf_dir)),
        "products_lines": lambda: read_raw_json_lines(spark, products_json_lines(spark, sf_dir)),
    }
    path = once(spark, sf_dir, f"{dataset}-landed", lambda p: write_positioned(readers[dataset](), p))
    return read_numbered(spark, path)
