"""Plain SQL (DuckDB dialect) that computes each registered query from the same tables.

The expressions are written from the table columns, not from the library: where the Spark side parses
messy text, the SQL side knows which value the text was made from.
"""

from __future__ import annotations

from ledgerloom.plans.rawtext import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS
from ledgerloom.plans.tables import LINE_COLUMNS, LINE_VERSION, OLD_RUN, RUN

ORACLES: dict[str, str] = {}

_COLS = ", ".join(LINE_COLUMNS)
_NEWEST = ", ".join(f"{c} DESC" for c in LINE_VERSION)
_OLDEST = ", ".join(f"{c} ASC" for c in LINE_VERSION)


def micros(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%dT%H:%M:%S.%fZ')"


def versions(order: str = _NEWEST) -> str:
    return (f"SELECT {_COLS}, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn "
            "FROM lineitem")


_LINE_TEXT = ", ".join(c for c in LINE_COLUMNS if c != "l_shipdate") + f", {micros('l_shipdate')} AS l_shipdate"
_LINE_ID = "l_orderkey || '-' || l_linenumber"

ORACLES["latest_version_dedup"] = f"SELECT {_LINE_TEXT} FROM ({versions()}) WHERE rn = 1"
ORACLES["superseded_versions"] = f"SELECT {_LINE_TEXT} FROM ({versions()}) WHERE rn > 1"
ORACLES["duplicate_line_keys"] = """
SELECT l_orderkey, l_linenumber, count(*) AS versions FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1"""
ORACLES["duplicate_line_members"] = f"""
SELECT {_LINE_TEXT}, versions FROM (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS versions FROM lineitem) WHERE versions > 1"""
ORACLES["duplicate_version_report"] = f"""
SELECT {_LINE_ID} AS order_id, {micros('l_shipdate')} AS l_shipdate, l_quantity, versions, l_shipdate = kept AS kept
FROM (SELECT *, count(*) OVER w AS versions, max(l_shipdate) OVER w AS kept FROM lineitem
      WINDOW w AS (PARTITION BY l_orderkey, l_linenumber)) WHERE versions > 1"""

# ------------------------------------------------------------------ curated lines

_STATUSES = "('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')"


def order_rules(prefix: str = "") -> list[tuple[str, str, str]]:
    """(code, failed, detail) over typed columns and their shown text."""
    return [
        ("missing_customer_id", "customer_id IS NULL", "'customer_id is blank'"),
        ("missing_product_id", "product_id IS NULL", "'product_id is blank'"),
        ("invalid_order_timestamp", "order_timestamp IS NULL",
         "'order_timestamp=' || shown_ts || ' is missing or not ISO-8601'"),
        ("invalid_quantity", "quantity IS NULL OR isinf(quantity) OR (NOT isinf(quantity) AND quantity % 1 <> 0)",
         "'quantity=' || shown_qty || ' is not a whole number'"),
        ("quantity_out_of_range", "quantity < 1 OR quantity > 45",
         "'quantity=' || shown_qty || ' outside allowed range 1..45'"),
        ("invalid_unit_price", "unit_price IS NULL OR unit_price < 0",
         "'unit_price=' || shown_price || ' is missing, not numeric, or negative'"),
        ("invalid_discount_pct", "discount_pct IS NULL OR discount_pct < 0 OR discount_pct > 1",
         "'discount_pct=' || shown_pct || ' is not a fraction between 0 and 1'"),
        ("invalid_status", f"status IS NULL OR status NOT IN {_STATUSES}",
         "'status=' || shown_status || ' is not an allowed status'"),
    ]


def codes(rules) -> str:
    return "concat_ws(';', " + ", ".join(f"CASE WHEN {f} THEN '{c}' END" for c, f, _ in rules) + ")"


def details(rules) -> str:
    return "concat_ws('; ', " + ", ".join(f"CASE WHEN {f} THEN {d} END" for _, f, d in rules) + ")"


def judged(order: str = _NEWEST) -> str:
    shown = {"shown_ts": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "shown_qty": "CAST(l_quantity AS VARCHAR)",
             "shown_price": "CAST(l_extendedprice AS VARCHAR)", "shown_pct": "CAST(l_discount AS VARCHAR)",
             "shown_status": "o_orderpriority"}
    quoted = ", ".join(f"'''' || {e} || '''' AS {n}" for n, e in shown.items())
    return f"""
SELECT *, {codes(order_rules())} AS reason_codes, {details(order_rules())} AS reason_detail FROM (
  SELECT {_LINE_ID} AS order_id, o_custkey AS customer_id, l_partkey AS product_id, o_orderdate AS order_timestamp,
    l_quantity AS quantity, l_extendedprice AS unit_price, l_discount AS discount_pct, o_orderpriority AS status,
    l_shipdate AS updated_at, {quoted}
  FROM ({versions(order)}) LEFT JOIN orders ON l_orderkey = o_orderkey WHERE rn = 1)"""


ORACLES["order_rule_reasons"] = f"""
SELECT order_id, CASE WHEN reason_codes = '' THEN 'staged' ELSE 'rejected_late' END AS route, reason_codes,
  reason_detail FROM ({judged()})"""

_CUSTOMERS = """
SELECT c_custkey AS customer_id, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS customer_city,
  'tier ' || c_nationkey AS customer_tier, CASE WHEN c_acctbal < 0 THEN 'negative_balance' ELSE '' END AS c_reason
FROM customer"""
_PARTS = """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
  CASE WHEN p_size > 45 THEN 'oversized' ELSE '' END AS p_reason
FROM part"""


def routed(order: str = _NEWEST, customers: str = _CUSTOMERS, parts: str = _PARTS) -> str:
    rules = [
        ("customer_rejected_in_staging", "c_reason <> ''",
         "'customer_id ' || customer_id || ' exists in the source but was quarantined in staging (' || c_reason || ')'"),
        ("orphan_customer_id", "c_reason IS NULL", "'customer_id ' || customer_id || ' not found in staging customers'"),
        ("product_rejected_in_staging", "p_reason <> ''",
         "'product_id ' || product_id || ' exists in the source but was quarantined in staging (' || p_reason || ')'"),
        ("orphan_product_id", "p_reason IS NULL", "'product_id ' || product_id || ' not found in staging products'"),
    ]
    return f"""
SELECT *, {codes(rules)} AS reference_codes, {details(rules)} AS reference_detail
FROM (SELECT * FROM ({judged(order)}) WHERE reason_codes = '')
LEFT JOIN ({customers}) USING (customer_id) LEFT JOIN ({parts}) USING (product_id)"""


def cents(expr: str) -> str:
    return f"CAST(round_even({expr} * 100, 0) AS BIGINT)"


def money(expr: str, digits: int = 16) -> str:
    return f"CAST(CAST({expr} AS DECIMAL(18,0)) * 0.01 AS DECIMAL({digits},2))"


def with_amounts(source: str) -> str:
    return f"""
SELECT * EXCLUDE (unit_price, discount_pct, price, bp, gross, discount),
  {money('price', 14)} AS unit_price,
  CAST(CAST(bp AS DECIMAL(10,0)) * 0.0001 AS DECIMAL(6,4)) AS discount_pct, {money('gross')} AS gross_amount,
  {money('discount')} AS discount_amount, {money('gross - discount')} AS net_amount
FROM (SELECT *, (gross * bp + 5000) // 10000 AS discount FROM (
  SELECT *, quantity * price AS gross FROM (
    SELECT * REPLACE (CAST(quantity AS BIGINT) AS quantity), {cents('unit_price')} AS price,
      CAST(round_even(discount_pct * 10000, 0) AS BIGINT) AS bp FROM ({source}))))"""


def digest(columns: dict[str, str]) -> str:
    body = ", ".join(f"'{k}', {columns[k]}" for k in sorted(columns))
    return f"sha256(CAST(json_object({body}) AS VARCHAR))"


def _as_text(*names: str) -> dict[str, str]:
    return {n: f"CAST({n} AS VARCHAR)" for n in names}


_BUSINESS = {
    **_as_text("order_id", "customer_id", "product_id", "customer_city", "customer_tier", "product_name", "category",
               "brand", "quantity", "unit_price", "discount_pct", "gross_amount", "discount_amount", "net_amount",
               "status"),
    "order_timestamp": micros("order_timestamp"), "source_updated_at": micros("updated_at"),
}


def curated(order: str = _NEWEST, run: str = RUN) -> str:
    matched = f"""
SELECT order_id, customer_id, product_id, order_timestamp, customer_city, customer_tier, product_name, category, brand,
  quantity, unit_price, discount_pct, status, updated_at
FROM ({routed(order)}) WHERE reference_codes = ''"""
    return f"""
SELECT *, '{run}' AS pipeline_run_id, {digest(_BUSINESS)} AS record_hash FROM ({with_amounts(matched)})"""


CURATED, PREVIOUS = curated(), curated(_OLDEST, OLD_RUN)


def view(source: str) -> str:
    """Curated rows with timestamps as text and the version column under its table name."""
    return f"""
SELECT * EXCLUDE (order_timestamp, updated_at), {micros('order_timestamp')} AS order_timestamp,
  {micros('updated_at')} AS source_updated_at FROM ({source})"""


ORACLES["order_lines_curated"] = view(CURATED)
ORACLES["typed_csv_scan"] = ORACLES["json_lines_scan"] = view(CURATED)
ORACLES["status_filter_scan"] = f"SELECT * FROM ({view(CURATED)}) WHERE status = '1-URGENT'"
ORACLES["order_lines_amounts"] = with_amounts("""
SELECT l_orderkey, l_linenumber, l_partkey AS product_id, l_quantity AS quantity, l_extendedprice AS unit_price,
  l_discount AS discount_pct FROM lineitem""")
_HASHED = {
    "order_id": _LINE_ID, "product_id": "CAST(l_partkey AS VARCHAR)", "brand": "p_brand",
    "quantity": "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)",
    "unit_price": "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)",
    "discount_pct": "CAST(CAST(l_discount AS DECIMAL(10,4)) AS VARCHAR)", "status": "nullif(l_returnflag, 'N')",
    "order_timestamp": micros("l_shipdate"),
}
ORACLES["record_hashes"] = f"""
SELECT {_LINE_ID} AS order_id, {digest(_HASHED)} AS record_hash
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey"""

# ------------------------------------------------------------------ orphans

_UNKNOWN = routed(customers=_CUSTOMERS + " WHERE c_nationkey <> 24", parts=_PARTS + " WHERE p_size <> 1")
ORACLES["orphan_classification"] = f"""
SELECT order_id, customer_id, product_id, CASE WHEN reference_codes = '' THEN 'curated' ELSE 'orphan' END AS route,
  reference_codes AS reason_codes, reference_detail AS reason_detail FROM ({_UNKNOWN})"""
_ORDER_JSON = """CAST(json_object('order_id', order_id, 'customer_id', customer_id, 'product_id', product_id,
  'order_timestamp', strftime(order_timestamp, '%Y-%m-%dT%H:%M:%S+00:00'), 'quantity', CAST(quantity AS BIGINT),
  'unit_price', unit_price, 'discount_pct', discount_pct, 'status', status,
  'updated_at', strftime(updated_at, '%Y-%m-%dT%H:%M:%S+00:00')) AS VARCHAR)"""
ORACLES["orphan_quarantine"] = f"""
SELECT '{RUN}' AS pipeline_run_id, 'curated' AS layer, 'orders' AS dataset, order_id AS business_key,
  reference_codes AS reason_codes, reference_detail AS reason_detail, {_ORDER_JSON} AS source_record
FROM ({_UNKNOWN}) WHERE reference_codes <> ''"""
ORACLES["example_per_reason"] = f"""
SELECT 'curated' AS layer, reference_codes AS reason_codes, min(order_id) AS business_key
FROM ({_UNKNOWN}) WHERE reference_codes <> '' GROUP BY reference_codes"""
ORACLES["cardinality_guard"] = " UNION ALL ".join(
    f"""SELECT '{t}' AS dataset, count(*) AS duplicated_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count
FROM (SELECT {k}, count(*) AS n FROM {t} GROUP BY {k} HAVING count(*) > 1)"""
    for t, k in (("customer", "c_custkey"), ("part", "p_partkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey")))

# ------------------------------------------------------------------ raw text flows

_ORDERS_N = f"""
SELECT *, row_number() OVER (ORDER BY {_COLS}) AS n FROM ({RAW_ORDERS})"""
_TYPED_ORDERS = f"""
SELECT n, r.* EXCLUDE (n, order_id, customer_id, product_id, order_timestamp, quantity, unit_price, discount_pct,
    status, updated_at),
  CASE WHEN NOT (l_tax = 0.08 AND l_quantity = 50) THEN {_LINE_ID} END AS order_id,
  CASE WHEN NOT (l_tax = 0.07 AND l_quantity = 49) THEN 'C' || o_custkey END AS customer_id,
  CASE WHEN NOT (l_tax = 0.06 AND l_quantity = 48) THEN 'P' || l_partkey END AS product_id,
  CASE l_linenumber
    WHEN 1 THEN o_orderdate + INTERVAL 10 HOUR
    WHEN 2 THEN o_orderdate
    WHEN 3 THEN o_orderdate
    WHEN 4 THEN o_orderdate + INTERVAL 390 MINUTE + INTERVAL 250 MILLISECOND
    WHEN 5 THEN o_orderdate + INTERVAL 91799 SECOND
    WHEN 6 THEN CASE WHEN l_tax <> 0.05 THEN o_orderdate + INTERVAL 7 HOUR END
    ELSE CASE WHEN l_tax <> 0.04 THEN o_orderdate + INTERVAL 3723 SECOND END END AS order_timestamp,
  CASE WHEN l_quantity = 1 AND l_discount = 0.1 THEN NULL WHEN l_quantity = 2 AND l_discount = 0.09 THEN 25.5
       WHEN l_quantity = 3 AND l_discount = 0.08 THEN CAST('inf' AS DOUBLE)
       WHEN l_quantity = 4 AND l_discount = 0.07 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN l_quantity = 5 AND l_discount = 0.06 THEN -1.0 WHEN l_quantity = 6 AND l_discount = 0.05 THEN NULL
       WHEN l_quantity = 7 AND l_discount = 0.04 THEN NULL ELSE l_extendedprice END AS unit_price,
  CASE WHEN l_quantity = 8 AND l_discount = 0.03 THEN 1.5 WHEN l_quantity = 9 AND l_discount = 0.02 THEN NULL
       ELSE l_discount END AS discount_pct,
  o_orderpriority AS status,
  CASE WHEN NOT (l_tax = 0.03 AND l_quantity = 47) THEN l_shipdate END AS updated_at,
  '''' || r.order_timestamp || '''' AS shown_ts, '''' || r.quantity || '''' AS shown_qty,
  '''' || r.unit_price || '''' AS shown_price, '''' || r.discount_pct || '''' AS shown_pct,
  -- the trailing tab of the raw status is shown escaped
  '''' || replace(r.status, chr(9), '\\t') || '''' AS shown_status, '''' || r.updated_at || '''' AS shown_updated,
  CAST(json_object('order_id', r.order_id, 'customer_id', r.customer_id, 'product_id', r.product_id,
    'order_timestamp', r.order_timestamp, 'quantity', r.quantity, 'unit_price', r.unit_price,
    'discount_pct', r.discount_pct, 'status', r.status, 'updated_at', r.updated_at) AS VARCHAR) AS source_record
FROM ({_ORDERS_N}) r LEFT JOIN orders ON l_orderkey = o_orderkey"""


def gate(key: str) -> list[tuple[str, str, str]]:
    return [(f"missing_{key}", f"{key} IS NULL", f"'{key} is blank'"),
            ("invalid_updated_at", "updated_at IS NULL",
             "'updated_at=' || shown_updated || ' is missing or not ISO-8601'")]


def classified(typed: str, key: str, rules: list[tuple[str, str, str]]) -> str:
    """Early rejects plus judged winners, with route and reasons."""
    return f"""
SELECT *, CASE WHEN early <> '' THEN 'rejected_early' WHEN late <> '' THEN 'rejected_late' ELSE 'staged' END AS route,
  CASE WHEN early <> '' THEN early ELSE late END AS reason_codes,
  CASE WHEN early <> '' THEN early_detail ELSE late_detail END AS reason_detail
FROM (SELECT *, {codes(rules)} AS late, {details(rules)} AS late_detail,
        row_number() OVER (PARTITION BY {key}, CASE WHEN early <> '' THEN n END ORDER BY updated_at DESC, n DESC) AS rn
      FROM (SELECT *, {codes(gate(key))} AS early, {details(gate(key))} AS early_detail FROM ({typed})))
WHERE rn = 1"""


_ORDERS = classified(_TYPED_ORDERS, "order_id", order_rules())


def quarantine(source: str, dataset: str, key: str) -> str:
    return f"""
SELECT '{RUN}' AS pipeline_run_id, 'staging' AS layer, '{dataset}' AS dataset, {key} AS business_key,
  n AS source_record_number, reason_codes, reason_detail, source_record
FROM ({source}) WHERE route <> 'staged'"""


ORACLES["staged_orders"] = f"""
SELECT order_id, customer_id, product_id, {micros('order_timestamp')} AS order_timestamp,
  CAST(quantity AS BIGINT) AS quantity, unit_price, discount_pct, status, {micros('updated_at')} AS updated_at,
  n AS source_record_number, '{RUN}' AS pipeline_run_id FROM ({_ORDERS}) WHERE route = 'staged'"""
ORACLES["order_quarantine"] = quarantine(_ORDERS, "orders", "order_id")
ORACLES["version_gate_rejects"] = f"""
SELECT n AS source_record_number, order_id, early AS gate_codes FROM ({_ORDERS}) WHERE early <> ''"""
ORACLES["raw_order_records"] = f"""
SELECT n AS source_record_number, order_id, customer_id, product_id, order_timestamp, quantity, unit_price,
  discount_pct, status, updated_at FROM ({_ORDERS_N})"""
ORACLES["iso_timestamps"] = f"""
SELECT l_orderkey, l_linenumber, shown_ts[2:-2] AS order_timestamp, {micros('order_timestamp')} AS utc
FROM ({_TYPED_ORDERS})"""
ORACLES["coerced_numbers"] = f"""
SELECT l_orderkey, l_linenumber, shown_qty[2:-2] AS quantity, coalesce(isinf(quantity), false) AS is_infinite,
  CASE WHEN NOT isinf(quantity) THEN quantity END AS number, discount_pct AS fraction FROM ({_TYPED_ORDERS})"""

_CUSTOMERS_N = f"SELECT *, row_number() OVER (ORDER BY c_custkey, version) AS n FROM ({RAW_CUSTOMERS})"
_TYPED_CUSTOMERS = f"""
SELECT n, 'C' || c_custkey AS customer_id, c_name AS first_name,
  CASE WHEN c_nationkey <> 3 THEN 'Version ' || version END AS last_name,
  CASE WHEN c_nationkey <> 7 THEN lower(c_mktsegment) || '.' || c_custkey || '@example.com' END AS email,
  c_nationkey = 7 AS is_email_missing,
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) || ' O''Neil-City' AS city, c_mktsegment AS customer_tier,
  CASE WHEN c_acctbal >= -900 AND c_nationkey <> 5 THEN TIMESTAMP '2020-01-01 06:30:00' END AS created_at,
  CASE WHEN NOT (c_nationkey = 11 AND c_acctbal > 9000) THEN make_timestamp(2024, version, 1, 0, 0, 0) END
    AS updated_at,
  c_acctbal < -900 AS unreadable, '''' || r.created_at || '''' AS shown_created,
  '''' || r.updated_at || '''' AS shown_updated,
  CAST(json_object('customer_id', r.customer_id, 'first_name', r.first_name, 'last_name', r.last_name,
    'email', r.email, 'city', r.city, 'customer_tier', r.customer_tier, 'created_at', r.created_at,
    'updated_at', r.updated_at) AS VARCHAR) AS source_record
FROM ({_CUSTOMERS_N}) r"""
_STAGED_CUSTOMERS = classified(_TYPED_CUSTOMERS, "customer_id", [
    ("invalid_created_at", "unreadable", "'created_at=' || shown_created || ' is not an ISO-8601 timestamp'")])
ORACLES["staged_customers"] = f"""
SELECT customer_id, first_name, last_name, email, is_email_missing, city, customer_tier,
  {micros('created_at')} AS created_at, {micros('updated_at')} AS updated_at, n AS source_record_number,
  '{RUN}' AS pipeline_run_id FROM ({_STAGED_CUSTOMERS}) WHERE route = 'staged'"""
ORACLES["customer_quarantine"] = quarantine(_STAGED_CUSTOMERS, "customers", "customer_id")
ORACLES["missing_email_customers"] = f"""
SELECT customer_id, first_name, last_name, email, is_email_missing, city FROM ({_STAGED_CUSTOMERS})
WHERE route = 'staged' AND is_email_missing"""

_PRODUCTS_N = f"SELECT *, row_number() OVER (ORDER BY p_partkey, version) AS n FROM ({RAW_PRODUCTS})"
_TYPED_PRODUCTS = f"""
SELECT n, 'P' || p_partkey AS product_id, p_name || CASE WHEN version = 2 THEN ' rev2' ELSE '' END AS product_name,
  p_brand AS brand, CASE WHEN p_size <> 7 THEN p_type END AS category_name,
  CASE WHEN p_size <> 7 THEN 'D' || p_size END AS category_department,
  CASE p_size WHEN 13 THEN NULL WHEN 14 THEN -p_retailprice WHEN 15 THEN NULL ELSE p_retailprice END AS unit_price,
  CASE p_size WHEN 1 THEN NULL WHEN 2 THEN false ELSE true END AS active,
  CASE WHEN p_size <> 3 THEN make_timestamp(2024, version, 1, 0, 0, 0) END AS updated_at,
  CASE p_size WHEN 13 THEN '''free''' WHEN 14 THEN '-' || CAST(p_retailprice AS VARCHAR) ELSE 'None' END AS shown_price,
  'None' AS shown_updated, record AS source_record
FROM ({_PRODUCTS_N})"""
_STAGED_PRODUCTS = classified(_TYPED_PRODUCTS, "product_id", [
    ("invalid_unit_price", "unit_price IS NULL", "'unit_price=' || shown_price || ' is missing or not numeric'"),
    ("negative_unit_price", "unit_price < 0", "'unit_price=' || shown_price || ' is negative'")])
ORACLES["staged_products"] = ORACLES["staged_products_json_lines"] = f"""
SELECT product_id, product_name, brand, category_name, category_department, unit_price, active,
  {micros('updated_at')} AS updated_at, n AS source_record_number, '{RUN}' AS pipeline_run_id
FROM ({_STAGED_PRODUCTS}) WHERE route = 'staged'"""
ORACLES["product_quarantine"] = quarantine(_STAGED_PRODUCTS, "products", "product_id")
ORACLES["raw_product_records"] = f"SELECT n AS source_record_number, record FROM ({_PRODUCTS_N})"

_STAGED = {"customers": (_STAGED_CUSTOMERS, RAW_CUSTOMERS), "products": (_STAGED_PRODUCTS, RAW_PRODUCTS),
           "orders": (_ORDERS, RAW_ORDERS)}
ORACLES["raw_record_counts"] = " UNION ALL ".join(
    f"SELECT '{n}' AS dataset, count(*) AS records FROM ({raw})" for n, (_, raw) in _STAGED.items())
ORACLES["route_reconciliation"] = " UNION ALL ".join(
    f"""SELECT '{n}' AS dataset, raw, staged, quarantined, raw - staged - quarantined AS superseded
FROM (SELECT count(*) FILTER (WHERE route = 'staged') AS staged, count(*) FILTER (WHERE route <> 'staged') AS quarantined
      FROM ({c})), (SELECT count(*) AS raw FROM ({raw}))""" for n, (c, raw) in _STAGED.items())
ORACLES["full_run_reconciliation"] = ORACLES["route_reconciliation"]
ORACLES["written_row_counts"] = f"""
SELECT dataset, CAST(staged + quarantined AS BIGINT) AS rows_out, staged, quarantined FROM ({ORACLES["route_reconciliation"]})"""
_ALL_REJECTS = " UNION ALL ".join(
    quarantine(c, n, k) for (n, (c, _)), k in zip(_STAGED.items(), ("customer_id", "product_id", "order_id")))
ORACLES["quarantine_by_reason"] = f"""
SELECT layer, dataset, reason_codes, count(*) AS records FROM ({_ALL_REJECTS}) GROUP BY ALL"""
# Staged orders against the staged and the rejected keys of the other two sources.
_RUN_ROUTED = f"""
SELECT o.order_id, o.n, concat_ws(';',
  CASE WHEN c.k IS NULL AND rc.k IS NOT NULL THEN 'customer_rejected_in_staging' END,
  CASE WHEN c.k IS NULL AND rc.k IS NULL THEN 'orphan_customer_id' END,
  CASE WHEN p.k IS NULL AND rp.k IS NOT NULL THEN 'product_rejected_in_staging' END,
  CASE WHEN p.k IS NULL AND rp.k IS NULL THEN 'orphan_product_id' END) AS reference_codes
FROM (SELECT * FROM ({_ORDERS}) WHERE route = 'staged') o
LEFT JOIN (SELECT customer_id AS k FROM ({_STAGED_CUSTOMERS}) WHERE route = 'staged') c ON o.customer_id = c.k
LEFT JOIN (SELECT product_id AS k FROM ({_STAGED_PRODUCTS}) WHERE route = 'staged') p ON o.product_id = p.k
LEFT JOIN (SELECT DISTINCT business_key AS k FROM ({_ALL_REJECTS}) WHERE dataset = 'customers') rc ON o.customer_id = rc.k
LEFT JOIN (SELECT DISTINCT business_key AS k FROM ({_ALL_REJECTS}) WHERE dataset = 'products') rp ON o.product_id = rp.k"""
ORACLES["quarantine_report"] = f"""
SELECT layer, dataset, business_key, source_record_number, reason_codes FROM ({_ALL_REJECTS})
UNION ALL SELECT 'curated', 'orders', min(order_id), arg_min(n, order_id), reference_codes
FROM ({_RUN_ROUTED}) WHERE reference_codes <> '' GROUP BY reference_codes"""
ORACLES["run_measures"] = f"""
SELECT measure, dataset, NULL::VARCHAR AS reason, value
FROM (UNPIVOT ({ORACLES["route_reconciliation"]}) ON "raw", staged, quarantined, superseded INTO NAME measure VALUE value)
UNION ALL SELECT 'email_missing', 'customers', NULL, count(*) FROM ({_STAGED_CUSTOMERS}) WHERE route = 'staged' AND is_email_missing
UNION ALL SELECT 'curated_in', 'orders', NULL, count(*) FROM ({_RUN_ROUTED})
UNION ALL SELECT 'curated_out', 'orders', NULL, count(*) FROM ({_RUN_ROUTED}) WHERE reference_codes = ''
UNION ALL SELECT 'quarantined_for', dataset, 'staging/' || reason_codes, count(*) FROM ({_ALL_REJECTS}) GROUP BY dataset, reason_codes
UNION ALL SELECT 'quarantined_for', 'orders', 'curated/' || reference_codes, count(*)
FROM ({_RUN_ROUTED}) WHERE reference_codes <> '' GROUP BY reference_codes"""
ORACLES["rejected_keys"] = f"""
SELECT dataset, business_key, reason_codes FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, business_key
    ORDER BY reason_codes LIKE '%invalid_updated_at%', source_record_number DESC) AS k FROM ({_ALL_REJECTS})
  WHERE business_key IS NOT NULL) WHERE k = 1"""

# ------------------------------------------------------------------ text and JSON

_WS = (r"[\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


def cleaned(expr: str) -> str:
    trimmed = f"nullif(regexp_replace({expr}, '^{_WS}+|{_WS}+$', '', 'g'), '')"
    return f"regexp_replace({trimmed}, '{_WS}+', ' ', 'g')"


def titled(expr: str) -> str:
    cased = r"\p{Lu}\p{Ll}\p{Lt}"
    runs = f"regexp_extract_all({expr}, '[{cased}]+|[^{cased}]+')"
    # Unicode title case of a leading sharp s is 'Ss'; this SQL's upper() would give a capital sharp s.
    first = "CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END"
    return f"list_aggregate(list_transform({runs}, lambda w: {first} || lower(w[2:])), 'string_agg', '')"


ORACLES["normalized_documents"] = f"""
SELECT doc_id, length(t) AS n_clean, sha256(t) AS digest
FROM (SELECT doc_id, {cleaned('text')} AS t FROM documents)"""
ORACLES["title_cased_documents"] = f"""
SELECT doc_id, sha256({titled('t')}) AS digest FROM (SELECT doc_id, {cleaned('text')} AS t FROM documents)"""
_NOISY = "chr(32) || chr(9) || upper(p_name) || '  o''neil-' || lower(p_type) || ' 3rd '"
_TRIMMED = f"regexp_replace({_NOISY}, '^{_WS}+|{_WS}+$', '', 'g')"
ORACLES["title_cased_parts"] = f"""
SELECT p_partkey, {titled(cleaned(_NOISY))} AS title, lower({_TRIMMED}) AS lowered, upper({_TRIMMED}) AS uppered
FROM part"""
ORACLES["flattened_event_props"] = """
SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, CAST(props->>'$.active' AS BOOLEAN) AS active FROM events"""

# ------------------------------------------------------------------ contract

_UNCHECKED_MATCH = f"""
SELECT l_tax, l_quantity, {_LINE_ID} AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
  o_orderdate AS order_timestamp, l_returnflag AS customer_city, l_linestatus AS customer_tier, p_name AS product_name,
  p_type AS category, p_brand AS brand, l_quantity AS quantity, l_extendedprice AS unit_price,
  l_discount AS discount_pct, o_orderpriority AS status, l_shipdate AS updated_at
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey"""
_UNCHECKED = f"""
SELECT * REPLACE (CASE WHEN l_tax = 0.08 THEN net_amount + 0.01 ELSE net_amount END AS net_amount,
    CASE WHEN l_tax = 0.07 THEN upper(record_hash) ELSE record_hash END AS record_hash),
  CASE WHEN NOT (l_tax = 0.05 AND l_quantity = 2) THEN updated_at END AS source_updated_at,
  l_tax NOT IN (0.07, 0.08) AND NOT (l_tax = 0.05 AND l_quantity = 2) AS intact, '{RUN}' AS pipeline_run_id
FROM (SELECT *, {digest(_BUSINESS)} AS record_hash FROM ({with_amounts(_UNCHECKED_MATCH)}))"""
_NAMED_CHECKS = [
    ("order_id is null", "order_id IS NULL"),
    ("order_id is duplicated", "copies > 1"),
    *[(f"{c} is null", f"{c} IS NULL") for c in ("customer_id", "product_id", "order_timestamp", "status")],
    ("quantity outside 1..45", "quantity NOT BETWEEN 1 AND 45"),
    ("unit_price is negative", "unit_price < 0"),
    ("discount_pct outside 0..1", "discount_pct NOT BETWEEN 0 AND 1"),
    *[(f"{c} is negative", f"{c} < 0") for c in ("gross_amount", "discount_amount", "net_amount")],
    ("gross_amount != quantity * unit_price", "gross_amount <> quantity * unit_price"),
    ("discount_amount != round(gross_amount * discount_pct, 2)",
     "discount_amount <> round(gross_amount * discount_pct, 2)"),
    ("net_amount != gross_amount - discount_amount", "net_amount <> gross_amount - discount_amount"),
    ("status is not an allowed status", f"coalesce(status, '') NOT IN {_STATUSES}"),
    *[(f"audit column {c} is null", f"{c} IS NULL") for c in ("source_updated_at", "pipeline_run_id")],
    ("audit column processed_at_utc is null", "false"),
    ("audit column record_hash is null", "record_hash IS NULL"),
    ("record_hash is not a SHA-256 hex digest", "NOT regexp_full_match(record_hash, '[0-9a-f]{64}')"),
    ("record_hash does not match business columns", "NOT intact"),
]
_CHECKED = f"SELECT *, count(*) OVER (PARTITION BY order_id) AS copies FROM ({_UNCHECKED})"
ORACLES["contract_check_counts"] = f"WITH c AS MATERIALIZED ({_CHECKED}) " + " UNION ALL ".join(
    f"SELECT '{m}' AS message, count(*) FILTER (WHERE {p}) AS bad_rows FROM c" for m, p in _NAMED_CHECKS)
_FLAGGED = " UNION ALL ".join(
    f"SELECT '{m}' AS message, order_id FROM c WHERE {p}" for m, p in _NAMED_CHECKS[:-1])
ORACLES["contract_violations"] = f"""
WITH c AS MATERIALIZED ({_CHECKED})
SELECT message, count(*) AS bad_rows, string_agg(order_id, ', ' ORDER BY k) FILTER (WHERE k <= 5) AS sample
FROM (SELECT *, row_number() OVER (PARTITION BY message ORDER BY order_id) AS k FROM ({_FLAGGED})) GROUP BY message"""
ORACLES["contract_clean_batch"] = f"""
SELECT CAST(count(*) FILTER (WHERE quantity NOT BETWEEN 1 AND 45 OR net_amount <> gross_amount - discount_amount
  OR length(record_hash) <> 64) AS BIGINT) AS bad_rows, {len(_NAMED_CHECKS)} AS checks FROM ({CURATED})"""
ORACLES["predicate_counts"] = f"""
SELECT count(*) FILTER (WHERE l_returnflag = 'R') AS returned,
  count(*) FILTER (WHERE o_orderkey IS NULL) AS without_header,
  count(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 45) AS outside_range,
  count(*) FILTER (WHERE coalesce(o_orderpriority, '') NOT IN {_STATUSES}) AS status_not_allowed,
  count(*) FILTER (WHERE (l_quantity / 2) % 1 <> 0) AS odd_quantity,
  count(*) FILTER (WHERE regexp_full_match(o_orderpriority, '[0-9]-[A-Z]+')) AS plain_priority,
  count(*) FILTER (WHERE l_returnflag IS DISTINCT FROM nullif(l_linestatus, 'O')) AS distinct_flags,
  count(*) FILTER (WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01') AS in_month
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""
ORACLES["key_counts_and_nulls"] = f"""
SELECT count(*) AS total, count(DISTINCT id) AS distinct_ids, count(*) FILTER (WHERE id IS NULL) AS null_ids
FROM (SELECT CASE WHEN l_tax <> 0.08 THEN {_LINE_ID} END AS id FROM lineitem)"""
ORACLES["table_rule_violations"] = f"""
SELECT count(*) FILTER (WHERE quantity NOT BETWEEN 1 AND 45 OR unit_price < 0 OR discount_pct NOT BETWEEN 0 AND 1
  OR gross_amount < 0 OR discount_amount < 0 OR net_amount < 0 OR gross_amount <> quantity * unit_price
  OR discount_amount <> round(gross_amount * discount_pct, 2) OR net_amount <> gross_amount - discount_amount
  OR status NOT IN {_STATUSES} OR NOT regexp_full_match(record_hash, '[0-9a-f]{{64}}')) AS violations,
  count(*) AS row_count FROM ({_UNCHECKED})"""

# ------------------------------------------------------------------ merge

_BOTH = f"WITH new AS MATERIALIZED ({CURATED}), old AS MATERIALIZED ({PREVIOUS})"
ORACLES["table_against_run"] = f"""
{_BOTH} SELECT count(*) FILTER (WHERE o.order_id IS NULL) AS absent,
  count(*) FILTER (WHERE o.record_hash <> n.record_hash) AS differing,
  count(*) FILTER (WHERE o.quantity = 7) AS tampered
FROM new n LEFT JOIN old o USING (order_id)"""
ORACLES["missing_order_ids"] = f"{_BOTH} SELECT order_id FROM new ANTI JOIN old USING (order_id)"
ORACLES["differing_order_ids"] = f"""
{_BOTH} SELECT order_id, o.record_hash AS stored_hash, n.record_hash AS expected_hash
FROM new n JOIN old o USING (order_id) WHERE o.record_hash <> n.record_hash"""
ORACLES["rows_by_key_list"] = f"{_BOTH} SELECT order_id, record_hash FROM old SEMI JOIN new USING (order_id)"
ORACLES["row_set_equality"] = f"""
{_BOTH} SELECT 'same' AS pair, count(*) AS expected_rows, count(*) AS actual_rows, 0 AS mismatched FROM new
UNION ALL SELECT 'old', count(n.order_id), count(o.order_id),
  count(*) FILTER (WHERE n.order_id IS NULL OR o.order_id IS NULL)
FROM new n FULL JOIN old o ON n.order_id = o.order_id AND n.record_hash = o.record_hash"""
_ACTION = """CASE WHEN n.order_id IS NULL THEN 'target_only' WHEN o.order_id IS NULL THEN 'insert'
  WHEN o.record_hash <> n.record_hash THEN 'update' ELSE 'unchanged' END"""
ORACLES["upsert_actions"] = f"""
{_BOTH} SELECT coalesce(n.order_id, o.order_id) AS order_id, {_ACTION} AS action
FROM new n FULL JOIN old o ON n.order_id = o.order_id"""
ORACLES["upsert_counts"] = f"""
{_BOTH} SELECT {_ACTION} AS action, count(*) AS row_count FROM new n LEFT JOIN old o ON n.order_id = o.order_id
GROUP BY 1"""
_MERGED = """SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.order_id = new.order_id
    AND o.record_hash = new.record_hash)
UNION ALL BY NAME SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.order_id = old.order_id
    AND n.record_hash <> old.record_hash)"""
ORACLES["upsert_result"] = f"{_BOTH} {view(_MERGED)}"
ORACLES["table_upsert"] = f"""
{_BOTH} SELECT *, CAST(order_timestamp[1:4] AS INTEGER) AS order_year, CAST(order_timestamp[6:7] AS INTEGER)
  AS order_month FROM ({view(_MERGED)})"""
ORACLES["upsert_rerun"] = f"SELECT 'unchanged' AS action, count(*) AS row_count FROM ({CURATED})"
ORACLES["upsert_drift_repair"] = f"""
SELECT CASE WHEN quantity = 11 THEN 'update' ELSE 'unchanged' END AS action, count(*) AS row_count
FROM ({CURATED}) GROUP BY 1"""
ORACLES["rows_written_per_run"] = f"""
{_BOTH} SELECT pipeline_run_id, count(*) AS row_count FROM ({_MERGED}) GROUP BY 1"""
ORACLES["partition_provenance"] = f"""
{_BOTH} SELECT year(order_timestamp) AS order_year, month(order_timestamp) AS order_month,
  string_agg(DISTINCT pipeline_run_id, ',' ORDER BY pipeline_run_id) AS runs,
  count(DISTINCT pipeline_run_id) AS run_count FROM ({_MERGED}) GROUP BY 1, 2"""
ORACLES["table_load_log"] = f"""
{_BOTH}, a AS (SELECT {_ACTION} AS action FROM new n LEFT JOIN old o ON n.order_id = o.order_id)
SELECT 1 AS version, '{OLD_RUN}' AS pipeline_run_id, 'full' AS load_scope, count(*) AS row_count,
  count(*) AS rows_inserted, 0 AS rows_updated, 0 AS rows_unchanged FROM old
UNION ALL SELECT 2, '{RUN}', 'full', count(*), count(*) FILTER (WHERE action = 'insert'),
  count(*) FILTER (WHERE action = 'update'), count(*) FILTER (WHERE action = 'unchanged') FROM a
UNION ALL SELECT 3, 'run_again', 'full', count(*), 0, 0, count(*) FROM a"""
ORACLES["partition_load"] = f"""
SELECT 'order_year=1998/order_month=3' AS partition_key, count(*) AS row_count, 'run_2' AS pipeline_run_id,
  0 AS rows_inserted, 0 AS rows_updated, count(*) AS rows_unchanged, 2 AS load_count
FROM ({CURATED}) WHERE year(order_timestamp) = 1998 AND month(order_timestamp) = 3"""

# ------------------------------------------------------------------ partitions

_BY_MONTH = """SELECT year(l_shipdate) AS order_year, month(l_shipdate) AS order_month, {cols} FROM lineitem
GROUP BY 1, 2"""
ORACLES["partition_counts"] = ORACLES["partition_manifest"] = """
SELECT *, 'order_year=' || order_year || '/order_month=' || order_month AS partition_key
FROM (""" + _BY_MONTH.format(cols="count(*) AS row_count") + ")"
ORACLES["partition_run_manifest"] = f"""
SELECT year(l_shipdate) AS order_year, month(l_shipdate) AS order_month,
  'order_year=' || year(l_shipdate) || '/order_month=' || month(l_shipdate) AS partition_key,
  CASE WHEN l_linenumber % 2 = 0 THEN 'run_even' ELSE 'run_odd' END AS pipeline_run_id, count(*) AS row_count,
  {micros('min(l_shipdate)')} AS first_at, {micros('max(l_shipdate)')} AS last_at FROM lineitem GROUP BY ALL"""
ORACLES["partition_bounds"] = _BY_MONTH.format(
    cols=f"{micros('min(l_shipdate)')} AS first_at, {micros('max(l_shipdate)')} AS last_at")
_IN_MONTH = f"""
SELECT {_LINE_ID} AS order_id, {micros('l_shipdate')} AS order_timestamp, l_quantity, l_extendedprice{{extra}}
FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-03-01' AND l_shipdate < TIMESTAMP '1998-04-01'"""
ORACLES["month_range_scan"] = _IN_MONTH.format(extra="")
ORACLES["month_partition_scan"] = ORACLES["month_directory_read"] = _IN_MONTH.format(
    extra=", 1998 AS order_year, 3 AS order_month")
ORACLES["misfiled_rows"] = """
SELECT year(o_orderdate) AS order_year, month(o_orderdate) AS order_month, count(*) FILTER (
  WHERE date_trunc('month', o_orderdate) <> date_trunc('month', l_shipdate)) AS misfiled, count(*) AS row_count
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
ORACLES["month_read_comparison"] = f"""
SELECT scenario, 'order_year=1998/order_month=3' AS partition_key, row_count,
  scenario IN ('partition_filter', 'month_directory') AS reads_less
FROM (SELECT unnest(['read_all_then_filter', 'time_predicate', 'partition_filter', 'month_directory']) AS scenario),
  (SELECT count(*) AS row_count FROM ({CURATED})
   WHERE year(order_timestamp) = 1998 AND month(order_timestamp) = 3)"""
_FORMATS = "(SELECT unnest(['csv', 'csv_typed_read', 'jsonl', 'parquet']) AS storage_type)"
ORACLES["format_row_sets"] = f"""
SELECT storage_type, row_count, hashes, first_hash FROM {_FORMATS},
  (SELECT count(*) AS row_count, count(DISTINCT record_hash) AS hashes, min(record_hash) AS first_hash
   FROM ({CURATED}))"""
_SHOWN = {
    "csv": "order_id:string quantity:string unit_price:string net_amount:string order_timestamp:string",
    "typed": "order_id:string quantity:bigint unit_price:decimal(14,2) net_amount:decimal(16,2) order_timestamp:timestamp_ntz",
}
ORACLES["format_comparison"] = f"""
SELECT storage_type, row_count, filtered_row_count, true AS has_bytes, CASE storage_type WHEN 'csv' THEN '{_SHOWN["csv"]}'
  ELSE '{_SHOWN["typed"]}' END AS dtypes FROM {_FORMATS},
  (SELECT count(*) AS row_count, count(*) FILTER (WHERE status = '1-URGENT') AS filtered_row_count FROM ({CURATED}))"""
ORACLES["median_measurements"] = """
SELECT event_type, round(median(value), 6) AS median_value FROM events GROUP BY 1"""
_ARRAYS = f"""
SELECT lpad(CAST(p_partkey // 1000 AS VARCHAR), 9, '0') AS bucket, p_partkey // 1000 AS b,
  '[' || string_agg(record, ',' || chr(10) || ' ' ORDER BY p_partkey, version) || ']' AS value
FROM ({RAW_PRODUCTS}) GROUP BY ALL"""
ORACLES["written_fingerprints"] = f"""
SELECT bucket, strlen(value) + 1 AS bytes, sha256(value || chr(10)) AS sha256 FROM ({_ARRAYS})"""
ORACLES["chunked_fingerprints"] = f"""
WITH c AS (SELECT bucket, strlen(value) + 1 AS bytes, unnest(range((strlen(value) + 4096) // 4096)) AS i, value || chr(10) AS body FROM ({_ARRAYS}))
SELECT bucket, bytes, sha256(unhex(string_agg(sha256(substr(body, i * 4096 + 1, 4096)), '' ORDER BY i))) AS sha256,
  4096::BIGINT AS chunk_bytes FROM c GROUP BY bucket, bytes"""
ORACLES["quoted_document_records"] = """
SELECT row_number() OVER (ORDER BY doc_id) AS source_record_number, CAST(doc_id AS VARCHAR) AS doc_id,
  sha256(coalesce(text, '')) AS sha256 FROM documents"""
ORACLES["source_changes"] = f"""
SELECT bucket, sha256(value || chr(10)) AS recorded_sha256,
  CASE WHEN b > 0 THEN sha256(value || ' ' || chr(10)) END AS current_sha256
FROM ({_ARRAYS}) WHERE b = 0 OR b % 2 = 1
UNION ALL SELECT 'n', NULL, sha256('[' || count(*) || ']' || chr(10)) FROM region"""
ORACLES["superseded_copies"] = """
SELECT l_orderkey, line, quantity, l_partkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, line ORDER BY quantity DESC NULLS LAST, l_partkey DESC) AS rn FROM (
    SELECT l_orderkey, CASE WHEN l_linenumber < 7 THEN l_linenumber END AS line,
      CASE WHEN l_quantity > 10 THEN l_quantity END AS quantity, l_partkey
    FROM lineitem, (SELECT unnest([1, 2]) AS copy) WHERE copy = 1 OR l_orderkey % 3 = 0)) WHERE rn > 1"""

# ------------------------------------------------------------------ history

_K = "CAST(props->>'$.k' AS BIGINT)"
_EVENTS = f"""
SELECT *, {_K} AS k, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING' ELSE 'SUCCESS' END AS status
FROM events"""
_LAST = "ORDER BY ts DESC, event_id DESC"
_ATTEMPTS = f"""
SELECT user_id || '/' || event_type AS attempt_id, 'run_' || user_id AS pipeline_run_id, event_type AS stage,
  1 AS attempt, status, {micros('started')} AS started_at_utc, {micros('completed')} AS completed_at_utc,
  k AS rows_in, k * 2 AS rows_out, 'event ' || event_id AS message
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type {_LAST}) AS rn,
        min(ts) OVER (PARTITION BY user_id, event_type) AS started,
        max(CASE WHEN status <> 'RUNNING' THEN ts END) OVER (PARTITION BY user_id, event_type) AS completed
      FROM ({_EVENTS})) WHERE rn = 1"""
ORACLES["stage_attempt_log"] = _ATTEMPTS
ORACLES["run_state_log"] = f"""
SELECT 'run_' || user_id AS pipeline_run_id, {micros('min(ts)')} AS started_at_utc,
  {micros("max(ts) FILTER (WHERE status <> 'RUNNING')")} AS completed_at_utc, first(status {_LAST}) AS status,
  first(event_type {_LAST}) AS last_stage, first(k {_LAST}) FILTER (WHERE event_type = 'click') AS rows_staging,
  first(k {_LAST}) FILTER (WHERE event_type = 'purchase') AS rows_curated,
  first(k {_LAST}) FILTER (WHERE event_type = 'error') AS rows_quarantined,
  first(event_type || ': event ' || event_id {_LAST}) AS message
FROM ({_EVENTS}) GROUP BY user_id"""
ORACLES["audit_trail_checks"] = f"""
SELECT pipeline_run_id, count(*) AS attempts,
  count(*) FILTER (WHERE stage = 'purchase' AND status = 'SUCCESS') AS successful_loads,
  count(*) FILTER (WHERE status = 'RUNNING' AND stage <> 'validate') AS unfinished
FROM ({_ATTEMPTS}) GROUP BY 1"""
ORACLES["latest_run_pointers"] = f"""
SELECT event_type AS layer, 'run_' || first(user_id {_LAST}) AS pipeline_run_id, {micros('max(ts)')} AS marked_at_utc
FROM events GROUP BY 1"""
ORACLES["partition_load_history"] = f"""
SELECT 'order_year=' || year(ts) || '/order_month=' || day(ts) AS partition_key,
  {micros('first(ts ORDER BY event_id DESC)')} AS loaded_at_utc, first(k * 3 ORDER BY event_id DESC) AS row_count,
  'run_' || first(user_id ORDER BY event_id DESC) AS pipeline_run_id, first(k ORDER BY event_id DESC) AS rows_inserted,
  first(k + 1 ORDER BY event_id DESC) AS rows_updated, first(k * 2 ORDER BY event_id DESC) AS rows_unchanged,
  count(*) AS load_count
FROM ({_EVENTS}) WHERE event_type <> 'view' GROUP BY 1"""

# ------------------------------------------------------------------ report

ORACLES["curated_lookup"] = f"""
SELECT order_id, quantity, unit_price, net_amount, status, record_hash FROM ({CURATED})
WHERE order_id IN ('1-3', '1013-3', '1070-2', '1119-1', '1153-5', '1204-6', '1250-5', '1306-5')"""
ORACLES["layer_counts"] = f"""
SELECT 'raw' AS layer, count(*) AS row_count FROM lineitem
UNION ALL SELECT 'latest', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
UNION ALL SELECT 'staged', count(*) FROM ({judged()}) WHERE reason_codes = ''
UNION ALL SELECT 'curated', count(*) FROM ({routed()}) WHERE reference_codes = ''
UNION ALL SELECT 'orphaned', count(*) FROM ({routed()}) WHERE reference_codes <> ''"""
