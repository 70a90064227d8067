"""Staging as one plan with one shuffle.

Key and version time are typed before the shuffle, everything else behind it, on one row per key. Records that
cannot take part in that contest travel as groups of their own, spread by record number, so blank keys never pile up.
Where a row goes is the column `route`: write the classified rows once, partitioned by it, and read the routes back.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.parsing import parse_number, parse_utc
from ledgerloom.functions.text import clean_text, collapse_spaces, python_repr, title_case
from ledgerloom.operators.rules import (
    DEFAULT_LIMITS, Limits, Rule, ShownOrder, customer_rules, order_rules, product_rules, reason_codes,
    reason_detail, version_rules,
)
from ledgerloom.operators.versions import latest_version

# Column lists of the quarantine and the source datasets.
QUARANTINE_COLUMNS = (
    "pipeline_run_id", "quarantined_at_utc", "layer", "dataset", "business_key", "source_record_number",
    "reason_codes", "reason_detail", "source_record",
)
QUARANTINE_SCHEMA = (
    "pipeline_run_id string, quarantined_at_utc timestamp, layer string, dataset string, business_key string, "
    "source_record_number bigint, reason_codes string, reason_detail string, source_record string"
)
CUSTOMER_SOURCE = (
    "customer_id", "first_name", "last_name", "email", "city", "customer_tier", "created_at", "updated_at",
)
ORDER_SOURCE = (
    "order_id", "customer_id", "product_id", "order_timestamp", "quantity", "unit_price", "discount_pct",
    "status", "updated_at",
)
PRODUCT_SCHEMA = (
    "product_id string, name string, brand string, category struct<name:string,department:string>, "
    "unit_price string, active boolean, updated_at string"
)

# Stored layout of the classified rows; `route` is the partition column.
_JUDGED = (", source_record_number bigint, reason_codes string, reason_detail string, source_record string, "
           "pipeline_run_id string, staged_at_utc timestamp, route string")
CLASSIFIED_SCHEMA = {
    "customers": "customer_id string, first_name string, last_name string, email string, "
                 "is_email_missing boolean, city string, customer_tier string, created_at timestamp, "
                 "updated_at timestamp" + _JUDGED,
    "products": "product_id string, product_name string, brand string, category_name string, "
                "category_department string, unit_price double, active boolean, updated_at timestamp" + _JUDGED,
    "orders": "order_id string, customer_id string, product_id string, order_timestamp timestamp, "
              "quantity double, unit_price double, discount_pct double, status string, "
              "updated_at timestamp" + _JUDGED,
}

STAGED, EARLY, LATE = "staged", "rejected_early", "rejected_late"


@dataclass(frozen=True)
class Dataset:
    """How one source becomes a staging table. Expressions read the raw values as `raw.<field>`."""

    name: str
    key: str
    raw: Column
    fields: dict[str, Column]
    rules: Sequence[Rule]
    source_record: Column
    shown_updated_at: Column


def _csv_raw(columns: Sequence[str]) -> tuple[Column, Column]:
    """Raw struct of text columns, and its JSON image (blank text stays '')."""
    image = F.struct(*[F.coalesce(F.col(f"raw.{c}"), F.lit("")).alias(c) for c in columns])
    return F.struct(*columns), F.to_json(image)


def customers() -> Dataset:
    raw, image = _csv_raw(CUSTOMER_SOURCE)
    text = {c: clean_text(F.col(f"raw.{c}")) for c in CUSTOMER_SOURCE}
    email = F.lower(text["email"])
    return Dataset(
        name="customers", key="customer_id", raw=raw, source_record=image,
        shown_updated_at=python_repr(F.col("raw.updated_at")),
        fields={
            "customer_id": text["customer_id"],
            "first_name": text["first_name"],
            "last_name": text["last_name"],
            "email": email,
            "is_email_missing": email.isNull(),
            "city": title_case(collapse_spaces(text["city"])),
            "customer_tier": text["customer_tier"],
            "created_at": parse_utc(F.col("raw.created_at")),
            "updated_at": parse_utc(F.col("raw.updated_at")),
        },
        rules=customer_rules(text["created_at"].isNotNull(), python_repr(F.col("raw.created_at"))),
    )


def products() -> Dataset:
    """Raw input: one JSON object per record, as text, in the column `record`."""
    raw = F.from_json("record", PRODUCT_SCHEMA)
    return Dataset(
        name="products", key="product_id", raw=raw, source_record=F.col("record"),
        shown_updated_at=_shown_json("updated_at"),
        fields={
            "product_id": clean_text(F.col("raw.product_id")),
            "product_name": clean_text(F.col("raw.name")),
            "brand": clean_text(F.col("raw.brand")),
            "category_name": clean_text(F.col("raw.category.name")),
            "category_department": clean_text(F.col("raw.category.department")),
            "unit_price": parse_number(F.col("raw.unit_price")),
            "active": F.col("raw.active"),
            "updated_at": parse_utc(F.col("raw.updated_at")),
        },
        rules=product_rules(_shown_json("unit_price")),
    )


def orders(limits: Limits = DEFAULT_LIMITS) -> Dataset:
    raw, image = _csv_raw(ORDER_SOURCE)
    text = {c: clean_text(F.col(f"raw.{c}")) for c in ("order_id", "customer_id", "product_id", "status")}
    as_shown = {c: python_repr(F.col(f"raw.{c}")) for c in ORDER_SOURCE[3:]}
    return Dataset(
        name="orders", key="order_id", raw=raw, source_record=image,
        shown_updated_at=as_shown["updated_at"],
        fields={
            "order_id": text["order_id"],
            "customer_id": text["customer_id"],
            "product_id": text["product_id"],
            "order_timestamp": parse_utc(F.col("raw.order_timestamp")),
            "quantity": parse_number(F.col("raw.quantity")),
            "unit_price": parse_number(F.col("raw.unit_price")),
            "discount_pct": parse_number(F.col("raw.discount_pct")),
            "status": F.upper(text["status"]),
            "updated_at": parse_utc(F.col("raw.updated_at")),
        },
        rules=order_rules(ShownOrder(
            as_shown["order_timestamp"], as_shown["quantity"], as_shown["unit_price"],
            as_shown["discount_pct"], as_shown["status"], limits)),
    )


def _shown_json(field: str) -> Column:
    """A JSON value as a reason message shows it: text quoted, numbers as written, null as None."""
    text = F.get_json_object("record", f"$.{field}")
    number = F.from_json("record", f"`{field}` double")[field]
    flag = F.from_json("record", f"`{field}` boolean")[field]
    return (
        F.when(text.isNull(), F.lit("None"))
        .when(number.isNotNull(), text)
        .when(flag.isNotNull(), F.initcap(text))
        .otherwise(python_repr(text))
    )


# ------------------------------------------------------------------ steps

def version_gate(df: DataFrame, key: str, shown_updated_at: Column) -> DataFrame:
    """Add gate_codes / gate_detail over `key` and `updated_at`; both are '' for a versionable record."""
    gate = version_rules(key, shown_updated_at)
    return df.withColumns({"gate_codes": reason_codes(gate), "gate_detail": reason_detail(gate)})


def keep_latest(gated: DataFrame, keys: Sequence[str], tie_break: Sequence[Column]) -> DataFrame:
    """Latest version per key among gated rows; rejected rows pass through untouched."""
    alone = F.when(F.col("gate_codes") != "", F.col("source_record_number"))
    return latest_version(gated.withColumn("_alone", alone), [*keys, "_alone"],
                          [F.col("updated_at").desc(), *tie_break]).drop("_alone")


def judge(latest: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Apply the rules to gated winners: adds route, reason_codes and reason_detail."""
    passed_gate = F.col("gate_codes") == ""
    judged = latest.withColumns({
        "reason_codes": F.when(passed_gate, reason_codes(rules)).otherwise(F.col("gate_codes")),
        "reason_detail": F.when(passed_gate, reason_detail(rules)).otherwise(F.col("gate_detail")),
    })
    route = F.when(~passed_gate, F.lit(EARLY)).when(F.col("reason_codes") != "", F.lit(LATE))
    return judged.withColumn("route", route.otherwise(F.lit(STAGED))).drop("gate_codes", "gate_detail")


def settled(judged: DataFrame) -> DataFrame:
    """The same rows, computed before any filter on them. A filter on `route` would else be moved below the projections and
    type and judge every record a second time."""
    return judged.select(F.inline(F.array(F.struct(*judged.columns))))


def classify(numbered: DataFrame, spec: Dataset, *only: str) -> DataFrame:
    """Typed, judged winners plus early rejects of one numbered raw source.

    Columns: the staging fields, source_record_number, route, reason_codes, reason_detail and, for
    rejects only, source_record. With `only`, these columns alone: the others are then neither shuffled nor computed.
    """
    slim = numbered.select("source_record_number", *_raw_inputs(numbered, spec), spec.raw.alias("raw"))
    versioned = slim.withColumns({spec.key: spec.fields[spec.key], "updated_at": spec.fields["updated_at"]})
    gated = version_gate(versioned, spec.key, spec.shown_updated_at)
    latest = by_columns(gated, lambda rows: keep_latest(rows, [spec.key], [F.col("source_record_number").desc()]))
    typed = latest.withColumns({n: c for n, c in spec.fields.items() if n not in (spec.key, "updated_at")})
    judged = judge(typed, spec.rules)
    whole = judged.select(
        *spec.fields, "source_record_number", "route", "reason_codes", "reason_detail",
        F.when(F.col("route") != STAGED, spec.source_record).alias("source_record"),
    )
    return settled(whole.select(*only) if only else whole)


def by_columns(gated: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """`step` over rows whose raw values are columns of their own, which take less room in a shuffle than a struct. The parsed
    struct of a JSON source stays whole, as it may be null."""
    if "record" in gated.columns:
        return step(gated)
    names = gated.schema["raw"].dataType.names
    apart = step(gated.withColumns({f"_raw_{n}": F.col(f"raw.`{n}`") for n in names}).drop("raw"))
    return apart.withColumn("raw", F.struct(*[F.col(f"_raw_{n}").alias(n) for n in names])).drop(*[f"_raw_{n}" for n in names])


def _raw_inputs(numbered: DataFrame, spec: Dataset) -> list[str]:
    """A JSON source keeps its record text next to the parsed struct."""
    return ["record"] if spec.name == "products" and "record" in numbered.columns else []


def stamped(classified: DataFrame, run_id: str, at: datetime) -> DataFrame:
    """With the audit columns under which classified rows are stored."""
    return classified.withColumns({"pipeline_run_id": F.lit(run_id), "staged_at_utc": F.lit(at).cast("timestamp")})


def staged_table(stored: DataFrame, spec: Dataset) -> DataFrame:
    """The staging table out of stamped rows: fields, lineage and audit columns. Quantity is whole by now: bigint."""
    rows = stored.where(F.col("route") == STAGED)
    if "quantity" in spec.fields:
        rows = rows.withColumn("quantity", F.col("quantity").cast("bigint"))
    return rows.select(*spec.fields, "source_record_number", "pipeline_run_id", "staged_at_utc")


def staged_rows(classified: DataFrame, spec: Dataset, run_id: str, at: datetime) -> DataFrame:
    return staged_table(stamped(classified, run_id, at), spec)


def quarantine_rows(classified: DataFrame, spec: Dataset, run_id: str, at: datetime) -> DataFrame:
    rejected = classified.where(F.col("route") != STAGED).withColumn("business_key", F.col(spec.key))
    return quarantine_frame(rejected, "staging", spec.name, run_id, at)


def quarantine_frame(rows: DataFrame, layer: str, dataset: str, run_id: str, at: datetime) -> DataFrame:
    """The nine quarantine columns from rows that carry key, number, reasons and source record.

    `phase` orders early before late rejects where the route is known.
    """
    return rows.withColumns({
        "pipeline_run_id": F.lit(run_id),
        "quarantined_at_utc": F.lit(at).cast("timestamp"),
        "layer": F.lit(layer),
        "dataset": F.lit(dataset),
    }).select(*QUARANTINE_COLUMNS)


def stage(numbered: DataFrame, spec: Dataset, run_id: str, at: datetime) -> tuple[DataFrame, DataFrame]:
    """(staged, quarantine) of one raw source. For large inputs write `classify` once instead."""
    classified = classify(numbered, spec)
    return staged_rows(classified, spec, run_id, at), quarantine_rows(classified, spec, run_id, at)


def superseded_count(numbered: DataFrame, spec: Dataset) -> DataFrame:
    """(dataset, superseded): versions beyond the first of each key among the records that pass the version gate.

    Counted from the raw records alone, so that it can prove the routes wrong."""
    slim = numbered.select(*_raw_inputs(numbered, spec), spec.raw.alias("raw"))
    keyed = slim.select(spec.fields[spec.key].alias("key"), spec.fields["updated_at"].alias("at"))
    versions = keyed.where(F.col("key").isNotNull() & F.col("at").isNotNull()).groupBy("key").agg(
        (F.count(F.lit(1)) - 1).alias("more"))
    return versions.agg(F.coalesce(F.sum("more"), F.lit(0)).alias("superseded")).select(
        F.lit(spec.name).alias("dataset"), "superseded")
