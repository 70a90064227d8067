"""Data-contract checks of the curated rows, and checks of the loaded table against a run.

Row checks are predicates counted in one aggregate; nothing is collected but counts. Sample ids come
from a second pass that runs only when something failed and keeps five ids per check and map task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.errors import ContractViolation
from ledgerloom.functions.hashing import CURATED_COLUMNS, business_hash, is_sha256, packed_hash
from ledgerloom.functions.money import discount_cents, to_basis_points, to_cents
from ledgerloom.operators.rules import DEFAULT_LIMITS, Limits, not_in

SAMPLE_SIZE = 5
BUCKETS = 4096  # of keys, in the comparison of row sets
DUPLICATED = "order_id is duplicated"
HASH_MISMATCH = "record_hash does not match business columns"


@dataclass(frozen=True)
class Check:
    message: str
    bad: Column


def contract_checks(limits: Limits = DEFAULT_LIMITS) -> list[Check]:
    """The ordered checks. A predicate that comes out null counts as broken."""
    c = F.col
    lo, hi = limits.min_quantity, limits.max_quantity
    price, gross = to_cents(c("unit_price")), to_cents(c("gross_amount"))
    discount, net = to_cents(c("discount_amount")), to_cents(c("net_amount"))
    expected_discount = discount_cents(gross, to_basis_points(c("discount_pct")))

    def negative(name: str) -> Column:
        return F.coalesce(c(name) < 0, F.lit(False))  # a missing amount fails the arithmetic, not this

    def differs(a: Column, b: Column) -> Column:
        return a.isNull() | ~a.eqNullSafe(b)

    return [
        Check("order_id is null", c("order_id").isNull()),
        Check(DUPLICATED, F.lit(False)),  # counted per key, see _duplicates
        *[Check(f"{n} is null", c(n).isNull()) for n in ("customer_id", "product_id", "order_timestamp", "status")],
        Check(f"quantity outside {lo}..{hi}", ~c("quantity").between(lo, hi)),
        Check("unit_price is negative", negative("unit_price")),
        Check("discount_pct outside 0..1", ~c("discount_pct").between(0, 1)),
        *[Check(f"{n} is negative", negative(n)) for n in ("gross_amount", "discount_amount", "net_amount")],
        Check("gross_amount != quantity * unit_price", differs(gross, c("quantity").cast("bigint") * price)),
        Check("discount_amount != round(gross_amount * discount_pct, 2)", differs(discount, expected_discount)),
        Check("net_amount != gross_amount - discount_amount", differs(net, gross - discount)),
        Check("status is not an allowed status", not_in(c("status"), limits.statuses)),
        *[Check(f"audit column {n} is null", c(n).isNull())
          for n in ("source_updated_at", "pipeline_run_id", "processed_at_utc", "record_hash")],
        Check("record_hash is not a SHA-256 hex digest", ~is_sha256(c("record_hash"))),
        Check(HASH_MISMATCH, differs(business_hash(), c("record_hash"))),
    ]


def _bad(check: Check) -> Column:
    return F.coalesce(check.bad, F.lit(True))


def _by_key(df: DataFrame, limits: Limits) -> DataFrame:
    """(order_id, bad): per key, how many of its rows break each check. One scan and one aggregate give all counts;
    the rows of a repeated key all break the check for duplicates."""
    checks = contract_checks(limits)
    rows = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(_bad(c)).alias(f"c{i}") for i, c in enumerate(checks)])
    repeated = F.col("order_id").isNotNull() & (F.col("n") > 1)
    counts = [F.when(repeated, F.col("n")).otherwise(F.lit(0)) if c.message == DUPLICATED else F.col(f"c{i}") for i, c in enumerate(checks)]
    return rows.select("order_id", F.array(*counts).alias("bad"))


def violation_counts(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """(check_no, message, bad_rows) of every check, broken or not, from one scan."""
    checks = contract_checks(limits)
    sums = [F.coalesce(F.sum(F.col("bad")[i]), F.lit(0)) for i in range(len(checks))]
    totals = _by_key(df, limits).agg(F.array(*sums).alias("bad_rows"))
    messages = F.array(*[F.lit(c.message) for c in checks])
    return totals.select(F.posexplode("bad_rows").alias("check_no", "bad_rows")).select(
        "check_no", messages[F.col("check_no")].alias("message"), "bad_rows")


def violation_samples(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """(check_no, sample): the five smallest offending order ids per check, comma separated, from one scan.

    An id is named for each of its rows; what is ranked are at most five of a key, and each task passes on five of a check."""
    shown = F.coalesce(F.col("order_id").cast("string"), F.lit("None"))
    named = F.flatten(F.transform("bad", lambda n, i: F.array_repeat(
        F.struct(i.alias("check_no"), shown.alias("order_id")), F.least(n, F.lit(SAMPLE_SIZE)).cast("int"))))
    broken = _by_key(df, limits).select(F.explode(named).alias("b")).select("b.check_no", "b.order_id")
    rank = F.row_number().over(Window.partitionBy("check_no").orderBy("order_id"))
    smallest = broken.withColumn("_rank", rank).where(F.col("_rank") <= SAMPLE_SIZE)
    return smallest.groupBy("check_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rank", "order_id"))),
                                 lambda s: s["order_id"]), ", ").alias("sample"))


def contract_violations(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Broken checks with their row count and sample. The hash is only compared when all else holds."""
    last = len(contract_checks(limits)) - 1
    broken = violation_counts(df, limits).where("bad_rows > 0")
    # At most one row per check is left here, so a window over all of them is a window over two dozen rows.
    others = F.max(F.col("check_no") != last).over(Window.partitionBy(F.lit(0)))
    reported = broken.withColumn("_others", others).where((F.col("check_no") != last) | ~F.col("_others"))
    return reported.join(violation_samples(df, limits), "check_no", "left").select(
        "check_no", "message", "bad_rows", "sample")


def run_ids(df: DataFrame) -> DataFrame:
    """Distinct run ids with their rows; a curated dataset must hold exactly one."""
    return df.groupBy("pipeline_run_id").agg(F.count(F.lit(1)).alias("row_count"))


def contract_errors(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> list[str]:
    """Human-readable errors, [] when the data keeps the contract."""
    missing = [c for c in CURATED_COLUMNS if c not in df.columns]
    if missing:
        return [f"missing required columns: {', '.join(missing)}"]
    last = len(contract_checks(limits)) - 1
    broken = {r["check_no"]: r for r in violation_counts(df, limits).where("bad_rows > 0").collect()}
    mixed = run_ids(df).where(F.col("pipeline_run_id").isNotNull()).count()
    mixing = [f"curated dataset mixes {mixed} pipeline_run_id values"] if mixed > 1 else []
    if mixing or set(broken) - {last}:
        broken.pop(last, None)
    if not broken:
        return mixing
    samples = {r["check_no"]: r["sample"] for r in violation_samples(df, limits).collect()}
    errors = [f"{r['message']}: {r['bad_rows']} row(s) (e.g. {samples[n]})" for n, r in sorted(broken.items())]
    return errors + mixing


def require_contract(df: DataFrame, limits: Limits = DEFAULT_LIMITS) -> None:
    """The quality gate in front of a load."""
    errors = contract_errors(df, limits)
    if errors:
        raise ContractViolation(errors)


# ------------------------------------------------------------------ loaded table

def table_rule_violated(limits: Limits = DEFAULT_LIMITS) -> Column:
    """One OR-ed predicate with SQL semantics: a null comparison does not count."""
    c = F.col
    gross = c("quantity").cast("decimal(10,0)") * c("unit_price")
    discount = F.round(c("gross_amount") * c("discount_pct"), 2)
    return (
        ~c("quantity").between(limits.min_quantity, limits.max_quantity)
        | (c("unit_price") < 0) | ~c("discount_pct").between(0, 1)
        | (c("gross_amount") < 0) | (c("discount_amount") < 0) | (c("net_amount") < 0)
        | (c("gross_amount") != gross) | (c("discount_amount") != discount)
        | (c("net_amount") != c("gross_amount") - c("discount_amount"))
        | ~c("status").isin(list(limits.statuses)) | ~is_sha256(c("record_hash"))
    )


def key_summary(stored: DataFrame) -> DataFrame:
    """(total, distinct_ids, null_ids): unique and complete keys have total = distinct_ids and no nulls.

    Counted per key first, so a key with many copies is combined map-side.
    """
    per_key = stored.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total"),
        F.count("order_id").alias("distinct_ids"),
        F.coalesce(F.sum(F.when(F.col("order_id").isNull(), F.col("n"))), F.lit(0)).alias("null_ids"),
    )


def compare_with_expected(stored: DataFrame, expected: DataFrame) -> DataFrame:
    """(absent, differing, tampered) over the expected keys, from one join.

    absent: not stored. differing: stored with another hash. tampered: the stored hash does not fit the
    stored columns.
    """
    wanted = expected.select("order_id", F.col("record_hash").alias("_expected_hash"))
    have = stored.withColumn("_recomputed", business_hash()).select(
        "order_id", "record_hash", "_recomputed", F.lit(True).alias("_stored"))
    both = wanted.join(have, "order_id", "left")
    found = F.col("_stored").isNotNull()
    return both.agg(
        F.count_if(~found).alias("absent"),
        F.count_if(found & ~F.col("record_hash").eqNullSafe(F.col("_expected_hash"))).alias("differing"),
        F.count_if(found & ~F.col("record_hash").eqNullSafe(F.col("_recomputed"))).alias("tampered"),
    )


def missing_ids(stored: DataFrame, expected: DataFrame) -> DataFrame:
    return expected.select("order_id").join(stored.select("order_id"), "order_id", "left_anti")


def differing_ids(stored: DataFrame, expected: DataFrame) -> DataFrame:
    theirs = expected.select("order_id", F.col("record_hash").alias("expected_hash"))
    ours = stored.select("order_id", F.col("record_hash").alias("stored_hash"))
    return ours.join(theirs, "order_id").where(~F.col("stored_hash").eqNullSafe(F.col("expected_hash")))


def restrict_to_keys(df: DataFrame, keys: DataFrame, key: str = "order_id") -> DataFrame:
    """Rows whose key is listed, as a semi join: the list may be any size."""
    return df.join(keys.select(key), key, "left_semi")


def table_errors(stored: DataFrame, expected: DataFrame, limits: Limits = DEFAULT_LIMITS,
                 name: str = "sales_order_lines") -> list[str]:
    keys = key_summary(stored).first()
    broken = stored.agg(F.count_if(table_rule_violated(limits)).alias("n")).first()["n"]
    diff = compare_with_expected(stored, expected).first()
    found = [
        (keys["total"] != keys["distinct_ids"] or keys["null_ids"] > 0,
         f"{keys['total']} rows but {keys['distinct_ids']} distinct order_id ({keys['null_ids']} null)"),
        (broken, f"{broken} row(s) violate quantity/amount/status/hash rules"),
        (diff["absent"], f"{diff['absent']} expected order_id(s) are missing"),
        (diff["differing"], f"{diff['differing']} row(s) hold different business content than this run"),
        (diff["tampered"], f"{diff['tampered']} row(s) whose record_hash does not match the stored columns"),
    ]
    return [f"{name}: {text}" for failed, text in found if failed]


def _identities(df: DataFrame) -> DataFrame:
    """(order_id, record_hash, bucket): the bucket follows from the id, so all rows of an id share one."""
    ids = df.select(F.col("order_id").cast("string").alias("order_id"), F.col("record_hash").cast("string").alias("record_hash"))
    return ids.withColumn("bucket", F.pmod(F.xxhash64("order_id"), F.lit(BUCKETS)))


def multiset_digests(df: DataFrame) -> dict[int, tuple[int, ...]]:
    """bucket -> number of rows and order-free sums of two 64-bit hashes of each row, halves summed apart so that they cannot
    overflow below two billion rows a bucket. Sums combine before the shuffle; at most `BUCKETS` rows reach the driver."""
    halves = []
    for seed in (41, 43):
        h = F.xxhash64("order_id", "record_hash", F.col("order_id").isNull(), F.col("record_hash").isNull(), F.lit(seed))
        halves += [F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.sum(F.shiftrightunsigned(h, 32))]
    sums = _identities(df).groupBy("bucket").agg(F.count(F.lit(1)), *halves).collect()
    return {r[0]: tuple(r[1:]) for r in sums}


def row_set_difference(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(expected_rows, actual_rows, mismatched): equal sets have equal counts and nothing mismatched.

    Digests by bucket of the key are compared first; only the rows of buckets whose digests differ are shuffled and counted, so equal sets
    cost a scan each. Two buckets of different rows pass for equal if both their 64-bit sums agree by chance. Both sides are
    counted per (id, hash), so copies never multiply.
    """
    ours, theirs = multiset_digests(expected), multiset_digests(actual)
    rows = [sum(d[0] for d in side.values()) for side in (ours, theirs)]
    differ = sorted(k for k in ours.keys() | theirs.keys() if ours.get(k) != theirs.get(k))
    if not differ:
        return expected.sparkSession.createDataFrame([(*rows, 0)], "expected_rows bigint, actual_rows bigint, mismatched bigint")

    def side(df: DataFrame, ours: int) -> DataFrame:
        met = _identities(df)
        if len(differ) < BUCKETS // 2:
            met = met.where(F.col("bucket").isin(differ))
        return met.select("order_id", packed_hash().alias("_hash"), F.lit(ours).alias("_ours"), F.lit(1 - ours).alias("_theirs"))

    # One shuffle of both sides; copies are one row a task.
    counted = side(expected, 1).unionByName(side(actual, 0)).groupBy("order_id", "_hash").agg(
        F.sum("_ours").alias("_ours"), F.sum("_theirs").alias("_theirs"))
    unlike = F.count_if(F.col("_ours") != F.col("_theirs")).alias("mismatched")
    return counted.agg(unlike).select(*[F.lit(n).cast("bigint").alias(c) for n, c in zip(rows, ("expected_rows", "actual_rows"))], "mismatched")


def require_same_rows(expected: DataFrame, actual: DataFrame, label: str) -> None:
    r = row_set_difference(expected, actual).first()
    if r["expected_rows"] != r["actual_rows"] or r["mismatched"]:
        raise ContractViolation([f"{label} holds {r['actual_rows']} of {r['expected_rows']} rows, "
                                 f"{r['mismatched']} of them unlike the original"])

