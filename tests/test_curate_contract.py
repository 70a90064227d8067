from decimal import Decimal

import pytest
from conftest import NOW, RUN
from fixtures import by_key, raw
from pyspark.sql import functions as F

from ledgerloom.errors import CardinalityError, ContractViolation
from ledgerloom.functions.hashing import business_hash
from ledgerloom.operators import contract, curate, staging

# quantity, price and discount of an order, then its gross, discount and net amount. The first is a fixed value: half a cent goes up.
AMOUNTS = {
    "B-1": ("1", "48375.06", "0.1", "48375.06", "4837.51", "43537.55"),
    "B-2": ("3", "19.99", "0.125", "59.97", "7.50", "52.47"),
    "B-3": ("20", "0.05", "1", "1.00", "1.00", "0.00"),
    "B-4": ("7", "0.145", "", None, None, None),
}
# The references of an order without match, its codes, and one detail.
LOOSE = {
    "L-1": ("K-99", "W-5", "orphan_customer_id", "customer_id K-99 not found in staging customers"),
    "L-2": ("K-17", "W-99", "orphan_product_id", "product_id W-99 not found in staging products"),
    "L-3": ("K-17", "W-6", "product_rejected_in_staging",
            "product_id W-6 exists in the source but was quarantined in staging (negative_unit_price)"),
    "L-4": ("K-18", "W-99", "customer_rejected_in_staging;orphan_product_id",
            "customer_id K-18 exists in the source but was quarantined in staging (invalid_created_at); "
            "product_id W-99 not found in staging products"),
}


@pytest.fixture(scope="module")
def layers(spark):
    """(orders, customers, products, rejects): one faultless and one rejected record of each dimension."""
    priced = [{"order_id": k, "quantity": q, "unit_price": p, "discount_pct": d} for k, (q, p, d, *_) in AMOUNTS.items()]
    loose = [{"order_id": k, "customer_id": c, "product_id": p} for k, (c, p, *_) in LOOSE.items()]
    made = {
        "orders": (raw(spark, "orders", *priced, *loose), staging.orders()),
        "customers": (raw(spark, "customers", {}, {"customer_id": "K-18", "created_at": "someday"}), staging.customers()),
        "products": (raw(spark, "products", {}, {"product_id": "W-6", "unit_price": -3}), staging.products()),
    }
    staged, rejected = zip(*(staging.stage(*one, RUN, NOW) for one in made.values()))
    return *staged, rejected[0].unionByName(rejected[1]).unionByName(rejected[2])


@pytest.fixture(scope="module")
def built(layers):
    orders, customers, products, rejected = layers
    return curate.build_curated(orders, customers, products, RUN, NOW, rejected)


@pytest.fixture(scope="module")
def curated(built):
    """One row that keeps the contract."""
    return built[0].where("order_id = 'B-1'").cache()


def test_amounts_are_exact_cents(built):
    got = {r["order_id"]: (r["gross_amount"], r["discount_amount"], r["net_amount"]) for r in built[0].collect()}
    assert got == {k: tuple(map(Decimal, want)) for k, (_, _, _, *want) in AMOUNTS.items() if want[0]}
    assert {(r["customer_city"], r["category"], r["brand"]) for r in built[0].collect()} == {("Turin", "Socks", "Fjell")}


def test_orders_without_match_go_to_quarantine(layers, built):
    rows = {r["business_key"]: r for r in built[1].collect()}
    assert {k: (r["reason_codes"], r["reason_detail"]) for k, r in rows.items()} == {k: (c, d) for k, (_, _, c, d) in LOOSE.items()}
    assert {(r["layer"], r["dataset"]) for r in rows.values()} == {("curated", "orders")}
    assert '"order_timestamp":"2024-02-10T12:30:00+00:00"' in rows["L-1"]["source_record"] and '"quantity":3' in rows["L-1"]["source_record"]
    assert built[0].count() + len(rows) == layers[0].count()  # none is dropped


def test_curated_columns_match_the_declared_schema(spark, curated):
    declared = spark.createDataFrame([], curate.CURATED_SCHEMA)
    assert curated.dtypes == declared.dtypes


def test_duplicate_dimension_key_fails_loudly(layers):
    orders, customers, products, _ = layers
    for twice in ((customers.unionByName(customers), products), (customers, products.unionByName(products))):
        with pytest.raises(CardinalityError):
            curate.build_curated(orders, *twice, RUN, NOW)


def test_the_hash_follows_the_content_alone(layers, built, curated):
    orders, customers, products, _ = layers
    later, _ = curate.build_curated(orders.repartition(3), customers, products, "another run", NOW)
    assert by_key(later, "order_id", "record_hash") == by_key(built[0], "order_id", "record_hash")
    was = curated.first()["record_hash"]
    for column, value in (("customer_city", "Bergen"), ("quantity", 2), ("net_amount", "0.01"), ("status", None), ("discount_pct", "0.2")):
        other = curated.withColumn(column, F.lit(value).cast(curated.schema[column].dataType))
        assert other.select(business_hash().alias("h")).first()["h"] != was


def test_contract_accepts_valid_rows(built):
    assert contract.contract_errors(built[0]) == []
    contract.require_contract(built[0])
    assert contract.contract_violations(built[0]).count() == 0


FAULTS = [
    ("order_id", None, ["order_id is null: 1 row(s) (e.g. None)"]),
    ("status", "MISLAID", ["status is not an allowed status: 1 row(s) (e.g. B-1)"]),
    ("unit_price", None, ["gross_amount != quantity * unit_price: 1 row(s) (e.g. B-1)"]),
    ("net_amount", "-0.01", ["net_amount is negative: 1 row(s) (e.g. B-1)",
                             "net_amount != gross_amount - discount_amount: 1 row(s) (e.g. B-1)"]),
    ("customer_city", "Bergen", ["record_hash does not match business columns: 1 row(s) (e.g. B-1)"]),
]


@pytest.mark.parametrize("column, value, errors", FAULTS)
def test_one_fault_breaks_its_checks_alone(curated, column, value, errors):
    bad = curated.withColumn(column, F.lit(value).cast(curated.schema[column].dataType))
    assert contract.contract_errors(bad) == errors
    lazy = contract.contract_violations(bad).orderBy("check_no").collect()
    told = [f"{r['message']}: {r['bad_rows']} row(s) (e.g. {r['sample']})" for r in lazy]
    assert told[: len(errors)] == errors  # beside them, a changed row also no longer has its hash


def test_all_broken_checks_are_counted(curated):
    bad = curated.withColumns({"status": F.lit("MISLAID"), "net_amount": F.lit(Decimal("-7.00"))})
    with pytest.raises(ContractViolation, match="and 3 more broken checks"):
        contract.require_contract(bad.unionByName(curated))


def test_a_batch_comes_from_one_run(curated):
    other = curated.withColumns({"pipeline_run_id": F.lit("an older run"), "order_id": F.lit("B-9")})
    assert contract.contract_errors(curated.unionByName(other)) == ["curated dataset mixes 2 pipeline_run_id values"]


def test_contract_names_missing_columns(curated):
    for gone in (["quantity"], ["order_id", "net_amount"], ["record_hash"]):
        assert contract.contract_errors(curated.drop(*gone)) == [f"missing required columns: {', '.join(gone)}"]


def test_sample_shows_five_smallest_ids(curated):
    many = curated.drop("order_id").crossJoin(
        curated.sparkSession.range(9).select(F.concat(F.lit("K"), "id").alias("order_id")))
    bad = many.withColumn("status", F.lit("LOST")).select(curated.columns)
    assert contract.contract_errors(bad) == [
        "status is not an allowed status: 9 row(s) (e.g. K0, K1, K2, K3, K4)"]


def test_table_checks(curated):
    assert contract.table_errors(curated, curated) == []
    stored = curated.withColumn("customer_city", F.lit("Bergen"))
    other = curated.withColumns({"order_id": F.lit("B-2")})
    errors = contract.table_errors(stored.unionByName(stored), curated.unionByName(other), name="t")
    assert errors == [
        "t: 2 rows but 1 distinct order_id (0 null)", "t: 1 expected order_id(s) are missing",
        "t: 2 row(s) whose record_hash does not match the stored columns"]


def test_row_set_equality(curated):
    contract.require_same_rows(curated, curated, "same")
    with pytest.raises(ContractViolation, match="holds 2 of 1 rows"):
        contract.require_same_rows(curated, curated.unionByName(curated), "twice")


def test_row_sets_by_digests(spark, monkeypatch):
    """Against counted pairs: nulls, copies, moved hashes, empty sides; few buckets, so that some agree and some differ."""
    import random
    from collections import Counter

    rng, schema = random.Random(9), "order_id string, record_hash string"
    base = [(rng.choice([None, *map(str, range(40))]), rng.choice([None, "x", "y"])) for _ in range(300)]
    sides = [base, base[::-1], base[1:], [*base, base[0]], [*base[1:], ("7", "new")], [], [(i, None) for i, _ in base]]
    for buckets in (4, 64):
        monkeypatch.setattr(contract, "BUCKETS", buckets)
        for other in sides:
            r = contract.row_set_difference(spark.createDataFrame(base, schema), spark.createDataFrame(other, schema)).first()
            a, b = Counter(base), Counter(other)
            assert tuple(r) == (len(base), len(other), sum(a[k] != b[k] for k in a.keys() | b.keys()))
    monkeypatch.undo()
    same = contract.row_set_difference(spark.createDataFrame(base, schema), spark.createDataFrame(base[::-1], schema))
    assert "Exchange" not in same._jdf.queryExecution().executedPlan().toString()
