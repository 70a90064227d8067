import random

import pytest
from conftest import NOW, RUN
from fixtures import by_key, iso, raw
from pyspark.sql import functions as F

from ledgerloom.operators import staging

# What is changed in a faultless order, the codes it gets, and the detail.
ORDER_FAULTS = [
    ({"customer_id": "\u00a0"}, "missing_customer_id", "customer_id is blank"),
    ({"product_id": ""}, "missing_product_id", "product_id is blank"),
    ({"order_timestamp": "10.02.2024"}, "invalid_order_timestamp", "order_timestamp='10.02.2024' is missing or not ISO-8601"),
    ({"quantity": "a dozen"}, "invalid_quantity", "quantity='a dozen' is not a whole number"),
    ({"quantity": "2.25"}, "invalid_quantity", "quantity='2.25' is not a whole number"),
    ({"quantity": "-4"}, "quantity_out_of_range", "quantity='-4' outside allowed range 1..20"),
    ({"quantity": "20.5"}, "invalid_quantity;quantity_out_of_range",
     "quantity='20.5' is not a whole number; quantity='20.5' outside allowed range 1..20"),
    ({"unit_price": "-0.01"}, "invalid_unit_price", "unit_price='-0.01' is missing, not numeric, or negative"),
    ({"unit_price": "-inf"}, "invalid_unit_price", "unit_price='-inf' is missing, not numeric, or negative"),
    ({"discount_pct": "1.001"}, "invalid_discount_pct", "discount_pct='1.001' is not a fraction between 0 and 1"),
    ({"discount_pct": "nan"}, "invalid_discount_pct", "discount_pct='nan' is not a fraction between 0 and 1"),
    ({"status": "mislaid"}, "invalid_status", "status='mislaid' is not an allowed status"),
    ({"updated_at": "2024-02-30"}, "invalid_updated_at", "updated_at='2024-02-30' is missing or not ISO-8601"),
    ({"customer_id": "", "quantity": "0", "status": "?"}, "missing_customer_id;quantity_out_of_range;invalid_status",
     "customer_id is blank; quantity='0' outside allowed range 1..20; status='?' is not an allowed status"),
]


def test_each_order_rule_names_its_fault(spark):
    """A file of all faults, one faultless order and one at the edge of every rule."""
    edge = {"order_id": "edge", "quantity": "20.0", "unit_price": "0", "discount_pct": "1", "status": "\tpending ",
            "order_timestamp": "2024-02-10T23:15:00-05:45"}
    faulty = [{**change, "order_id": f"F{i}"} for i, (change, _, _) in enumerate(ORDER_FAULTS)]
    staged, quarantine = staging.stage(raw(spark, "orders", {}, *faulty, edge), staging.orders(), RUN, NOW)
    got = {r["business_key"]: (r["reason_codes"], r["reason_detail"], r["layer"], r["source_record_number"]) for r in quarantine.collect()}
    assert got == {f"F{i}": (code, detail, "staging", i + 2) for i, (_, code, detail) in enumerate(ORDER_FAULTS)}
    rows = {r["order_id"]: r for r in staged.withColumn("at", iso("order_timestamp")).collect()}
    assert set(rows) == {"B-1", "edge"} and dict(staged.dtypes)["quantity"] == "bigint"
    assert (rows["edge"]["quantity"], rows["edge"]["status"], rows["edge"]["at"]) == (20, "PENDING", "2024-02-11T05:00:00")


@pytest.mark.parametrize("seed", range(2))
def test_the_newest_version_alone_is_judged(spark, seed):
    """Random versions of few orders against a plain rule: the latest time wins, then the later record; only it is judged."""
    rng, versions = random.Random(seed), []
    for _ in range(60):
        versions.append({"order_id": rng.choice("pqrst"), "updated_at": f"2024-02-{rng.randint(11, 19)}T00:00:00Z",
                         "quantity": str(rng.choice([0, 1, 2, 21]))})
    staged, quarantine = staging.stage(raw(spark, "orders", *versions), staging.orders(), RUN, NOW)
    newest = {}
    for number, v in enumerate(versions, 1):
        if v["order_id"] not in newest or v["updated_at"] >= newest[v["order_id"]][1]["updated_at"]:
            newest[v["order_id"]] = number, v
    good = {k: n for k, (n, v) in newest.items() if 1 <= int(v["quantity"]) <= 20}
    assert by_key(staged, "order_id", "source_record_number") == good
    assert by_key(quarantine, "business_key", "source_record_number") == {k: n for k, (n, _) in newest.items() if k not in good}
    more = staging.superseded_count(raw(spark, "orders", *versions), staging.orders()).first()["superseded"]
    assert len(good) + quarantine.count() + more == len(versions)


def test_customer_texts_are_cleaned_and_missing_mail_is_marked(spark):
    texts = [("  Bo.Lund@Post.EXAMPLE\t", "NEW\u00a0 delhi", "bo.lund@post.example", "New Delhi"),
             (" ", "o'hara-by  the sea", None, "O'Hara-By The Sea"), ("x@y.example", "", "x@y.example", None)]
    changes = [{"customer_id": f"K{i}", "email": mail, "city": city} for i, (mail, city, _, _) in enumerate(texts)]
    staged, quarantine = staging.stage(raw(spark, "customers", *changes), staging.customers(), RUN, NOW)
    got = {r["customer_id"]: (r["email"], r["city"], r["is_email_missing"], r["pipeline_run_id"]) for r in staged.collect()}
    assert got == {f"K{i}": (mail, city, mail is None, RUN) for i, (_, _, mail, city) in enumerate(texts)}
    assert quarantine.isEmpty()


def test_customer_creation_time_must_be_readable_if_present(spark):
    told = {"none": "", "odd": "in spring", "day": "20190506"}
    changes = [{"customer_id": k, "created_at": v} for k, v in told.items()]
    staged, quarantine = staging.stage(raw(spark, "customers", *changes), staging.customers(), RUN, NOW)
    assert by_key(staged.withColumn("at", iso("created_at")), "customer_id", "at") == {"none": None, "day": "2019-05-06T00:00:00"}
    assert [(r["business_key"], r["reason_codes"], r["reason_detail"]) for r in quarantine.collect()] == [
        ("odd", "invalid_created_at", "created_at='in spring' is not an ISO-8601 timestamp")]


def test_product_records_are_flattened_and_prices_judged(spark):
    prices = {"zero": (0, None), "text": ("7.25", None), "below": (-0.5, ("negative_unit_price", "unit_price=-0.5 is negative")),
              "word": ("gratis", ("invalid_unit_price", "unit_price='gratis' is missing or not numeric")),
              "none": (None, ("invalid_unit_price", "unit_price=None is missing or not numeric"))}
    changes = [{"product_id": k, "unit_price": p} for k, (p, _) in prices.items()]
    loose = {"product_id": "loose", "category": ["Socks"], "active": "perhaps"}
    newer = {"product_id": "zero", "unit_price": 1, "name": " Wool  socks, long ", "updated_at": "2024-01-16"}
    staged, quarantine = staging.stage(raw(spark, "products", *changes, loose, newer), staging.products(), RUN, NOW)
    rows = {r["product_id"]: r for r in staged.collect()}
    assert {k: r["unit_price"] for k, r in rows.items()} == {"zero": 1.0, "text": 7.25, "loose": 19.9}
    assert (rows["text"]["category_name"], rows["text"]["category_department"], rows["text"]["active"]) == ("Socks", "Clothing", True)
    assert (rows["loose"]["category_name"], rows["loose"]["active"]) == (None, None)
    assert rows["zero"]["product_name"].startswith("Wool") and rows["zero"]["source_record_number"] == 7
    rejected = {r["business_key"]: (r["reason_codes"], r["reason_detail"]) for r in quarantine.collect()}
    assert rejected == {k: fault for k, (_, fault) in prices.items() if fault}
    assert '"unit_price": -0.5' in by_key(quarantine, "business_key", "source_record")["below"]


def test_unversionable_records_are_all_kept(spark):
    """Blank keys and unreadable versions never deduplicate one another."""
    no_key, no_time = [{"order_id": k} for k in ("", "\t", "")], [{"updated_at": t} for t in ("", "now", "now")]
    staged, quarantine = staging.stage(raw(spark, "orders", *no_key, *no_time, {}, {}), staging.orders(), RUN, NOW)
    assert by_key(staged, "order_id", "source_record_number") == {"B-1": 8}
    assert by_key(quarantine, "source_record_number", "reason_codes") == {
        i: "missing_order_id" if i < 4 else "invalid_updated_at" for i in range(1, 7)}


def test_classification_is_one_shuffle_with_map_side_limit(spark):
    """A hot key is cut to one row per map task before anything moves."""
    hot = [{"order_id": "HOT", "quantity": str(i % 30)} for i in range(50)]
    classified = staging.classify(raw(spark, "orders", *hot, {}), staging.orders())
    plan = classified._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert classified.count() == 2
    assert classified.where(F.col("order_id") == "HOT").first()["source_record_number"] == 50


def test_superseded_counts_nulls_and_copies(spark):
    from pyspark.sql import functions as F

    from ledgerloom.operators.versions import superseded

    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 2, None), (None, 1, "x"), (None, 1, "x"), ("b", 1, "y")],
                               "k string, v int, w string")
    got = superseded(df, ["k"], [F.col("v").desc(), F.col("w").desc()])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([("a", 1, None), ("a", 2, None), (None, 1, "x")], key=repr)


def test_a_lost_record_is_caught(spark):
    import pytest

    from ledgerloom.errors import ContractViolation
    from ledgerloom.plans.report import reconciliation, require_reconciled

    raw = spark.createDataFrame([("orders", 5)], "dataset string, raw bigint")
    routes = spark.createDataFrame([("orders", "staged", 3)], "dataset string, route string, row_count bigint")
    replaced = spark.createDataFrame([("orders", 1)], "dataset string, superseded bigint")
    with pytest.raises(ContractViolation, match="1 of 5 raw records"):
        require_reconciled(reconciliation(raw, routes, replaced))


def test_exact_median(spark):
    import random
    import statistics

    from ledgerloom.operators.median import exact_median

    rng, data = random.Random(5), []
    for g, n in (("a", 1), ("b", 2), ("c", 999), ("d", 1000), (None, 7)):
        data += [(g, rng.choice([rng.gauss(0, 1), 3.0, 1e9])) for _ in range(n)]
    data += [("c", None), ("e", None)]
    got = {r["g"]: r["median"] for r in exact_median(spark.createDataFrame(data, "g string, v double"), "g", "v").collect()}
    for g in ("a", "b", "c", "d", None):
        assert got[g] == statistics.median([v for k, v in data if k == g and v is not None])
    assert got["e"] is None


def test_median_ranges_are_narrow_despite_outliers(spark):
    """One huge value, or a value that is most of a group, does not bring the rest of the group into one range."""
    import statistics

    from ledgerloom.operators import median

    far = [("a", float(i * 7919 % 100_003)) for i in range(100_000)] + [("a", 1e300), ("a", -1e300), ("a", float("inf"))]
    same = [("b", 5.0)] * 20_000 + [("b", float(i)) for i in range(10_000)]
    df = spark.createDataFrame(far + same, "g string, v double").repartition(4)
    want = {g: statistics.median([v for k, v in far + same if k == g]) for g in "ab"}
    for rounds in (0, 1, 2, 3):
        assert {r["g"]: r["median"] for r in median.exact_median(df, "g", "v", rounds).collect()} == want
    n = {"a": len(far), "b": len(same)}
    ranks = spark.createDataFrame([(g, (k - 1) // 2, k // 2) for g, k in n.items()], "rg string, first bigint, second bigint")
    inside, left = median.narrowed(df, ranks)
    kept = {r["g"]: (r["n"], r["values"]) for r in inside.groupBy("g").agg(F.count("*").alias("n"), F.count_distinct("v").alias("values")).collect()}
    assert kept["a"][0] < 1000 and kept["b"][1] == 1
    assert all(0 <= r["first"] <= r["second"] < kept[r["rg"]][0] for r in left.collect())


def test_a_filter_on_the_route_does_not_judge_twice(spark):
    """The rules stand once in the plan, whatever route is asked for, and in methods small enough to be compiled."""
    spec = staging.orders()
    staged, quarantine = staging.stage(raw(spark, "orders", {}, {"order_id": "b", "quantity": "x"}), spec, RUN, NOW)
    for rows, key in ((staged, "order_id"), (quarantine, "business_key")):
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("THEN invalid_discount_pct") == 1
        assert rows.select(key).count() == 1
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_details_are_not_shuffled_to_count_routes(spark):
    """Only the route is asked for: no reason details go through the shuffle, and raw values go as columns."""
    rows = raw(spark, "orders", {}, {"order_id": "F1", "quantity": "a dozen"}, {"order_id": "", "quantity": "1"})
    routes = staging.classify(rows, staging.orders(), "route")
    plan = routes._jdf.queryExecution().optimizedPlan().toString()
    shuffled = next(x for x in plan.split("Window [", 1)[1].split("\n") if "Project" in x)  # what the window reads
    assert "_raw_quantity" in shuffled and "gate_detail" not in shuffled and "raw#" not in shuffled.replace("_raw#", "")
    whole = staging.classify(rows, staging.orders())
    assert sorted(r["route"] for r in routes.collect()) == sorted(r["route"] for r in whole.collect()) == ["rejected_early", "rejected_late", "staged"]
