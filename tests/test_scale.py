"""Plans and results under skew: one key or month holding a third of the rows and more."""

import pytest
from pyspark.sql import functions as F

from conftest import NOW, RUN
from ledgerloom.functions.hashing import packed_hash
from ledgerloom.operators import contract, curate
from ledgerloom.operators.merge import batch_actions, merged_rows
from ledgerloom.operators.staging import ORDER_SOURCE
from ledgerloom.operators.versions import duplicate_keys, duplicate_members, latest_version, superseded
from ledgerloom.plans import rawtext, tables
from ledgerloom.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def change(**settings):
        for key, value in settings.items():
            key = key.replace("__", ".")
            changed.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def skewed(spark, rows=60_000):
    """A third of the rows share one key; every row is distinct."""
    return spark.range(0, rows, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise((F.col("id") / 2).cast("bigint")).alias("k"),
        (F.col("id") * 7919 % rows).alias("v"), F.col("id").alias("n"))


def test_hot_key_dedup_keeps_exactly_the_newest(spark):
    df, order = skewed(spark), [F.col("v").desc(), F.col("n").desc()]
    latest = latest_version(df, ["k"], order)
    assert "WindowGroupLimit" in plan_of(latest)
    expected = df.groupBy("k").agg(F.max_by("n", F.struct("v", "n")).alias("n"))
    assert latest.select("k", "n").exceptAll(expected.select("k", "n")).isEmpty()
    assert latest.count() == expected.count()
    rest = superseded(df, ["k"], order)
    assert rest.count() + latest.count() == df.count()


def test_superseded_rows_of_a_hot_key_spread_over_tasks(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    rest = superseded(skewed(spark), ["k"], [F.col("v").desc(), F.col("n").desc()])
    sizes = [r["c"] for r in rest.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("c")).collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_duplicate_counts_combine_before_the_shuffle(spark):
    df = skewed(spark)
    plan = plan_of(duplicate_keys(df, ["k"]))
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
    hot = duplicate_members(df, ["k"]).where("k = -1")
    assert hot.count() == 20_000 and hot.select("versions").distinct().first()[0] == 20_000


def test_hot_reference_is_split_by_the_skew_join(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__shuffle__partitions="16",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="64k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2")
    n = 120_000
    orders = spark.range(0, n, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
        F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, "GONE").otherwise(F.col("id").cast("string"))
        .alias("customer_id"),
        F.concat(F.lit("P"), F.col("id") % 50).alias("product_id"), F.lit(1).cast("bigint").alias("quantity"), F.lit(2.0).alias("unit_price"),
        F.lit(0.0).alias("discount_pct"), F.lit("PAID").alias("status"),
        F.lit(NOW).cast("timestamp").alias("order_timestamp"), F.lit(NOW).cast("timestamp").alias("updated_at"))
    customers = spark.range(0, n, 1, 4).select(
        F.when(F.col("id") == 0, "HOT").otherwise(F.col("id").cast("string")).alias("customer_id"),
        F.lit("c").alias("customer_city"), F.lit("t").alias("customer_tier"))
    products = spark.createDataFrame([(f"P{i}", "n", "c", "b") for i in range(50)],
                                     "product_id string, product_name string, category string, brand string")
    joined = curate.join_references(orders, customers, products)
    result = joined.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.count("customer_city").alias("c"),
                                          F.max("order_id"), F.max("reason_detail"))
    assert {r["route"]: (r["n"], r["c"]) for r in result.collect()} == {
        "curated": (2 * n // 3, 2 * n // 3), "orphan": (n // 3, 0)}
    assert "skew=true" in result._jdf.queryExecution().executedPlan().toString()


def test_contract_counts_do_not_gather_rows(spark):
    """Everything but the key count is one aggregate whose partial result is one row per task."""
    plan = plan_of(contract.violation_counts(tables.unchecked_lines(spark, SF), tables.LIMITS))
    assert "Window" not in plan and "collect" not in plan


def test_hot_duplicate_counts_and_samples(spark):
    rows = tables.unchecked_lines(spark, SF)
    one = rows.limit(1)
    copies = one.crossJoin(F.broadcast(spark.range(5000))).drop("id").select(rows.columns)
    got = contract.contract_violations(copies, tables.LIMITS).where(F.col("message") == contract.DUPLICATED).first()
    key = one.first()["order_id"]
    assert (got["bad_rows"], got["sample"]) == (5000, ", ".join([key] * 5))


def test_filters_and_columns_reach_the_scan(spark):
    lines = tables.table(spark, SF, "lineitem")
    plan = plan_of(QUERIES["month_range_scan"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int" not in plan or "l_tax" not in plan
    assert "l_tax" not in plan and "l_suppkey" not in plan and lines.columns
    pruned = plan_of(QUERIES["month_partition_scan"](spark, SF))
    assert "PartitionFilters: [isnotnull(order_year" in pruned


LAZY = ["latest_version_dedup", "order_lines_curated", "orphan_classification", "contract_check_counts",
        "upsert_actions", "upsert_result", "row_set_equality", "run_state_log", "normalized_documents",
        "title_cased_parts", "superseded_versions", "record_hashes", "differing_order_ids"]


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python_in_the_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas"):
        assert node not in plan


def test_small_batch_does_not_shuffle_the_table(spark):
    stored = spark.range(100_000).select(F.col("id").cast("string").alias("order_id"),
                                         F.sha2(F.col("id").cast("string"), 256).alias("record_hash"))
    batch = stored.where("order_id = '7'").withColumn("record_hash", F.lit("x"))
    small = spark.createDataFrame(batch.collect(), batch.schema)
    touched = stored.join(small.select("order_id"), "order_id", "left_semi")
    acted = batch_actions(small, touched)
    assert acted.first()["action"] == "update"
    assert "BroadcastHashJoin" in plan_of(acted) and RUN


def test_raw_orders_are_sorted_before_they_are_spelled_out(spark):
    rows = rawtext.ordered_orders(spark, SF)
    sorted_rows = plan_of(rows).split("rangepartitioning")[1]
    assert "o_custkey" in sorted_rows and "order_timestamp" not in sorted_rows
    columns = [*tables.LINE_COLUMNS, *ORDER_SOURCE]
    plain = rawtext.raw_text(spark, SF, "orders").select(columns)
    assert rows.select(columns).exceptAll(plain).isEmpty() and rows.count() == plain.count()
    met = [tuple(r) for r in rows.select(*tables.LINE_COLUMNS).collect()]
    assert met == sorted(met)


def test_merged_rows_shuffle_only_what_is_read(spark):
    batch, target = tables.curated_lines(spark, SF), tables.previous_lines(spark, SF)
    merged = merged_rows(batch, target)
    assert merged.columns == target.columns
    plan = merged.select("order_id", "order_timestamp", "pipeline_run_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "_old_order_timestamp" in plan and "_old_product_name" not in plan and "_new_category" not in plan


def test_json_lines_of_a_scan_are_compressed(spark):
    rows = QUERIES["json_lines_scan"](spark, SF)
    assert rows.count() == QUERIES["typed_csv_scan"](spark, SF).count() > 0
    assert all(name.endswith(".json.gz") for name in rows.inputFiles())


def test_versions_and_orders_of_a_line_meet_in_one_shuffle(spark, conf, tmp_path):
    """Joined by shuffle, the lines are dealt by order once; each row of a repeated order keeps the latest version of its lines."""
    lines = [(1, 1, 1, "a"), (1, 1, 2, "b"), (1, 1, 2, "b"), (2, 1, 3, "c"), (2, 1, 1, "d"), (None, 1, 1, "e"), (None, 1, 4, "f"), (9, None, 5, "g")]
    spark.createDataFrame(lines, "o long, n long, d int, f string").select(
        F.col("o").alias("l_orderkey"), F.col("n").alias("l_linenumber"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, d)").alias("l_shipdate"),
        F.lit(7).cast("long").alias("l_partkey"), F.lit(8).cast("long").alias("l_suppkey"),
        *[F.col("d").cast("double").alias(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")],
        F.col("f").alias("l_returnflag"), F.col("f").alias("l_linestatus")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 10), (2, 20), (2, 21), (None, 30)], "o_orderkey long, o_custkey long").selectExpr(
        "*", "timestamp_ntz'2019-01-01' AS o_orderdate", "'1-urgent' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    judged = tables.judged_lines(spark, str(tmp_path))
    assert plan_of(judged).count("Exchange hashpartitioning") == 2  # lines and orders
    got = [tuple(r) for r in judged.select("order_id", "customer_id", "quantity").collect()]
    assert sorted(got, key=repr) == sorted([("1-1", 10, 2.0), ("2-1", 20, 3.0), ("2-1", 21, 3.0), ("1", None, 4.0), ("9", None, 5.0)], key=repr)


def test_unequal_row_sets_are_shuffled_once(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    one, two = (spark.range(5000).select(F.concat(F.lit("l-"), "id").alias("order_id"), F.sha2(F.concat("id", F.lit(x)), 256).alias("record_hash"))
                for x in "ab")
    found = contract.row_set_difference(one, two)
    assert plan_of(found).count("Exchange hashpartitioning") == 1
    assert tuple(found.first()) == (5000, 5000, 10000)


def test_packed_hashes_tell_texts_apart(spark):
    texts = [None, "", "a" * 64, "A" * 64, "a" * 64 + "\n", "a" * 63, "0" * 64, "\x01" + "a" * 32, "zz"]
    packed = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "record_hash string").select(packed_hash()).collect()]
    assert len(set(packed)) == len(texts) and packed[0] is None and len(packed[2]) == 33


def test_both_sides_of_a_merge_are_joined_once(spark, conf, tmp_path):
    """Rows with nulls and copies give the same frames as each built alone, and what both sides join is shuffled once."""
    lines = [(1, 1, 1, "a"), (1, 1, 2, "b"), (1, 1, 2, "b"), (2, 1, 3, "c"), (2, 1, None, "d"), (2, 2, 5, "h"), (2, 2, 5, "h"), (None, 1, 1, "e"),
             (None, 1, 4, "f"), (9, None, 5, "g"), (3, 1, 6, None), (3, 1, 6, "k")]
    spark.createDataFrame(lines, "o long, n long, d int, f string").select(
        F.col("o").alias("l_orderkey"), F.col("n").alias("l_linenumber"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, d)").alias("l_shipdate"),
        F.lit(7).cast("long").alias("l_partkey"), F.lit(8).cast("long").alias("l_suppkey"), F.col("d").cast("double").alias("l_quantity"),
        F.col("d").cast("double").alias("l_extendedprice"), *[F.lit(0.05).alias(c) for c in ("l_discount", "l_tax")],
        F.col("f").alias("l_returnflag"), F.col("f").alias("l_linestatus")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 10), (2, 10), (2, 11), (3, 10), (None, 10)], "o_orderkey long, o_custkey long").selectExpr(
        "*", "timestamp_ntz'2019-01-01' AS o_orderdate", "'1-urgent' AS o_orderpriority").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql("SELECT c AS c_custkey, 1D AS c_acctbal, 2L AS c_nationkey, 'X' AS c_mktsegment FROM VALUES (10L), (11L) t(c)").write.parquet(f"{tmp_path}/customer.parquet")
    spark.sql("SELECT 7L AS p_partkey, 3 AS p_size, 'n' AS p_name, 't' AS p_type, 'b' AS p_brand").write.parquet(f"{tmp_path}/part.parquet")
    sf = str(tmp_path)
    both = tables.curated_and_previous(spark, sf)
    for got, want in zip(both, (tables.curated_lines(spark, sf), tables.previous_lines(spark, sf))):
        assert got.columns == want.columns and got.count() == want.count() > 3
        assert got.exceptAll(want).isEmpty()
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    plan = plan_of(merged_rows(*tables.curated_and_previous(spark, sf)))
    assert plan.count("- Exchange hashpartitioning(l_orderkey") == 1 and "ReusedExchange" in plan
    alone = plan_of(merged_rows(tables.curated_lines(spark, sf), tables.previous_lines(spark, sf)))
    dealt = [p.count("- Exchange hashpartitioning(") for p in (plan, alone)]
    assert dealt[0] < dealt[1]


def test_merged_rows_shuffle_hashes_as_bytes(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    sides = [spark.createDataFrame(rows, "order_id string, record_hash string, v int") for rows in (
        [("A", "ab" * 32, 1), ("B", "cd" * 32, 1), ("C", None, 1), ("D", "odd", 1)],
        [("A", "ab" * 32, 2), ("B", "CD" * 32, 2), ("C", None, 2), ("E", None, 2)])]
    merged = merged_rows(*sides)
    assert sorted((r["order_id"], r["record_hash"], r["v"]) for r in merged.collect()) == [
        ("A", "ab" * 32, 2), ("B", "cd" * 32, 1), ("C", None, 2), ("D", "odd", 1), ("E", None, 2)]
    below = plan_of(merged).split("Exchange hashpartitioning")[1:]
    assert len(below) == 2 and all("unhex" in side for side in below)


def test_hashes_are_counted_as_bytes(spark, conf):
    from ledgerloom.plans.catalog import _hash_summary

    texts = ["ab" * 32, "ab" * 32, "AB" * 32, "zz", "", None, None]
    df = spark.createDataFrame([(t,) for t in texts], "record_hash string")
    want = df.agg(F.count(F.lit(1)).alias("row_count"), F.count_distinct("record_hash").alias("hashes"), F.min("record_hash").alias("first_hash"))
    assert _hash_summary(df).columns == want.columns
    assert _hash_summary(df).first() == want.first() and _hash_summary(df.limit(0)).first() == want.first().__class__(0, 0, None)
    conf(spark__sql__adaptive__enabled="false")
    shuffled = plan_of(_hash_summary(df)).split("Exchange hashpartitioning")[1]
    assert "unhex" in shuffled and "min" not in shuffled
