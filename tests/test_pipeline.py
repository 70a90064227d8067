import csv
import hashlib
import json

import pytest
from fixtures import by_key, fields, record
from pyspark.sql import functions as F

from ledgerloom.errors import MissingSource, SnapshotConflict, StageFailed
from ledgerloom.operators.staging import CUSTOMER_SOURCE, ORDER_SOURCE
from ledgerloom.plans.pipeline import Pipeline
from ledgerloom.session import scratch_path
from ledgerloom.sinks.history import RunHistory, run_states, stage_attempts
from ledgerloom.sources.fingerprint import file_fingerprints
from ledgerloom.sources.landing import (
    Source, land, matches_source, read_landed, read_manifest, read_numbered, write_positioned,
)
from ledgerloom.sources.paths import layer_path
from ledgerloom.sources.raw import count_records, read_raw_csv, read_raw_json_array, read_raw_json_lines


def write_csv(path, columns, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(columns)
        writer.writerows(rows)


def order(key, **changes):
    return fields("orders", order_id=key, **{"customer_id": "C1", "product_id": "P1"} | changes)


@pytest.fixture
def sources(tmp_path):
    customers = [{"customer_id": "C1"}, {"customer_id": "C1", "updated_at": "2025-02-01"}, {"customer_id": "C2", "email": ""}]
    products = [{"product_id": "P1"}, {"product_id": "P2", "unit_price": -1}]
    write_csv(tmp_path / "customers.csv", CUSTOMER_SOURCE, [fields("customers", **c) for c in customers])
    (tmp_path / "products.json").write_text(json.dumps([record("products", **p) for p in products]))
    write_csv(tmp_path / "orders.csv", ORDER_SOURCE, [
        order("O1"), order("O2", quantity="0"), order("O3", product_id="P2"), order("O4", customer_id="C9"),
        order("O5", order_timestamp="2025-03-01"), order("O5", order_timestamp="2025-03-01", updated_at="2025-03-02"),
        order("O6", customer_id="C2")])
    return [Source("customers", str(tmp_path / "customers.csv"), "csv"),
            Source("products", str(tmp_path / "products.json"), "json"),
            Source("orders", str(tmp_path / "orders.csv"), "csv")]


def sha(path):
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def test_landing_is_run_scoped_idempotent_and_faithful(spark, sources, tmp_path):
    root = scratch_path(spark, "land")
    manifest = land(spark, root, "run_1", sources)
    assert by_key(manifest, "dataset", "records") == {"customers": 3, "products": 2, "orders": 7}
    assert by_key(manifest, "dataset", "sha256") == {s.dataset: sha(s.path) for s in sources}
    assert land(spark, root, "run_1", sources).count() == 3  # same content: no-op
    land(spark, root, "run_2", sources)
    assert read_landed(spark, root, "run_2", "orders").count() == 7
    with open(sources[2].path, "a") as f:
        f.write(",".join(order("O7")) + "\n")
    with pytest.raises(SnapshotConflict):
        land(spark, root, "run_1", sources)
    current = file_fingerprints(spark, sources[2].path).withColumn("dataset", F.lit("orders"))
    recorded = read_manifest(spark, root, "run_1").where("dataset = 'orders'")
    assert not matches_source(recorded, current).first()["matches_source"]


def test_missing_source_fails_before_anything_is_written(spark, sources, tmp_path):
    root = str(tmp_path / "out")
    bad = [*sources[:2], Source("orders", str(tmp_path / "absent" / "orders.csv"), "csv")]
    with pytest.raises(MissingSource, match="orders.csv"):
        land(spark, root, "run_x", bad)
    assert not (tmp_path / "out").exists()


def test_record_numbers_follow_file_order_over_many_splits(spark, tmp_path):
    lines = [f"{i},{'x' * (i % 50)}" for i in range(1, 5001)]
    (tmp_path / "n.csv").write_text("n,pad\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        path = scratch_path(spark, "numbers")
        write_positioned(read_raw_csv(spark, str(tmp_path / "n.csv")), path)
        got = read_numbered(spark, path)
        assert spark.read.parquet(f"{path}/blocks").count() > 5
        assert got.where(F.col("n").cast("bigint") != F.col("source_record_number")).count() == 0
        assert got.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_keeps_exact_text_and_quoted_newlines(spark, tmp_path):
    (tmp_path / "q.csv").write_bytes(b'a,b\r\n" x ","say ""hi"""\r\n"two\nlines",\r\n')
    raw = read_raw_csv(spark, str(tmp_path / "q.csv"), multi_line=True)
    assert [(r["a"], r["b"]) for r in raw.orderBy("_row").collect()] == [(" x ", 'say "hi"'), ("two\nlines", None)]
    assert count_records(raw).first()["records"] == 2


def test_json_array_and_lines(spark, tmp_path):
    records = [{"a": 1, "b": {"c": "é"}}, {"a": -199.0}, {"a": "x"}]
    (tmp_path / "a.json").write_text(json.dumps(records, indent=2, ensure_ascii=False))
    array = read_raw_json_array(spark, str(tmp_path / "a.json"))
    assert [json.loads(r["record"]) for r in array.orderBy("_row").collect()] == records
    (tmp_path / "a.jsonl").write_text("\n".join(json.dumps(r) for r in records) + "\n\n")
    lines = read_raw_json_lines(spark, str(tmp_path / "a.jsonl"))
    assert [json.loads(r["record"]) for r in lines.orderBy("_row").collect()] == records
    (tmp_path / "o.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="is not one JSON array"):
        read_raw_json_array(spark, str(tmp_path / "o.json")).collect()


def test_run_folders_are_path_safe_and_distinct():
    assert layer_path("/r", "raw", "a/b:1", "orders") == "/r/raw/run-a%2Fb%3A1/orders"
    assert layer_path("/r", "raw", "a_b:1") != layer_path("/r", "raw", "a/b:1")


def test_run_all_twice_then_one_partition(spark, sources):
    pipe = Pipeline(spark, scratch_path(spark, "pipe"), sources)
    first = pipe.run_all("run_a")
    assert by_key(pipe.summary("run_a"), "dataset", "staged") == {"customers": 2, "products": 1, "orders": 5}
    for r in pipe.summary("run_a").collect():
        assert r["raw"] == r["staged"] + r["quarantined"] + r["superseded"]
    assert first["transform"]["layers"] == {"rows_staging": 8, "rows_curated": 3, "rows_quarantined": 4}
    assert (first["load"]["rows_in"], first["load"]["rows_out"]) == (3, 3)
    assert by_key(pipe.quarantine("run_a"), "business_key", "reason_codes") == {
        "P2": "negative_unit_price", "O2": "quantity_out_of_range", "O3": "product_rejected_in_staging",
        "O4": "orphan_customer_id"}
    second = pipe.run_all("run_b")
    assert second["load"]["rows_out"] == 0
    assert {r["pipeline_run_id"] for r in pipe.table.read().collect()} == {"run_a"}
    assert pipe.curated().first()["pipeline_run_id"] == "run_b"  # latest completed run

    loaded = pipe.run_stage("load-partition", "run_b", pipe.load_partition, 2025, 3)
    assert (loaded["rows_in"], loaded["rows_out"]) == (1, 0)
    pipe.run_stage("validate", "run_b", pipe.validate, 2025, 3)
    with pytest.raises(StageFailed, match="come from other runs"):
        pipe.run_stage("load-partition", "run_c", lambda run: __import__(
            "ledgerloom.plans.pipeline", fromlist=["x"]).require_provenance(pipe.curated("run_a"), run))
    states = {r["pipeline_run_id"]: r for r in run_states(pipe.history.events()).collect()}
    assert states["run_b"]["status"] == "SUCCESS" and states["run_b"]["rows_curated"] == 3
    assert states["run_c"]["status"] == "FAILED" and states["run_c"]["last_stage"] == "load-partition"


def test_history_keeps_attempts_and_counts(spark):
    history = RunHistory(spark, scratch_path(spark, "hist"))
    with history.attempt("r", "transform", 1) as outcome:
        outcome |= {"note": "ok", "rows_in": 10, "rows_out": 8, "layers": {"rows_curated": 8}}
    with pytest.raises(StageFailed, match="boom"), history.attempt("r", "load", 1):
        state = run_states(history.events()).first()
        assert (state["status"], state["last_stage"], state["rows_curated"], state["message"]) == (
            "RUNNING", "load", 8, "load: started")
        raise ValueError("boom")
    attempts = {r["stage"]: r for r in stage_attempts(history.events()).collect()}
    assert attempts["transform"]["rows_out"] == 8 and attempts["load"]["status"] == "FAILED"
    assert attempts["load"]["completed_at_utc"] >= attempts["load"]["started_at_utc"]


def test_history_is_read_from_a_bounded_number_of_files(spark):
    history = RunHistory(spark, scratch_path(spark, "hist"), fold=6)
    for i in range(20):
        with history.attempt(f"r{i % 3}", "load", i) as outcome:
            outcome |= {"rows_in": i, "layers": {"rows_curated": i} if i % 4 else {}}
        assert len(history.events().inputFiles()) <= 2 * 6 + 1
    assert history._snapshot() == 6 and min(history._numbers("events") + history._numbers("snapshot")) == 5
    assert sorted((r["attempt"], r["rows_in"], r["status"]) for r in stage_attempts(history.events()).collect()) == [
        (i, i, "SUCCESS") for i in range(20)]
    states = by_key(run_states(history.events()), "pipeline_run_id", "rows_curated")
    assert states == {"r0": 18, "r1": 19, "r2": 17}

    # A snapshot that broke off is none; an event that comes late to a folded folder is seen, and taken in by the next snapshot.
    broken = history._folder("snapshot", 7)
    spark.createDataFrame([], history.events().schema).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(broken)
    assert history._snapshot() == 6 and history.events().count() == 40
    late = history.events().where("attempt = 0").limit(1).withColumn("attempt_id", F.lit("late"))
    late.write.mode("append").parquet(history._folder("events", 6))
    assert history.events().count() == 41
    history.take_snapshot(7)
    assert history._snapshot() == 7 and history.events().count() == 41 and history._numbers("events")[0] == 6


def test_a_failing_snapshot_keeps_the_events(spark, monkeypatch):
    history = RunHistory(spark, scratch_path(spark, "hist"), fold=2)
    monkeypatch.setattr(history, "take_snapshot", lambda number: 1 / 0)
    for i in range(2):
        with history.attempt("r", "load", i):
            pass
    assert history.events().count() == 4
    monkeypatch.undo()
    with history.attempt("r", "load", 2):
        pass
    assert history._snapshot() == 1 and history.events().count() == 6


def test_an_audit_outage_does_not_hide_the_error(spark, monkeypatch):
    history = RunHistory(spark, scratch_path(spark, "hist"))
    history.path = "nosuchfs://nowhere/events"
    with pytest.raises(StageFailed, match="the real one"), history.attempt("r", "load"):
        raise ValueError("the real one")
    with history.attempt("r", "load") as outcome:
        outcome["note"] = "done"


def test_landing_sees_a_source_change_while_it_reads(spark, sources, monkeypatch):
    from ledgerloom.sources import landing

    root, write = scratch_path(spark, "land"), landing.write_positioned

    def slow(raw, path):
        write(raw, path)
        if path.endswith("customers"):
            with open(sources[0].path, "a", newline="") as f:
                f.write(",".join(fields("customers", customer_id="C9")) + "\r\n")

    monkeypatch.setattr(landing, "write_positioned", slow)
    with pytest.raises(SnapshotConflict, match="while"):
        land(spark, root, "run_1", sources)
    with pytest.raises(MissingSource):
        read_landed(spark, root, "run_1", "customers").count()
    monkeypatch.setattr(landing, "write_positioned", write)
    assert by_key(land(spark, root, "run_1", sources), "dataset", "records")["customers"] == 4


def test_malformed_sources_stop_the_scan(spark, tmp_path):
    (tmp_path / "two.json").write_text('[{"a": 1}]\n[{"a": 2}]')
    with pytest.raises(Exception, match="is not one JSON array"):
        read_raw_json_array(spark, str(tmp_path / "two.json")).collect()
    (tmp_path / "long.csv").write_text("a,b\n1,2\n3,4,5\n")
    for multi_line in (False, True):
        with pytest.raises(Exception, match="does not fit its header"):
            read_raw_csv(spark, str(tmp_path / "long.csv"), multi_line=multi_line).collect()
    (tmp_path / "split.csv").write_text('a,b\n1,"two\nlines"\n')
    with pytest.raises(Exception, match="does not fit its header"):
        read_raw_csv(spark, str(tmp_path / "split.csv")).collect()
    whole = read_raw_csv(spark, str(tmp_path / "split.csv"), multi_line=True).collect()
    assert [(r["a"], r["b"]) for r in whole] == [("1", "two\nlines")]
    (tmp_path / "order").mkdir()
    (tmp_path / "order" / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "order" / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_raw_csv(spark, str(tmp_path / "order"), ["a", "b"]).collect()


def test_blank_json_lines_leave_no_gaps(spark, tmp_path):
    (tmp_path / "l").mkdir()
    (tmp_path / "l" / "1.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n\n\n')
    (tmp_path / "l" / "2.jsonl").write_text('\n{"a": 3}\n{"a": 4}\n\n{"a": 5}\n')
    path = scratch_path(spark, "numbers")
    write_positioned(read_raw_json_lines(spark, str(tmp_path / "l")), path)
    got = {json.loads(r["record"])["a"]: r["source_record_number"] for r in read_numbered(spark, path).collect()}
    assert got == {i: i for i in range(1, 6)}


def test_large_prices_are_quarantined_and_the_run_goes_on(spark, sources):
    with open(sources[2].path, "a", newline="") as f:
        for i, price in enumerate(("1e12", "1e17", "1e300", "0.001e310", "999999999999.994")):
            f.write(",".join(order(f"L{i}", unit_price=price, quantity="1")) + "\r\n")
    pipe = Pipeline(spark, scratch_path(spark, "pipe"), sources)
    pipe.run_all("run_a")
    bad = by_key(pipe.quarantine("run_a").where("business_key LIKE 'L%'"), "business_key", "reason_codes")
    assert bad == {k: "invalid_unit_price" for k in ("L0", "L1", "L2", "L3")}
    assert str(pipe.table.read().where("order_id = 'L4'").first()["unit_price"]) == "999999999999.99"
    found = {(r["measure"], r["dataset"]): r["value"] for r in pipe.measures("run_a").where("reason IS NULL").collect()}
    assert found["email_missing", "customers"] == 1 and found["curated_out", "orders"] == 4


def test_rows_are_counted_as_they_are_written(spark, tmp_path):
    from ledgerloom.sinks.metrics import counted_write
    from ledgerloom.sinks.partitions import write_manifest, write_months

    rows = spark.range(5000, numPartitions=7)
    for name, df, want in (("all", rows, (5000, 2500)), ("none", rows.limit(0), (0, 0)), ("shuffled", rows.repartition(3, "id"), (5000, 2500))):
        got = counted_write(df, lambda d, n=name: d.write.parquet(str(tmp_path / n)), even=F.count_if(F.col("id") % 2 == 0))
        assert (got["rows_out"], got["even"]) == want
    months = rows.selectExpr("concat('O', id) AS order_id", "make_timestamp(2025, CAST(id % 3 + 1 AS INT), 1, 0, 0, 0) AS order_timestamp",
                             "concat('run_', id % 2) AS pipeline_run_id")
    path = scratch_path(spark, "months")
    assert write_months(months, f"{path}/rows") == 5000
    manifest = write_manifest(spark, f"{path}/rows", f"{path}/manifest").collect()
    assert len(manifest) == 6 and sum(r["row_count"] for r in manifest) == 5000
    assert {r["partition_key"] for r in manifest} == {f"order_year=2025/order_month={m}" for m in (1, 2, 3)}


def test_the_run_keeps_a_manifest(spark, sources):
    pipe = Pipeline(spark, scratch_path(spark, "run"), sources)
    with pytest.raises(MissingSource):
        pipe.partition_manifest("run_m")
    pipe.extract("run_m")
    done = pipe.transform("run_m")
    held = pipe.partition_manifest("run_m").collect()
    assert {r["pipeline_run_id"] for r in held} == {"run_m"} and sum(r["row_count"] for r in held) == done["rows_out"]
    assert done["rows_out"] == pipe.curated("run_m").count()
    assert done["layers"]["rows_quarantined"] == pipe.quarantine("run_m").count()
