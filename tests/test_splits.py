import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.landing import read_numbered, write_positioned
from ledgerloom.sources.raw import read_quoted_csv, read_raw_csv, read_raw_json_array


@pytest.fixture
def tiny_splits(spark):
    """Input splits of a few hundred bytes, so that records and quotes run over their edges."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(n) for n in names]
    yield lambda size: [spark.conf.set(n, v) for n, v in zip(names, (str(size), "1"))]
    for n, v in zip(names, old):
        spark.conf.set(n, v)


def csv_text(rng, rows, end):
    def field():
        kind = rng.randrange(7)
        if kind == 0:
            return ""
        if kind == 1:
            return '"' + rng.choice(['line one{e}line two', '{e}', 'a ""word"", b', '{e}{e}"", ""{e}', '', 'long ' * 90, ',,{e}"",""']).replace("{e}", end) + '"'
        return rng.choice(["plain", "é 日本", " blank ", "x y", "7"])

    lines = ["id,one,two,three"]
    for i in range(rows):
        lines.append(f"{i}," + ",".join(field() for _ in range(rng.choice([3, 3, 3, 3, 2]))))
        if rng.random() < 0.05:
            lines.append("")
    return lines


@pytest.mark.parametrize("size", [64, 2048])
def test_quoted_csv_reads_alike_in_many_tasks(spark, tmp_path, tiny_splits, size):
    rng = random.Random(size)
    for n, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        text = end.join(csv_text(rng, 120, end)) + (end if n != "c" else "")
        (tmp_path / f"{n}.csv").write_bytes(text.encode())
    plain = []
    for n in "abc":
        with open(tmp_path / f"{n}.csv", newline="") as file:
            plain += [tuple([*r, ""][:4]) for r in csv.reader(file) if r and r[0] != "id"]
    whole = [r for n in "ac" for r in read_raw_csv(spark, str(tmp_path / f"{n}.csv"), multi_line=True).drop("_file", "_block", "_row").collect()]
    tiny_splits(size)
    raw = read_quoted_csv(spark, str(tmp_path))
    assert raw.select("_file", "_block").distinct().count() > (3 if size > 1000 else 30)
    write_positioned(raw, str(tmp_path / "landed"))
    got = read_numbered(spark, str(tmp_path / "landed")).orderBy("source_record_number").collect()
    assert [r["source_record_number"] for r in got] == list(range(1, len(plain) + 1))
    assert [tuple(v or "" for v in tuple(r)[:4]) for r in got] == plain
    assert [tuple(r)[:4] for r in got if not 120 < r["source_record_number"] <= 240] == [tuple(r) for r in whole]


def test_broken_csv_stops(spark, tmp_path, tiny_splits):
    tiny_splits(40)
    cases = {"open": ('a,b\n1,"never closed\n2,x\n' + "3,y\n" * 30, "ends inside"), "long": ("a,b\n" + "1,2\n" * 30 + "1,2,3\n", "does not fit"),
             "header": ("a,c\n1,2\n", "(?i)header")}
    for name, (text, message) in cases.items():
        (tmp_path / f"{name}.csv").write_text(text)
        with pytest.raises(Exception, match=message):
            read_quoted_csv(spark, str(tmp_path / f"{name}.csv"), ["a", "b"]).collect()
        with pytest.raises(Exception, match=message):
            read_quoted_csv(spark, str(tmp_path / f"{name}.csv"), ["a", "b"]).agg(F.count("*")).collect()


def json_items(rng, n):
    def value(depth):
        kind = rng.randrange(8 if depth < 3 else 5)
        if kind < 2:
            return rng.choice(['quote " and \\', "a, b]} [{", "", "é\n", 'end\\\\"', "x" * 300, "\\"])
        if kind < 5:
            return rng.choice([1, -2.5, True, False, "plain"])
        if kind < 7:
            return {f"k{i},": value(depth + 1) for i in range(rng.randrange(4))}
        return [value(depth + 1) for _ in range(rng.randrange(4))]

    return [{"id": i, "v": value(0)} for i in range(n)]


@pytest.mark.parametrize("size", [200, 2000])
def test_json_array_reads_alike_in_many_tasks(spark, tmp_path, tiny_splits, size):
    rng = random.Random(size)
    items = json_items(rng, 150)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(items[:60], indent=2, ensure_ascii=False))
    (folder / "b.json").write_text(" \n" + json.dumps(items[60:149]) + "\n ")
    (folder / "c.json").write_text("[ ]")
    (folder / "d.json").write_text(json.dumps(items[149:]))
    tiny_splits(size)
    raw = read_raw_json_array(spark, str(folder))
    assert raw.select("_file", "_block").distinct().count() > (3 if size > 1000 else 20)
    write_positioned(raw, str(tmp_path / "landed"))
    got = read_numbered(spark, str(tmp_path / "landed")).orderBy("source_record_number").collect()
    assert [json.loads(r["record"]) for r in got] == items
    assert [r["source_record_number"] for r in got] == list(range(1, 151))


@pytest.mark.parametrize("text", [" ", "{}", "[1,2", "[1,2] 3", "[1],[2]", "[1,,2]", "[1,]", '["open]', '[{"a":1}{"b":2}]', "[{]}", "1,2]", "[]]"])
def test_what_is_not_one_array_stops(spark, tmp_path, tiny_splits, text):
    tiny_splits(4)
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(Exception, match="is not one JSON array"):
        read_raw_json_array(spark, str(tmp_path / "x.json")).agg(F.count("*")).collect()


def test_arrays_of_one_split_are_cut_once(spark, tmp_path):
    """Files that are not cut by a split need no second look for records across edges, and a value is parsed once."""
    for i, text in enumerate(['[{"a": 1}, {"b": "x, y"}]', "[ 7 ]", ""]):
        (tmp_path / f"f{i}.json").write_text(text)
    rows = read_raw_json_array(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and plan.count("from_json") == 1
    assert sorted(r["record"] for r in rows.collect()) == ["7", '{"a":1}', '{"b":"x, y"}']
