import collections
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from ledgerloom.llm import mixing  # noqa: E402


def documents():
    docs = [(i, f"s{i % 5}", "w " * (1 + i * i % 97)) for i in range(400)]
    docs += [(i, "hot", "a b\tc " * (i % 40)) for i in range(400, 1200)]
    docs += [(5000, "copies", "x y z")] * 500 + [(5001, "copies", "x y z\n\x0bw é é")] * 3
    docs += [(6000, "long", "t " * 30_000), (6001, "long", "t " * 10), (6002, "one", "only one here")]
    return docs + [(1, None, "no source " * 9), (None, None, "null id " * 5), (7, "s1", None), (8, "blank", ""), (9, "", "empty name")]


def frame(spark, docs):
    return spark.createDataFrame([(d, s, t, "n", 1) for d, s, t in docs], "doc_id long, source string, text string, name string, row int")


def in_sql(df):
    con = duckdb.connect()
    con.register("documents", df.select("doc_id", "source", "text").toArrow())
    return con.sql(mixing.sql()).fetchall()


def answers(df):
    return sorted((tuple(r) for r in df.select("doc_id", "size", "source_size", "target", "taken").collect()), key=repr)


@pytest.mark.parametrize("few, bins", [(10_000, 1024), (3, 4)])
def test_mix_matches_sql_and_targets(spark, monkeypatch, few, bins):
    """Nulls, copies, a very long text, clashing columns; and ranges so small that they are narrowed again and again."""
    monkeypatch.setattr(mixing, "FEW", few)
    monkeypatch.setattr(mixing, "BINS", bins)
    df = frame(spark, documents())
    got = answers(mixing.mix(df))
    assert got == sorted(in_sql(df), key=repr)
    if few == 3:
        assert got == answers(mixing.mix(df.repartition(7)))  # another layout, the same mix


def test_targets_and_limits(spark):
    rows = mixing.mix(frame(spark, documents())).collect()
    words, taken, target = collections.Counter(), collections.Counter(), {}
    for r in rows:
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        words[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(words.values()))
    assert all(target[s] <= 2 * words[s] for s in words)
    sizes = collections.defaultdict(list)
    for r in rows:
        sizes[r["source"]].append(r["size"])
    for s in words:
        if s != "long":
            assert abs(taken[s] - target[s]) <= max(5, 0.01 * target[s]), s
    order = sorted(s for s in words if s is not None)
    free = [s for s in order if target[s] < 2 * words[s]]
    levels = {round(target[s] / (5, 2, 1)[order.index(s) % 3], 6) for s in free}
    assert len(levels) <= 1


def test_copies_of_documents(spark):
    df = frame(spark, documents()[:300] + [(7, "s1", "again " * 4)] * 20)
    plan = collections.Counter()
    for r in mixing.mix(df).collect():
        plan[r["doc_id"], r["size"]] += r["copies"]
    made = mixing.copied(df)
    assert made.columns == df.columns
    got = collections.Counter((r["doc_id"], len((r["text"] or "").split())) for r in made.collect())
    assert got == collections.Counter({k: n for k, n in plan.items() if n})


def test_nothing_to_mix(spark):
    assert answers(mixing.mix(frame(spark, []))) == []
    blank = answers(mixing.mix(frame(spark, [(1, "a", None), (2, None, " ")])))
    assert blank == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
