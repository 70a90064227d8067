import collections
import math
import random
import re

import numpy as np
import pytest
from brute import rows
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import importance, topk
from ledgerloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    from oracle_check import connect

    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    from oracle_check import compare

    assert compare(spark, duck, SF, QUERIES[name], ORACLES[name])[0] is None


# ---------------------------------------------------------------- search

def best(vectors, is_query, k):
    out = []
    for i, q in vectors:
        if not is_query(i):
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in vectors if j != i and len(v) == len(q))
        out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def test_top_k_of_odd_vectors(spark):
    rng = random.Random(5)
    data = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(120)]
    data += [(200 + i, [0.5, 0.25, -0.125, 0.0, 1.0, 0.75]) for i in range(30)]  # a large group of equal vectors
    data += [(300 + i, [float(rng.randrange(-2, 3)) for _ in range(6)]) for i in range(60)]  # many ties
    data += [(400, [1.0, 2.0]), (401, [0.5, 0.5]), (402, [3.0])]
    sound = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in data]
    odd = [(500, None), (501, []), (510, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (520, [float("nan")] * 6), (530, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 0) for i, v in data + odd], "vec_id long, embedding array<double>, rank int")
    got = sorted(map(tuple, topk.top_k(df, df["vec_id"] % 10 == 0).collect()))
    assert got == best(sound, lambda i: i % 10 == 0, 5)


def test_scores_beyond_doubles_are_exact(spark):
    data = [(i, [float(2**40 + i), 3.0 * i, float(-(2**38))]) for i in range(12)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    want = best([(i, [256 * int(x) for x in v]) for i, v in data], lambda i: i % 5 == 0, 3)
    clipped = [(q, r, j, max(-(2**63), min(2**63 - 1, s))) for q, r, j, s in want]
    got = sorted(map(tuple, topk.top_k(df, df["vec_id"] % 5 == 0, k=3).collect()))
    assert [g[3] for g in got] == [c[3] for c in clipped]


def test_queries_are_sent_in_waves_and_listed_once_a_task(spark, monkeypatch):
    """Of many small blocks: several waves, and no list for each pair of blocks."""
    for name, size in (("CANDIDATES", 8), ("QUERIES", 4), ("WAVE", 200)):
        monkeypatch.setattr(topk, name, size, raising=False)
    found = {}
    whole = topk.scratch_path
    monkeypatch.setattr(topk, "scratch_path", lambda s, label: found.setdefault(label, whole(s, label)))
    rng = random.Random(7)
    data = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(300)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, df["vec_id"] % 10 == 0).collect()))
    assert got == best([(i, [int(np.floor(256 * x)) for x in v]) for i, v in data], lambda i: i % 10 == 0, 5)
    lists = spark.read.parquet(found["local-lists"])
    assert lists.select("wave").distinct().count() > 1
    tasks = lists.select(F.input_file_name()).distinct().count()
    assert lists.count() <= 30 * tasks and lists.agg(F.max(F.size("x"))).first()[0] <= 6


def test_search_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, df["vec_id"] % 5 == 0).count() == 0


# ---------------------------------------------------------------- quality

def test_quality_holds_out(spark):
    """Documents without a label, judged by labels they were not trained on."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = {r["doc_id"]: r["quality"] == 1 and r["toxic"] == 0 for r in labels.collect() if r["doc_id"] % 4 == 0}
    out = importance.resample(docs, labels.filter("doc_id % 4 <> 0")).select("doc_id", "kept").collect()
    good = [r["kept"] for r in out if held.get(r["doc_id"])]
    bad = [r["kept"] for r in out if held.get(r["doc_id"]) is False]
    assert sum(good) >= 0.95 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_models_count_all_documents(spark):
    """Weights, cutoff and the drawn documents, as a plain version over all texts gives them."""
    docs = spark.read.parquet(f"/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"/root/testdata/sf0.01/labels.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    sample = [r for r in labels.select("doc_id", "quality", "toxic", F.expr("pmod(xxhash64(doc_id, 11), 5) = 0").alias("held")).collect()
              if None not in r and r["doc_id"] in texts]
    good = {r["doc_id"]: r["quality"] > 0 and r["toxic"] == 0 for r in sample}
    held = {r["doc_id"] for r in sample if r["held"]}

    def ratios(raw, target):
        out = {}
        for part in ("w", "p"):
            size = [sum(n for (kind, _), n in c.items() if kind == part) for c in (raw, target)]
            for at in (k for k in raw if k[0] == part):
                out[at] = math.log((target[at] + 0.5) / (raw[at] * size[1] / max(1, size[0]) + 0.5))
        return out

    def grams(text):
        words, pairs = importance.buckets(text)
        return [("w", b) for b in words.tolist()], [("p", b) for b in pairs.tolist()]

    def weight(text, ratio):
        words, pairs = ([ratio.get(g, 0.0) for g in gs] for gs in grams(text))
        n = min(importance.WINDOW, len(words))
        worst = min((sum(words[k:k + n]) for k in range(len(words) - n + 1)), default=0.0)
        return min(worst, sum(words) + importance.PAIR_SHARE * sum(pairs))

    def model(of, is_good):
        raw, target = collections.Counter(), collections.Counter()
        for d in of:
            found = [g for gs in grams(texts[d]) for g in gs]
            raw.update(found)
            target.update(found if is_good(d) else [])
        ratio = ratios(raw, target)
        fit = sorted(held)
        cut = importance.best_cutoff(np.array([weight(texts[d], ratio) for d in fit]), np.array([good[d] for d in fit]))
        return ratio, cut

    first, cut = model(set(good) - held, good.get)
    ratio, cut = model(texts, lambda d: good[d] if d in good and d not in held else weight(texts[d], first) >= cut)
    want = {d: weight(t, ratio) for d, t in texts.items()}
    got = {r["doc_id"]: r for r in importance.score(docs, importance.train(docs, labels)).collect()}
    assert set(got) == set(want) and all(abs(got[d]["log_weight"] - w) < 1e-2 for d, w in want.items())
    k = sum(w >= cut for w in want.values())
    drawn = sorted(got, key=lambda d: -got[d]["key"])[:k]
    assert 0 < k < len(want)
    assert {r["doc_id"] for r in importance.resample(docs, labels).filter("kept").collect()} == set(drawn)


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 0.5), (2, "", 0.5), (None, "a b", 0.5), (3, "a b", 0.5), (3, "a b", 0.5), (4, "x" * 50_000, 0.5)],
                                 "doc_id long, text string, log_weight double")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["kept"] for r in importance.resample(docs, none).collect()] == [True] * 6
    odd = spark.createDataFrame([(1, None, 0), (None, 1, 0), (3, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    assert importance.resample(docs, odd).count() == 6
    assert importance.resample(docs.limit(0), odd).count() == 0


def test_kth_largest_is_exact(spark, monkeypatch):
    monkeypatch.setattr(importance, "BINS", 7)
    rng = random.Random(1)
    values = [rng.choice([rng.gauss(0, 1), 2.0, -1e6, 1e-9]) for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 150, 299, 300):
        assert importance.kth_largest(df, "v", k) == sorted(values)[-k]


def test_weights_are_the_worst_passage_or_the_whole():
    ratios = np.zeros(2 << importance.BITS, np.float32)
    words, pairs = importance.buckets("bad good same same !!")
    assert pairs[2] == 1 << importance.BITS and len(words) == 5
    ratios[words[0]], ratios[words[1]] = -3.0, 1.0
    model = importance.Model(ratios, 0.0)
    assert model.weight("") == 0.0 and model.weight("bad") == -3.0
    assert model.weight("good " * 200 + "bad " + "good " * 200) == importance.WINDOW - 1 - 3.0


# ---------------------------------------------------------------- the pipeline

def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(150)
    text = " ".join(f"plain{i} words" for i in range(40))
    more = spark.createDataFrame([(90_001, text, "en", "s", 1), (90_002, text + " end", "en", "s", 1), (90_003, "the password=abcdef99 is out", "en", "s", 1),
                                  (90_004, None, None, None, None), (90_005, "", "en", "s", 0)], docs.schema)
    docs = docs.unionByName(more).withColumn("kept", docs["doc_id"])
    held, before = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF)
        assert after.columns == corpus_pipeline.COLUMNS
        after.write.parquet(path := corpus_pipeline.stored(after, name).inputFiles()[0].rsplit("/", 1)[0] + "-again")
        before = spark.read.parquet(path)
        held[name] = {r["doc_id"]: r["text"] for r in before.collect()}
    assert 90_001 in held["near_duplicates"] and 90_002 not in held["near_duplicates"]
    assert {90_004, 90_005} <= set(held["secrets"])
    if 90_003 in held["secrets"]:
        assert held["secrets"][90_003] == "the [SECRET] is out"
    kept = {d: (t or "").encode() for d, t in held["near_duplicates"].items()}
    for d, t in held["repeats"].items():
        assert len((t or "").encode()) <= len(kept[d])
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == set(held["secrets"])


def test_the_whole_pipeline(spark):
    pieces = corpus_pipeline.run(spark, SF)
    total = {}
    for r in pieces.select("sequence_id", "length", "offset").collect():
        total[r["sequence_id"]] = total.get(r["sequence_id"], 0) + r["length"]
    assert total and max(total.values()) <= 2048
    assert set(corpus_pipeline.ORACLE_SQL or []) == set() and re.match("quality", corpus_pipeline.STAGES[0][0])
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} <= {r["doc_id"] for r in rows(spark, SF, "documents")}
