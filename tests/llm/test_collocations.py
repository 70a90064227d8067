import collections
import random
import re

import duckdb
import pytest

from ledgerloom.llm import collocations
from ledgerloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(docs, least, first=2000):
    f = collections.Counter()
    for lang, text in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3, 4):
                f.update((lang or "und", *g) for g in zip(*(words[i:] for i in range(k))))
    total = collections.Counter()
    longer = collections.defaultdict(int)
    for g, n in f.items():
        if len(g) == 2:
            total[g[0]] += n
        if len(g) > 2 and n >= least:
            for k in range(2, len(g) - 1):
                for i in range(1, len(g) - k + 1):
                    longer[(g[0], *g[i : i + k])] = max(longer[(g[0], *g[i : i + k])], n)
    rows = collections.defaultdict(list)
    for g, a in f.items():
        if len(g) > 2 and a >= least and 100 * longer[g] < 80 * a:
            score, k, l, r = min((2000000 * a // (f[g[: k + 1]] + f[(g[0], *g[k + 1 :])]), k, f[g[: k + 1]], f[(g[0], *g[k + 1 :])])
                                 for k in range(1, len(g) - 1))
            rows[g[0]].append((-score, -a, " ".join(g[1:]).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in rows.items()
                  for i, (s, a, p, l, r) in enumerate(sorted(found)[:first]))


def answers(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()))


def test_op13_matches_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({ORACLES['op13_collocations']})").fetchall()
    got = answers(QUERIES["op13_collocations"](spark, SF))
    assert got == sorted(want) and len(got) > 20


def odd_documents():
    rng = random.Random(4)
    words = ["a", "B", "the", "é", "x\x00y", "don't", " ", "w\xa0w", "Ä", "日本"]
    docs = [(rng.choice(["en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ", ", ".\r\n", "\x0b", "!?"])
             for _ in range(rng.randrange(60)))) for _ in range(120)]
    boiler = "all rights reserved by the owner of this very long notice and nobody else at all"
    circle = "row row your boat " * 30
    return docs + [("en", boiler + end) for end in (" x", " y", ". z", "") * 4] + [("en", circle), ("en", ""), ("en", None), (None, None)] + docs[:5] * 2


@pytest.mark.parametrize("shard, least", [(400_000, 3), (40, 2), (3, 5)])
def test_odd_texts(spark, monkeypatch, shard, least):
    """Nulls, tabs and other blanks, repeats, boilerplate, circles; with buckets that are spread over many shards."""
    monkeypatch.setattr(collocations, "SHARD", shard)
    docs = odd_documents()
    df = spark.createDataFrame([(i, lang, t, 1, "x") for i, (lang, t) in enumerate(docs)], "doc_id long, lang string, text string, n int, word string")
    assert answers(collocations.collocations(df, least=least)) == brute(docs, least)
    if least == 2:
        assert answers(collocations.collocations(df, least=least, first=7)) == brute(docs, least, 7)


def test_paths_are_compacted(spark):
    grams = [([1, 2, 3, 4], 9), ([2, 3, 4, 5], 9), ([3, 4, 5, 6], 9), ([4, 5, 6, 7], 4), ([4, 5, 6, 8], 5),  # forks behind 4 5 6
             ([10, 11, 12, 10], 3), ([11, 12, 10, 11], 3), ([12, 10, 11, 12], 3), ([7, 7, 7, 7], 2), ([1, 2], 50)]
    got = {tuple(r["g"]): r["n"] for r in collocations.compacted(spark.createDataFrame(grams, "g array<long>, n long")).collect()}
    assert got == {(1, 2, 3, 4, 5, 6): 9, (4, 5, 6, 7): 4, (4, 5, 6, 8): 5, (7, 7, 7, 7): 2,
                   (10, 11, 12, 10): 3, (11, 12, 10, 11): 3, (12, 10, 11, 12): 3}


def test_long_text_is_read_in_stretches():
    reader = collocations.Reader()
    reader.read("en", b"a b c. " * 400_000 + b"end" * 1000)
    assert len(reader.ids) == 4 * 400_000 + 2 and reader.ids.count(0) == 400_001


def test_no_phrases(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert collocations.collocations(df).collect() == []
