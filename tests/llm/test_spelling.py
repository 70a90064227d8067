import collections
import random
import re
import zlib

import numpy as np
import pytest
from brute import rows

from ledgerloom.llm import spelling
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(docs, letters=5, least=3):
    counts = collections.Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= letters and c >= least}
    shorter = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add((w, i))
    near = {w: set() for w in n}
    for s, longer in shorter.items():
        for w, i in longer:
            if s in n:
                near[w].add(s)
                near[s].add(w)
            near[w] |= {v for v, j in longer if i == j and v != w}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def answers(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


def test_op11_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in rows(spark, SF, "documents")]
    got = answers(QUERIES["op11_spelling"](spark, SF))
    assert got == brute(docs)
    assert sum(r[1] is not None for r in got) > 20


def odd_documents(seed=5, words=900):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abéÿÀxyz") for _ in range(rng.randrange(3, 9))) for _ in range(words)]
    anagrams = ["".join(rng.sample("abcdefgh", 8)) for _ in range(300)]  # many words of one count vector
    vocabulary += anagrams + [w[:3] + w[4:] for w in anagrams] + ["x" * 3000, "x" * 3001, "x" * 2999 + "y", "×÷×÷×", "×÷×÷÷"]
    docs = [(i, " ".join(rng.choice(" ;-1").join([w.upper() if rng.random() < 0.2 else w]) for w in rng.choices(vocabulary, k=200))) for i in range(40)]
    return docs + [(100, " ".join(vocabulary * 3)), (None, " ".join(vocabulary)), (7, ""), (8, None), docs[3], docs[3], (3, docs[4][1])]


@pytest.mark.parametrize("limit", [20_000, 40])
def test_odd_words_in_any_tiles(spark, limit):
    """Nulls, repeated rows and ids, very long runs, ties, anagrams; with subtrees cut into many tiles."""
    docs = odd_documents()
    df = spark.createDataFrame([(d, t, "w", 1) for d, t in docs], "doc_id long, text string, word string, n long")
    assert answers(spelling.variants(df, limit=limit)) == brute(docs)


@pytest.mark.parametrize("leaf", [20_000, 10, 0])
def test_search_finds_all_near_words(monkeypatch, leaf):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    rng = random.Random(2)
    base = ["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(250)]
    words = sorted({*base, *("".join(rng.sample("abcdef", 6)) for _ in range(100))})
    groups = np.zeros(256, np.int64)
    groups[[ord(c) for c in "abcdef"]] = [0, 1, 2, 0, 1, 7]
    found, w = set(), spelling.Words(words, groups)
    every = np.arange(len(words))
    for a, b in spelling.search(w, 0, every, every, np.ones(len(words), bool), np.ones(len(words), bool)):
        low = (w.size[a] < w.size[b]) | (w.size[a] == w.size[b]) & (a < b)
        good = spelling.verified(w, a[low], b[low])
        found |= {(words[i], words[j]) for i, j in zip(a[low][good], b[low][good])}

    def near(x, y):
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y)) == 1
        return len(y) == len(x) + 1 and any(y[:i] + y[i + 1 :] == x for i in range(len(y)))

    assert found == {(x, y) for x in words for y in words if near(x, y) and (len(x) < len(y) or x < y)}


def test_no_words(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(df).collect() == []
