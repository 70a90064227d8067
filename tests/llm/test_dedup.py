import random

import numpy as np
import pytest
from brute import groups, repeats, rows, sha

from ledgerloom.llm import components, ngram_join, suffix_dedup
from ledgerloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_op2_matches_brute_force(spark):
    docs = [(r["doc_id"], (r["text"] or "").encode()) for r in rows(spark, SF, "documents")]
    want = sorted((d, n, gone, spans, sha(kept)) for d, n, gone, spans, kept in repeats(docs))
    assert sorted(map(tuple, QUERIES["op2_suffix_dedup"](spark, SF).collect())) == want


def odd_documents():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcde é") for _ in range(130))
    docs = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(90))) + passage[rng.randrange(60):]
             + "".join(rng.choice("xyz") for _ in range(rng.randrange(40)))) for i in range(40)]
    docs += [(40, "a" * 500), (41, "a" * 300 + "b"), (42, "ab" * 400), (43, "ba" * 60), (44, ""), (45, None), (None, passage * 2),
             (2, docs[2][1]), (46, docs[2][1]), (47, docs[3][1][-49:]), (48, docs[3][1][-50:]), (49, "\0" * 120), (50, "\0" * 60)]
    return docs


@pytest.mark.parametrize("shard", [3 << 20, 600])
def test_repeats_of_odd_documents(spark, monkeypatch, shard):
    """Runs of one byte, nulls, equal rows, repeated ids; and shards of several suffix arrays."""
    monkeypatch.setattr(suffix_dedup, "SHARD", shard)
    docs = odd_documents()
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, block string")
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in
           suffix_dedup.remove_repeats(df, carry=("block",)).collect()]
    want = repeats([(d, (t or "").encode()) for d, t in docs])
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_shards_of_several_arrays_agree(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    text = rng.choice(np.frombuffer(b"ab", np.uint8), 4000)
    first = np.arange(0, 3900, 40)
    count = np.full(len(first), 11)
    data = suffix_dedup.gather(text, first, count + 49)
    name, doc = np.zeros(len(first), np.uint64), np.arange(len(first)) % 7
    whole = suffix_dedup.shard_answers(name, doc, doc, count, data, 50)
    monkeypatch.setattr(suffix_dedup, "SHARD", 700)
    cut = suffix_dedup.shard_answers(name, doc, doc, count, data, 50)
    assert all((a == b).all() for a, b in zip(whole, cut))


def test_arrays_of_whole_names_agree_with_one_array(monkeypatch):
    """Names in arrays of their own, some of them cut into several, give what one array gives."""
    rng = np.random.default_rng(2)
    text = rng.choice(np.frombuffer(b"ab", np.uint8), 6000)
    first = np.concatenate([np.arange(0, 5900, 40)] * 2)
    count, doc = np.full(len(first), 11), np.arange(len(first)) % 9
    data = suffix_dedup.gather(text, first, count + 49)
    name = np.concatenate([np.where(np.arange(148) < 60, 5, np.arange(148))] * 2).astype(np.uint64)
    whole = suffix_dedup.shard_answers(name, doc, doc, count, data, 50)
    monkeypatch.setattr(suffix_dedup, "PIECE", 900)
    alone = suffix_dedup.shard_answers(name, doc, doc, count, data, 50)
    monkeypatch.setattr(suffix_dedup, "SHARD", 700)
    cut = suffix_dedup.shard_answers(name, doc, doc, count, data, 50)
    assert len(whole[0]) and all((a == b).all() and (a == c).all() for a, b, c in zip(whole, alone, cut))


def test_a_shard_is_answered_in_little_memory():
    """Suffix arrays over 1.5 MB of names that two documents share take less than 50 MB beside what they leave."""
    import tracemalloc

    rng = np.random.default_rng(4)
    count = np.full(16_000, 51)
    own = rng.integers(97, 123, int((count + 49).sum()), np.uint8)
    data, name = np.concatenate([own, own]), np.tile(np.arange(16_000, dtype=np.uint64), 2)
    doc = np.repeat([1, 2], 16_000)
    tracemalloc.start()
    kept, _, windows = suffix_dedup.shard_windows(name, doc, doc, np.tile(count, 2), data, 50)
    left, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(kept) == 32_000 and (windows == 1).all() and most - left < 50e6


def test_a_block_is_cut_into_stretches_in_little_memory():
    """The working arrays of a block of text of 4 MB stay within 40 MB beside what they leave."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(3)
    texts = [rng.integers(97, 123, 4096, np.uint8).tobytes() for _ in range(512)]
    rows = pd.DataFrame({"id": range(1024), "bytes": texts + texts})
    tracemalloc.start()
    block = suffix_dedup.Block(rows, 50)
    block.distinct(np.arange(len(block.name)))
    left, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(block.data) == 4 << 20 and most - left < 40e6
    assert len(block.lead) * 2 == len(block.name)


def test_characters_of_many_documents_stay_apart(spark):
    """A run is cut back to the characters of its own document, whichever stand beside it in a block."""
    shared = "é" * 30 + "x"
    docs = [(k, f"{chr(0x20AC + k)}{shared}{chr(0xE0 + k)}") for k in range(1, 9)] + [(0, shared), (9, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in suffix_dedup.remove_repeats(df, whole_characters=True).collect()}
    assert kept == {0: shared, 9: ""} | {k: f"{chr(0x20AC + k)}{chr(0xE0 + k)}" for k in range(1, 9)}


def test_whole_characters_stay(spark):
    shared = "é" * 40
    df = spark.createDataFrame([(1, "x" + shared), (2, "€" + shared + "ü")], "doc_id long, text string")
    kept = {r["doc_id"]: bytes(r["kept"]).decode() for r in suffix_dedup.remove_repeats(df, whole_characters=True).collect()}
    assert kept == {1: "x" + shared, 2: "€ü"}


def test_repeats_of_an_empty_table(spark):
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_op6_matches_brute_force(spark):
    want = groups([(r["doc_id"], r["text"]) for r in rows(spark, SF, "documents")], 0.9, 3)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op6_ngram_join"](spark, SF).collect()}
    assert got == want


def near_copies():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    docs = []
    for base in range(6):
        text = [rng.choice(words) for _ in range(rng.choice([3, 5, 12, 60, 200]))]
        for _ in range(25):
            copy = list(text)
            for _ in range(rng.randrange(1 + len(copy) // 12)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy[: len(copy) - rng.randrange(1 + len(copy) // 20)]))
    docs += ["", None, " \t", "one", "ONE", "one two", "one two three", "one two  three", docs[0], docs[30]]
    return list(enumerate(docs, 100))


@pytest.mark.parametrize("t,n", [(0.9, 3), (0.8, 5), (0.6, 2)])
def test_groups_of_near_copies(spark, t, n):
    docs = near_copies()
    df = spark.createDataFrame([(d, x, 1, "k") for d, x in docs], "doc_id long, text string, node int, key string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_groups(df, t, n).collect()}
    assert got == groups(docs, t, n)


def test_one_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(30))
    data = [(3, text), (1, text), (1, text), (2, text + " more"), (5, "other words stand here alone now"), (None, text), (None, None), (6, ""), (7, "")]
    kept = ngram_join.one_of_each(spark.createDataFrame(data, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == [1, 5, 6, 7, None, None]
    assert ngram_join.one_of_each(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_allocation_covers_all_differences():
    for t in (0.5, 0.6, 0.8, 0.9, 0.95):
        for top in (1, 2, 5, 17, 100, 3000):
            exact, near = ngram_join.allocation(top, t)
            assert exact + 2 * near > ngram_join.differences(top, top, t)
    assert any(ngram_join.allocation(top, 0.4)[1] for top in (4, 8, 20, 50))  # neighbourhoods where segments are small


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 250)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 130)) and got[300] == 250


def test_parities_tell_sets_just_below_the_threshold_apart():
    """A lower bound of the differences, close enough that templates which are no near duplicates make no pairs."""
    rng = np.random.default_rng(5)
    shared = rng.integers(0, 2**64, 260, np.uint64, endpoint=False)
    sets = [np.unique(np.concatenate([shared, rng.integers(0, 2**64, 40, np.uint64, endpoint=False)])) for _ in range(60)]
    sets += [np.unique(rng.integers(0, 2**64, n, np.uint64, endpoint=False)) for n in (1, 5, 400, 3000)]
    bins = [ngram_join.parities(s) for s in sets]
    close = []
    for i, j in [(i, j) for i in range(len(sets)) for j in range(i)]:
        least = ngram_join.gaps([bins[i]], [bins[j]])
        assert least[0] <= len(np.setxor1d(sets[i], sets[j]))
        if i < 60:  # a likeness of 0.76
            close += ngram_join.possible(np.array([len(sets[i])]), np.array([len(sets[j])]), least, 0.8).tolist()
    assert sum(close) < 0.05 * len(close)


def test_few_parities_take_half_the_room_and_drop_unlike_sets(spark):
    """The first look at a pair; what it lets pass is looked at again, with the many."""
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 2**64, n, np.uint64, endpoint=False)) for n in (300, 320, 900, 1000, 1000)]
    sets.append(np.unique(np.concatenate([sets[4][:950], rng.integers(0, 2**64, 50, np.uint64, endpoint=False)])))
    thin, bins = ([ngram_join.parities(s, *how) for s in sets] for how in ((ngram_join.THIN, 2), ()))
    assert all(2 * len(x) <= len(y) for x, y in zip(thin, bins))
    rows = [(i, len(s), bytearray(x), bytearray(y)) for i, (s, x, y) in enumerate(zip(sets, thin, bins))]
    looks = spark.createDataFrame(rows, "node long, n_shingles long, thin binary, bins binary")
    pairs = spark.createDataFrame([(i, j) for j in range(len(sets)) for i in range(j)], ngram_join.PAIR)
    assert [tuple(r) for r in ngram_join.likely(pairs, looks, 0.8).collect()] == [(4, 5)]
    grouped = spark.createDataFrame([(k, n, n) for k in range(40) for n in (0, 4, 5)] + [(99, 1, 1), (99, 2, 2)], '"key" long, node long, "group" long'.replace('"', "`"))
    assert [tuple(r) for r in ngram_join.cross_pairs(grouped, looks, 0.8).collect()] == [(4, 5)]
