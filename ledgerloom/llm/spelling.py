"""Spelling variants: words that differ by one letter, found through a trie of letter-group counts.

Letters are dealt to `GROUPS` groups of about equal mass. A word's frequency vector counts its letters by group, and the trie
branches on one count after the other. One edit changes few counts: an inserted letter is a surplus of one, a deleted one
a deficit of one, a replaced one both or neither. The depth-first search takes all words that ask at a node along with
what is left of their budgets, goes to the child of the same count for free and to those next to it for a surplus or a
deficit, and verifies the words of the leaves. Each pair is looked for from one side: from the shorter word, or from the
smaller of two words of one length.

The upper levels of the trie are shared out: a word lives under its first `depth` counts and asks under all prefixes that its
budget reaches. `depth` is the least at which a word's subtree is small enough. A subtree of too many words, or one that too many
ask in, is cut into tiles (some of its words against some of those that ask), so that no task grows with it. Words of a large
leaf meet only if their first or their last halves agree, as one edit leaves one of them alone.

Defined results: null and empty texts have no words; a null id counts as an empty one. Very long runs are words like others.
Repeated rows count each time. An empty table gives no words. Only the key and the text are read, so other columns cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, stored

RUN = "([A-Za-zÀ-ÿ]+)"
NOISE = 97  # a run whose checksum this divides loses a letter
GROUPS = 8
SUBTREE = 20_000  # words, and words that ask, in a tile
LEAF = 20_000  # pairs of count vectors compared at once
PAIRS = 1 << 18  # pairs of words verified at once

NEAR = "a string, n long, b string, m long"


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = 5, least: int = 3) -> DataFrame:
    """(word, n): the runs of letters, A-Z in lower case, some of them short of one letter, that occur often enough."""
    body = F.translate(F.coalesce(F.col(text), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    runs = docs.select(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":")).alias("head"),
                       F.explode(F.regexp_extract_all(body, F.lit(RUN), F.lit(1))).alias("run"))
    runs = runs.filter(F.length("run") >= letters)
    h = F.crc32(F.concat("head", "run"))
    at = F.pmod(h, F.length("run").cast("long")).cast("int")
    short = F.concat(F.substr("run", F.lit(1), at), F.substr(F.col("run"), at + 2))
    words = runs.select(F.when(F.pmod(h, F.lit(NOISE)) == 0, short).otherwise(F.col("run")).alias("word"))
    found = words.filter(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return found.filter(F.col("n") >= least)


def letter_groups(words: DataFrame) -> np.ndarray:
    """Group of each letter (its code), groups of about equal mass. What is collected is one row a letter."""
    seen = words.select(F.explode(F.split("word", "")).alias("c")).filter("c <> ''").groupBy("c").count().collect()
    mass, out = [0] * GROUPS, np.zeros(256, np.int64)
    for r in sorted(seen, key=lambda r: (-r["count"], r["c"])):
        lightest = mass.index(min(mass))
        out[ord(r["c"])] = lightest
        mass[lightest] += r["count"]
    return out


class Words:
    """Words as codes one behind the other, with their vectors of counts."""

    def __init__(self, words: list[str], groups: np.ndarray):
        raw = [w.encode("latin-1") for w in words]
        self.size = np.array([len(w) for w in raw], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.size)[:-1]]).astype(np.int64)
        self.codes = np.frombuffer(b"".join(raw), np.uint8)
        row = np.repeat(np.arange(len(raw)), self.size)
        self.vectors = np.bincount(row * GROUPS + groups[self.codes], minlength=len(raw) * GROUPS).reshape(-1, GROUPS)
        self.raw = raw


def verified(words: Words, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs differ by exactly one letter, if b is as long as a or longer by one."""
    ok = np.zeros(len(a), bool)
    for size in np.unique(words.size[a]):
        for extra in (0, 1):
            every = np.flatnonzero((words.size[a] == size) & (words.size[b] == size + extra))
            step = max(1, (4 << 20) // int(size))
            for k in range(0, len(every), step):
                at = every[k : k + step]
                x = words.codes[words.start[a[at], None] + np.arange(size)]
                y = words.start[b[at], None] + np.arange(size)
                front = x == words.codes[y]
                if extra:
                    # Equal up to some place, and equal from there on if b is read one letter further.
                    back = x == words.codes[y + 1]
                    head = np.where(front.all(1), size, front.argmin(1))
                    tail = np.where(back.all(1), size, back[:, ::-1].argmin(1))
                    ok[at] = head + tail >= size
                else:
                    ok[at] = size - front.sum(1) == 1
    return ok


def halves_agree(words: Words, homes: np.ndarray, asking: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a large leaf with the same first or the same last half."""
    sizes = set(words.size[asking].tolist())
    index: dict[tuple, list[int]] = {}
    for j in homes.tolist():
        w = words.raw[j]
        for size in {len(w), len(w) - 1} & sizes:
            half = size // 2
            index.setdefault((size, 0, w[:half]), []).append(j)
            index.setdefault((size, 1, w[len(w) - size + half :]), []).append(j)
    a, b = [], []
    for i in asking.tolist():
        w = words.raw[i]
        half = len(w) // 2
        for key in ((len(w), 0, w[:half]), (len(w), 1, w[half:])):
            for k in range(0, len(met := index.get(key, [])), PAIRS):
                b.extend(met[k : k + PAIRS])
                a.extend([i] * (len(b) - len(a)))
                if len(a) >= PAIRS:
                    yield np.array(a), np.array(b)
                    a, b = [], []
    yield np.array(a, np.int64), np.array(b, np.int64)


def search(words: Words, level: int, homes: np.ndarray, asking: np.ndarray, more: np.ndarray, less: np.ndarray) -> Iterator[tuple]:
    """Pairs (asking, home) whose vectors differ within the budgets: `more` and `less` say whether a surplus and a deficit are left."""
    if not len(homes) or not len(asking):
        return
    if level == GROUPS and len(homes) * len(asking) > LEAF:
        yield from halves_agree(words, homes, asking)
    elif level == GROUPS or len(homes) * len(asking) <= LEAF:
        apart = words.vectors[homes][None, :, level:] - words.vectors[asking][:, None, level:]
        over = np.maximum(apart, 0).sum(2)
        under = over - apart.sum(2)
        i, j = np.nonzero((over <= more[:, None]) & (under <= less[:, None]))
        yield asking[i], homes[j]
    else:
        here, theirs = words.vectors[homes, level], words.vectors[asking, level]
        for count in np.unique(here):
            up, down = (theirs == count - 1) & more, (theirs == count + 1) & less
            pick = (theirs == count) | up | down
            yield from search(words, level + 1, homes[here == count], asking[pick], (more & ~up)[pick], (less & ~down)[pick])


def prefixes(vectors: np.ndarray, depth: int) -> Iterator[np.ndarray]:
    """Prefixes of `depth` counts that each word's budget of one surplus and one deficit reaches."""
    top = vectors[:, :depth]
    yield top
    for i in range(depth):
        one = np.eye(1, depth, i, dtype=np.int64)
        yield top + one
        yield top - one
        for j in range(depth):
            if i != j:
                yield top + one - np.eye(1, depth, j, dtype=np.int64)


def names(prefix: np.ndarray) -> np.ndarray:
    """One number for each prefix. Unlike prefixes may share one, which only brings more words together."""
    out = np.full(len(prefix), 1469598103934665603, np.uint64)
    for column in prefix.T:
        out = (out ^ column.astype(np.int64).view(np.uint64)) * np.uint64(1099511628211)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def depth_of(words: DataFrame, groups: np.ndarray, limit: int = SUBTREE) -> int:
    """Levels of the trie that are shared out: the least at which the mean word's subtree has at most `limit` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = Words(batch.column("word").to_pylist(), groups).vectors
            for depth in range(GROUPS + 1):
                keys, counts = np.unique(names(vectors[:, :depth]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), depth)), pa.array(keys), pa.array(counts)], ["depth", "key", "n"])

    sizes = words.select("word").mapInArrow(run, "depth long, key long, n long").groupBy("depth", "key").agg(F.sum("n").alias("n"))
    total = sizes.groupBy("depth").agg((F.sum(F.col("n").cast("double") ** 2) / F.sum("n")).alias("mean")).collect()
    return min((r["depth"] for r in total if r["mean"] <= limit), default=GROUPS if total else 0)


def near_pairs(words: DataFrame, limit: int = SUBTREE) -> DataFrame:
    """(a, n, b, m): each two (written) words that differ by one letter, once."""
    groups = letter_groups(words)
    depth = depth_of(words, groups, limit)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = Words(batch.column("word").to_pylist(), groups).vectors
            word, n = batch.column("word"), batch.column("n")

            for home, prefix in [(True, vectors[:, :depth]), *((False, p) for p in prefixes(vectors, depth))]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names(prefix)), word, n, pa.array(np.full(len(prefix), home))], ["key", "word", "n", "home"])

    routed = words.mapInArrow(route, "key long, word string, n long, home boolean")
    routed = stored(routed, "routes")
    load = routed.groupBy("key").agg(F.count_if("home").alias("homes"), F.count_if(~F.col("home")).alias("asking"))
    load = load.filter("homes > 0 AND asking > 0")
    load = stored(load.select("key", F.ceil(F.col("homes") / limit).alias("down"), F.ceil(F.col("asking") / limit).alias("across"),
                              "homes", "asking"), "subtrees")
    rows = load.agg(F.sum(F.col("homes") * F.col("across") + F.col("asking") * F.col("down"))).first()[0] or 0
    n = parts(words, int(rows), SUBTREE)
    own = F.pmod(F.xxhash64("word", F.lit(7)), F.when(F.col("home"), F.col("down")).otherwise(F.col("across")))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.when(F.col("home"), F.col("across")).otherwise(F.col("down")) - 1))
    dealt = routed.join(load.drop("homes", "asking"), "key").select("key", "word", "n", "home", own.alias("own"), every.alias("other"))
    tile = F.when(F.col("home"), F.struct("key", F.col("own").alias("s"), F.col("other").alias("t"))).otherwise(
        F.struct("key", F.col("other").alias("s"), F.col("own").alias("t")))
    dealt = dealt.withColumn("tile", F.xxhash64(tile)).withColumn("slot", F.pmod("tile", F.lit(n)))

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("tile", kind="stable")
        words = Words(rows["word"].tolist(), groups)
        home, tile, text = rows["home"].to_numpy(bool), rows["tile"].to_numpy(), rows["word"].to_numpy(object)
        edges = np.append(np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])), len(tile))
        found, waiting, held = [], [], 0

        def settle() -> None:
            a, b = (np.concatenate([w[k] for w in waiting]).astype(np.int64) for k in (0, 1))
            one_way = (words.size[a] < words.size[b]) | (words.size[a] == words.size[b]) & (text[a] < text[b])
            a, b = a[one_way], b[one_way]
            good = verified(words, a, b)
            found.append((a[good], b[good]))
            waiting.clear()

        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            here = np.arange(start, stop)
            asking = here[~home[here]]
            for pair in search(words, 0, here[home[here]], asking, np.ones(len(asking), bool), np.ones(len(asking), bool)):
                waiting.append(pair)
                held += len(pair[0])
                if held >= PAIRS:
                    settle()
                    held = 0
        if waiting:
            settle()
        a, b = (np.concatenate([f[k] for f in found] or [np.empty(0, np.int64)]) for k in (0, 1))
        n = rows["n"].to_numpy()
        return pd.DataFrame({"a": text[a], "n": n[a], "b": text[b], "m": n[b]})

    # A large leaf may show a pair twice.
    return dealt.repartition(n, "slot").groupBy("slot").applyInPandas(run, NEAR).distinct()


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", letters: int = 5, least: int = 3, limit: int = SUBTREE) -> DataFrame:
    """(word, n, form, root, n_near, form_n) of each word of the documents.

    form: the near word of largest n, ties to the smallest, if its n is at least twice the word's. root: where forms
    lead to in the end. As n doubles with each step, few rounds of pointer doubling follow all forms."""
    words = stored(word_counts(docs, key, text, letters, least), "words")
    pairs = stored(near_pairs(words, limit), "near-words")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("m").alias("n"), F.col("a").alias("b"), F.col("n").alias("m")))
    best = F.min(F.struct((-F.col("m")).alias("m"), F.col("b").alias("form")))
    near = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left").withColumns({
        "n_near": F.coalesce("n_near", F.lit(0).cast("long")),
        "best": F.when(-F.col("best.m") >= 2 * F.col("n"), F.col("best"))})
    found = stored(found.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.m")).alias("form_n")), "forms")
    roots = found.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if roots.filter("moved").isEmpty():
            break
        roots = roots.drop("moved")
    return found.join(roots.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))
