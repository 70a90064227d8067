"""Phrase collocations from a weighted de Bruijn graph of the longest grams.

Every place of a piece starts an edge: its word and the next three, from the node of the first three to the node of the last
three. Where the piece ends before, the edge leads to the end; these are the piece-end corrections. Edges are aggregated once,
and all shorter counts are flow: a phrase of three words occurs as often as edges leave its node, those to the end
included, one of two words as often as edges start with it.

First pass: words and their counts by language, each with a 64-bit number of word and language that is checked to be its own (else
another seed is tried), and how many edges fall to each bucket of first two words. Second pass: a task packs its edges,
equal ones combined, into one block a shard, with a dictionary of the block's words. A shard holds whole buckets, so that all its counts
are complete and rare phrases end there; a bucket that is too large is spread by the last two words, and its partial counts are
added up afterwards. Frequent edges are compacted: where one edge enters a node, one leaves it and both have the same
weight, they are one path. Paths say which longer phrase covers a shorter one.

Defined results: a null text is empty and has no words; a null language is `und`. Repeated rows count each time. Texts of any
length are read piece by piece; a piece is held whole. Equal scores and counts are ordered by the phrase's UTF-8 bytes. An empty table
gives no rows. Only language and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, slices, stored, total_bytes

LONGEST = 4  # words of an edge
FLUSH = 1_000_000  # words that a task reads before it gives out what it has combined
SHARD = 400_000  # edges of a shard, about
SPREAD = 16  # buckets of first two words for each shard

ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"."
# One byte to one byte: A-Z in lower case, all piece ends alike, tabs as blanks.
BYTES = bytes.maketrans(string.ascii_uppercase.encode() + ENDS + b"\t", string.ascii_lowercase.encode() + END * len(ENDS) + b" ")


class Reader:
    """Texts as numbers of words, one behind the other, 0 at piece ends."""

    def __init__(self):
        self.maps: dict[str, Numbers] = {}
        self.words: list[tuple[str, bytes]] = [("", END)]
        self.ids: list[int] = []

    def read(self, lang: str, text: bytes) -> None:
        words = self.maps.get(lang)
        if words is None:
            words = self.maps[lang] = Numbers(lang, self.words)
        flat = text.translate(BYTES)
        start = 0
        while start < len(flat):  # a long text is read in stretches that end with a piece
            stop = flat.find(END, start + (1 << 20)) + 1 or len(flat)
            self.ids.extend(map(words.__getitem__, flat[start:stop].replace(END, b" . ").split()))
            start = stop
        self.ids.append(0)


class Numbers(dict):
    def __init__(self, lang: str, words: list[tuple[str, bytes]]):
        super().__init__({END: 0})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.words)
        self.words.append((self.lang, word))
        return n


def readers(batches: Iterator[pa.RecordBatch]) -> Iterator[Reader]:
    reader = Reader()
    for batch in slices(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
            reader.read(lang, text)
            if len(reader.ids) >= FLUSH:
                yield reader
                reader = Reader()
    if reader.ids:
        yield reader


def numbers(words: list[tuple[str, bytes]], seed: int) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    out = np.array([xxh3_64_intdigest(lang.encode() + b"\0" + word, seed) for lang, word in words], np.uint64)
    out[0] = 0
    return out


def edges(ids: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The four words from every place that has at least two; 0 behind the end of the piece."""
    a = np.array([*ids, 0, 0, 0], np.int64)
    at = np.flatnonzero((a[:-3] > 0) & (a[1:-2] > 0))
    third = a[at + 2]
    return a[at], a[at + 1], third, np.where(third > 0, a[at + 3], 0)


def mixed(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = (x * np.uint64(0x9E3779B97F4A7C15) + y) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(32))


def vocabulary(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Rows (lang, word, h, n) of words, and rows (bucket, n) of how many edges start in a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "word", "h", "bucket", "n"]
        for reader in readers(batches):
            h = numbers(reader.words, seed)
            n = np.bincount(reader.ids, minlength=len(h))[1:]
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([w[0] for w in reader.words[1:]], pa.string()),
                pa.array([w[1] for w in reader.words[1:]], pa.binary()).cast(pa.string()),
                pa.array(h[1:].view(np.int64)), none, pa.array(n)], names)
            first, second, _, _ = edges(reader.ids)
            load = np.bincount((mixed(h[first], h[second]) % np.uint64(buckets)).astype(np.int64), minlength=1)
            used = np.flatnonzero(load)
            yield pa.RecordBatch.from_arrays([
                pa.nulls(len(used), pa.string()), pa.nulls(len(used), pa.string()), pa.nulls(len(used), pa.int64()),
                pa.array(used), pa.array(load[used])], names)

    rows = docs.mapInArrow(run, "lang string, word string, h long, bucket long, n long")
    return rows.groupBy("lang", "word", "h", "bucket").agg(F.sum("n").alias("n"))


def blocks(docs: DataFrame, seed: int, buckets: int, shards: int, hot: dict[int, tuple[int, int]]) -> DataFrame:
    """Combined edges by shard: their words' numbers, four codes an edge, and counts. `hot`: first shard and number of shards
    of each bucket that is spread."""
    hot_at = np.array(sorted(hot), np.int64)
    first_of = np.array([hot[b][0] for b in hot_at.tolist()], np.int64)
    count_of = np.array([hot[b][1] for b in hot_at.tolist()], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for reader in readers(batches):
            h = numbers(reader.words, seed)
            words = edges(reader.ids)
            reader.ids, reader.maps = [], {}
            front, back = (words[i].astype(np.uint64) << np.uint64(32) | words[i + 1].astype(np.uint64) for i in (0, 2))
            bucket = (mixed(h[words[0]], h[words[1]]) % np.uint64(buckets)).astype(np.int64)
            shard = bucket % shards
            if len(hot_at):
                place = np.minimum(np.searchsorted(hot_at, bucket), len(hot_at) - 1)
                is_hot = np.flatnonzero(hot_at[place] == bucket)
                spread = mixed(h[words[2][is_hot]], h[words[3][is_hot]])
                place = place[is_hot]
                shard[is_hot] = first_of[place] + (spread % count_of[place].astype(np.uint64)).astype(np.int64)
            order = np.lexsort((back, front, shard))
            front, back, shard = front[order], back[order], shard[order]
            fresh = np.concatenate([[True], (front[1:] != front[:-1]) | (back[1:] != back[:-1])]) if len(order) else np.empty(0, bool)
            start = np.flatnonzero(fresh)
            count = np.diff(np.append(start, len(order)))
            front, back, shard = front[start], back[start], shard[start]
            edge = np.append(np.flatnonzero(np.diff(shard, prepend=-1)), len(shard)).tolist()
            rows: list[tuple] = []
            for i, j in zip(edge[:-1], edge[1:]):
                ids = np.stack([front[i:j] >> np.uint64(32), front[i:j], back[i:j] >> np.uint64(32), back[i:j]]).astype(np.uint32)
                used, codes = np.unique(ids.ravel(), return_inverse=True)
                codes = codes.astype(np.uint16 if len(used) <= 1 << 16 else np.uint32)
                rows.append((int(shard[i]), j - i, h[used].tobytes(), codes.tobytes(), count[i:j].astype(np.uint32).tobytes()))
                if len(rows) == 64 or j == edge[-1]:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                        zip(*rows), (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["shard", "n", "words", "codes", "counts"])
                    rows = []

    return docs.mapInArrow(run, "shard long, n long, words binary, codes binary, counts binary")


GRAM = "h1 long, h2 long, h3 long, h4 long, n long"


def flows(shards: int, least: int):
    """Counts of the phrases of two to four words of one shard. In a spread shard those of two and three words are partial."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        dictionaries = [np.frombuffer(w, np.uint64) for w in rows["words"]]
        known = np.unique(np.concatenate(dictionaries))
        parts_ = []
        for n, codes, own in zip(rows["n"], rows["codes"], dictionaries):
            kind = np.uint16 if len(codes) == 8 * n else np.uint32
            parts_.append(np.searchsorted(known, own)[np.frombuffer(codes, kind).reshape(4, n)])
        words = np.concatenate(parts_, 1).astype(np.uint64)
        count = np.concatenate([np.frombuffer(c, np.uint32) for c in rows["counts"]]).astype(np.int64)
        front, back = (words[i] << np.uint64(32) | words[i + 1] for i in (0, 2))
        order = np.lexsort((back, front))
        words, count, front, back = words[:, order], count[order], front[order], back[order]
        zero = np.uint64(0 if known[0] == 0 else 1 << 40)  # the place of the end among the words
        spread = rows["shard"].iloc[0] >= shards
        new2 = np.concatenate([[True], front[1:] != front[:-1]])
        new3 = new2 | np.concatenate([[True], words[2][1:] != words[2][:-1]])
        new4 = new3 | np.concatenate([[True], words[3][1:] != words[3][:-1]])
        out = []
        for size, new in ((2, new2), (3, new3), (4, new4)):
            start = np.flatnonzero(new)
            n = np.add.reduceat(count, start)
            keep = n >= (1 if spread and size < LONGEST else least)
            if size > 2:
                keep &= words[size - 1][start] != zero
            start = start[keep]
            columns = [known[words[k][start]].view(np.int64) if k < size else np.zeros(len(start), np.int64) for k in range(LONGEST)]
            out.append(np.stack([*columns, n[keep]], 1))
        return pd.DataFrame(np.concatenate(out), columns=["h1", "h2", "h3", "h4", "n"])

    return run


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Two written tables: words (lang, word, h, n), and phrases (g, n) of two to four words that occur `least` times or more,
    g the numbers of their words."""
    expected = total_bytes(docs) // 6
    shards = int(max(1, -(-expected // SHARD)))
    buckets = shards * SPREAD
    seed = 0
    while True:
        counted = stored(vocabulary(docs, buckets, seed), "gram-words")
        words = counted.filter("word IS NOT NULL").select("lang", "word", "h", "n")
        if words.filter("h = 0").isEmpty() and words.groupBy("h").count().filter("count > 1").isEmpty():
            break
        seed += 1
    # Buckets beyond the size of a shard; there are at most as many as shards.
    hot, after = {}, shards
    for r in counted.filter(F.col("bucket").isNotNull() & (F.col("n") > SHARD)).select("bucket", "n").collect():
        hot[r["bucket"]] = after, -(-r["n"] // SHARD)
        after += hot[r["bucket"]][1]
    dealt = blocks(docs, seed, buckets, shards, hot)
    grams = dealt.repartition(parts(docs, after, 1), "shard").groupBy("shard").applyInPandas(flows(shards, least), GRAM)
    grams = grams.groupBy("h1", "h2", "h3", "h4").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    g = F.filter(F.array("h1", "h2", "h3", "h4"), lambda x: x != 0)
    return words, stored(grams.select(g.alias("g"), "n"), "grams")


def compacted(grams: DataFrame) -> DataFrame:
    """Unary paths (g, n) of the frequent edges: chains in which each inner node has one edge in and one out, of equal weight.

    Pointers double, so a path of m edges takes log m rounds. Circles keep their edges one by one."""
    full = grams.filter(F.size("g") == LONGEST).select("g", "n", F.slice("g", 1, LONGEST - 1).alias("left"), F.slice("g", 2, LONGEST - 1).alias("right"))
    into = full.groupBy(F.col("right").alias("node")).agg(F.count("*").alias("ins"), F.first("g").alias("before"), F.first("n").alias("n"))
    out = full.groupBy(F.col("left").alias("node")).agg(F.count("*").alias("outs"), F.first("g").alias("g"), F.first("n").alias("m"))
    links = into.join(out, "node").filter("ins = 1 AND outs = 1 AND n = m AND before <> g").select("g", "before")
    links = stored(links, "gram-links")
    heads = links.select("g", F.col("before").alias("head"), F.lit(1).cast("long").alias("steps"), F.lit(True).alias("moved"))
    for _ in range(links.count().bit_length() + 1):
        further = heads.select(F.col("g").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"))
        heads = stored(heads.drop("moved").join(further, "head", "left").select(
            "g", F.coalesce("next", "head").alias("head"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
            F.col("next").isNotNull().alias("moved")), "gram-heads")
        if heads.filter("moved").isEmpty():
            break
    heads = heads.filter("NOT moved").drop("moved")  # what still moves goes round in a circle
    placed = full.select("g", "n").join(heads, "g", "left").select(
        "n", "g", F.coalesce("head", "g").alias("head"), F.coalesce("steps", F.lit(0)).alias("steps"))
    path = F.array_sort(F.collect_list(F.struct("steps", "g")))
    whole = placed.groupBy("head").agg(path.alias("path"), F.first("n").alias("n"))
    tail = F.transform(F.slice("path", 2, F.size("path")), lambda e: F.element_at(e["g"], -1))
    return whole.select(F.concat("head", tail).alias("g"), "n")


def covered(grams: DataFrame) -> DataFrame:
    """(g, most): for each phrase inside longer frequent ones, the greatest count of these."""
    def inner(size: int):
        return F.transform(F.sequence(F.lit(1), F.size("g") - size + 1), lambda i: F.slice("g", i, size))

    paths = compacted(grams)
    threes = grams.filter(F.size("g") == 3)
    rows = paths.select(F.explode(F.concat(inner(2), inner(3))).alias("g"), "n").unionByName(
        threes.select(F.explode(inner(2)).alias("g"), "n"))
    return rows.groupBy("g").agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, least: int = 30, first: int = 2000, lang: str = "lang", text: str = "text") -> DataFrame:
    """Each language's `first` phrases: lang, rank, phrase, a (its count), l and r (the counts of both sides of its weakest cut), n
    (words of the language) and score."""
    docs = docs.filter(F.col(text).isNotNull()).select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    words, grams = phrase_counts(docs, least)
    often = words.filter(F.col("n") >= least)
    counts = grams.unionByName(often.select(F.array("h").alias("g"), "n"))
    cuts = grams.select("g", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("g") - 1)).alias("k"))
    cuts = cuts.withColumns({"head": F.slice("g", 1, F.col("k")), "rest": F.slice("g", F.col("k") + 1, F.size("g"))})
    cuts = cuts.join(counts.select(F.col("g").alias("head"), F.col("n").alias("l")), "head")
    cuts = cuts.join(counts.select(F.col("g").alias("rest"), F.col("n").alias("r")), "rest")
    score = F.expr("(2000000BD * CAST(a AS DECIMAL(20, 0))) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))")
    scored = cuts.groupBy("g", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("c"))
    kept = scored.join(covered(grams), "g", "left").filter(
        F.col("most").isNull() | F.expr("100BD * CAST(most AS DECIMAL(20, 0)) < 80BD * CAST(a AS DECIMAL(20, 0))"))
    kept = stored(kept.select("g", "a", "c.score", "c.l", "c.r"), "collocations")
    spelled = kept.select("g", F.posexplode("g").alias("at", "h")).join(often.select("lang", "word", "h"), "h")
    spelled = spelled.groupBy("g").agg(F.first("lang").alias("lang"), F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    # Ranks up to a bound are cut within each task before they are gathered.
    best = kept.join(spelled, "g").withColumn("rank", rank).filter(F.col("rank") <= first)
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def sql(least: int = 30, first: int = 2000) -> str:
    """The collocations of the documents table in DuckDB's SQL."""
    return f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
x AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
    FROM x, (VALUES (1), (2), (3), (4)) t(k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= {least}),
u AS (SELECT lang, k, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:k], ' ') AS rest
    FROM c, (VALUES (1), (2), (3)) t(j) WHERE j < k),
s AS (SELECT u.*, l.f AS l, r.f AS r, ((2000000::HUGEINT * a) // (l.f + r.f))::BIGINT AS score FROM u
    JOIN f l ON l.lang = u.lang AND l.k = u.j AND l.phrase = u.head JOIN f r ON r.lang = u.lang AND r.k = u.k - u.j AND r.phrase = u.rest),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
i AS (SELECT lang, a, unnest(list_transform(range(1, k - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
    FROM c, (VALUES (2), (3)) t(m) WHERE m < k),
o AS (SELECT lang, phrase, max(a) AS most FROM i GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b LEFT JOIN o USING (lang, phrase) JOIN n USING (lang) WHERE most IS NULL OR 100 * most < 80 * a
QUALIFY rank <= {first}
"""
