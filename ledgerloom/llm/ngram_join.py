"""Exact Jaccard join of word shingle sets by partitions of the universe.

Two sets of at most `u` shingles whose Jaccard likeness is at least t differ in at most H = (1-t)/(1+t) * 2u shingles.
Hashing cuts the universe into segments; an exact segment is filed under the hash of the set's shingles in it, a
segment with neighbourhood also under the hashes with any one of them left out. If one differing shingle may
hit each exact segment and two each segment with a neighbourhood, H differences cannot hit all as soon as
exact + 2 * neighbourhoods > H: linked sets meet under one signature. `allocation` picks the cheapest such mix per
size band from the signatures it costs and the chance that unlike sets meet. Bands grow by 1/t, so a set is filed in its own
band and, as a smaller partner, in the next one.

Sets that meet are compared exactly, shingle by shingle. What is sought are the connected groups, so each signature first
links its sets with one hub, at first the set found in the largest buckets, then, turn by turn, others for the sets that still
stand in different groups; when a turn closes less than half of what is open, all sets left in different groups
are paired, if sizes and parities of their shingles over fixed parts of the universe allow a link. No link between groups
is lost, and a bucket of thousands of near copies makes few pairs. Equal sets are one set from the start.

Defined results: words are runs of other than ASCII white space, A-Z in lower case. A text with fewer words than a
shingle is one shingle; null, empty or blank texts have none and are linked with nothing. Long texts are read whole, one after
the other. An empty table gives no rows. Only key and text are read, so other columns cannot clash. Rows with equal ids are judged
together: their component is that of any of them. Rows without an id have no component.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import batches_of, parts, release, slices, small, stored
from ledgerloom.llm.components import components

BITS = 1024  # least number of parts of the universe of whose shingles a parity is kept; large sets have 2 to 4 for each shingle
THIN = 256  # the same for the parities of a first look, with 1 to 2 for each shingle, which tell most unlike sets apart
TILE = 1024  # sets compared at once within a bucket


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def split_words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingles(text: str, n: int) -> set[tuple[bytes, ...]]:
    words = split_words(text)
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n))))


def hashed(text: str, n: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, sorted."""
    from xxhash import xxh3_64_intdigest

    words = split_words(text)
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([xxh3_64_intdigest(w) for w in words], np.uint64)
    k = min(n, len(words))
    out = np.full(len(h) - k + 1, k, np.uint64)
    for i in range(k):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i])
    return np.unique(out)


def band_of(size: int, t: float) -> int:
    """Band of a set size; sizes of a band differ by a factor of at most 1/t."""
    return int(math.floor(math.log(size) / -math.log(t) + 1e-9))


def top_of(band: int, t: float) -> int:
    """Largest size in a band."""
    top = int(math.exp((band + 1) * -math.log(t))) + 1
    while band_of(top, t) > band:
        top -= 1
    return top


def differences(a: int, b: int, t: float) -> int:
    """Most shingles in which linked sets of these sizes differ."""
    return int(math.floor((1 - t) / (1 + t) * (a + b) + 1e-9))


def allocation(top: int, t: float, chance: float = 0.01, meeting: float = 1e6) -> tuple[int, int]:
    """(segments with exact signatures, segments with neighbourhoods) of least cost for sets of up to `top` shingles.

    Cost: signatures of a set, plus `meeting` times the chance that all shingles of a segment also stand in an unlike
    set, where each does with probability `chance`.
    """
    need, best = differences(top, top, t) + 1, None
    for near in sorted({0, need // 8, need // 4, need // 2, need}):
        exact = max(0, need - 2 * near)
        m = exact + near
        if m == 0:
            continue
        each = top / m
        cost = exact * (1 + meeting * chance**each) + near * (1 + each) * (1 + meeting * chance ** max(0.0, each - 1))
        if best is None or cost < best[0]:
            best = cost, exact, near
    return best[1], best[2]


def signatures(tokens: np.ndarray, band: int, t: float, plans: dict) -> np.ndarray:
    """Signatures of one set under a band."""
    exact, near = plans.get(band) or plans.setdefault(band, allocation(top_of(band, t), t))
    m = exact + near
    place = (mix(tokens + np.uint64(band)) % np.uint64(m)).astype(np.int64)
    spread = mix(tokens)
    sums = np.zeros(m, np.uint64)
    np.add.at(sums, place, spread)
    salt = np.arange(m, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(band)
    out = [mix(sums + salt)]
    if near:
        inside = place >= exact
        out.append(mix(sums[place[inside]] - spread[inside] + salt[place[inside]]))
    return np.unique(np.concatenate(out))


def identity(tokens: np.ndarray) -> tuple[int, int]:
    return int(np.add.reduce(mix(tokens))), int(np.add.reduce(mix(tokens ^ np.uint64(0x5851F42D4C957F2D))))


def parities(tokens: np.ndarray, least: int = BITS, each: int = 4) -> bytes:
    """Whether each part of the universe, the shingles of equal low bits, holds an odd number of the set's, a bit a part. Parts are a
    power of two, so that any two sets can be folded to one number of parts. Where the parities of two sets differ, they
    differ in a shingle; few differences seldom meet in a part, so hardly one is hidden."""
    bits = max(least.bit_length() - 1, (each * len(tokens)).bit_length() - 1)
    counts = np.bincount((tokens & np.uint64((1 << bits) - 1)).astype(np.int64), minlength=1 << bits)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(bins: list[bytes], size: int) -> np.ndarray:
    """Parities as rows of `size` bytes each, in words."""
    out, sizes = np.empty((len(bins), size // 8), np.uint64), np.array([len(b) for b in bins])
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        rows = np.frombuffer(b"".join(bins[i] for i in at), np.uint64).reshape(len(at), n // size, size // 8)
        out[at] = np.bitwise_xor.reduce(rows, axis=1)
    return out


def unlike(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Least number of shingles in which the sets of each pair of rows differ."""
    return np.bitwise_count(one ^ two).sum(1, dtype=np.int64)


def gaps(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """The same of pairs of parities of any size."""
    size, out = np.array([min(len(a), len(b)) for a, b in zip(one, two)], np.int64), np.zeros(len(one), np.int64)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        for k in range(0, len(at), max(1, (4 << 20) // int(n))):
            part = at[k : k + max(1, (4 << 20) // int(n))]
            out[part] = unlike(folded([one[i] for i in part], n), folded([two[i] for i in part], n))
    return out


def sketches(docs: DataFrame, n: int) -> DataFrame:
    """Per row of (doc_id, text): set size, set identity and parities, over few and over many parts."""
    schema = T.StructType([
        docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in ("n_shingles", "set1", "set2")),
        T.StructField("thin", T.BinaryType()), T.StructField("bins", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, sets, thin, bins = [], [], [], []
            for text in batch.column("text").to_pylist():
                tokens = hashed(text or "", n)
                sizes.append(len(tokens))
                sets.append(identity(tokens))
                thin.append(parities(tokens, THIN, 2))
                bins.append(parities(tokens))
            longs = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (sizes, *zip(*sets))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *longs, *(pa.array(x, pa.binary()) for x in (thin, bins))], schema.fieldNames())

    return docs.mapInArrow(run, schema)


def filed(docs: DataFrame, t: float, n: int) -> DataFrame:
    """(key, node, own): the signatures of each set in its own band and, not own, in the next.

    A task files a set once, under the first id it meets, so copies shrink to one a task before the shuffle."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("node", T.LongType()), T.StructField("own", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plans: dict = {}
        seen: set = set()
        for batch in slices(batches, "text", 1 << 20):
            keys, nodes, own = [np.empty(0, np.uint64)], [], []
            for node, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tokens = hashed(text or "", n)
                if node is None or not len(tokens) or (key := identity(tokens)) in seen:
                    continue
                seen.add(key)
                band = band_of(len(tokens), t)
                for at in (band, band + 1):
                    keys.append(signatures(tokens, at, t, plans))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
                    own.append(np.full(len(keys[-1]), at == band))
            if nodes:
                arrays = [np.concatenate(keys).view(np.int64), np.concatenate(nodes), np.concatenate(own)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], schema.fieldNames())

    return docs.mapInArrow(run, schema)


def met(rows: DataFrame, n: int) -> DataFrame:
    """Rows (key, node) whose signature another node has too, if one of them is in its own band."""
    schema = T.StructType([rows.schema["key"], rows.schema["node"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def found(t: pa.Table) -> Iterator[pa.RecordBatch]:
            key, node = t["key"].to_numpy(), t["node"].to_numpy()
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
            if not fresh.all():  # repeated rows of one document
                t = t.filter(pa.array(fresh))
                key = key[fresh]
            own = t["own"].to_numpy()
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            count = np.diff(np.append(edge, len(key)))
            good = (count > 1) & np.logical_or.reduceat(own, edge)
            keep = np.repeat(good, count)
            yield from t.select(["key", "node"]).filter(pa.array(keep)).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now])
            key = now["key"].to_numpy()
            last = int(np.searchsorted(key, key[-1]))  # the last key may go on in the next batch
            held = now.slice(last)
            if last:
                yield from found(now.slice(0, last))
        if held is not None:
            yield from found(held)

    return rows.repartition(n, "key").sortWithinPartitions("key", "node").mapInArrow(run, schema)


def possible(sizes: np.ndarray, others: np.ndarray, apart: np.ndarray, t: float) -> np.ndarray:
    """Whether sets of these sizes that differ in at least `apart` shingles can be linked."""
    low, high = np.minimum(sizes, others), np.maximum(sizes, others)
    return (low >= t * high - 1e-6) & (apart <= (1 - t) / (1 + t) * (sizes + others) + 1e-6)


PAIR = "a long, b long"


def likely(pairs: DataFrame, looks: DataFrame, t: float) -> DataFrame:
    """Those of the distinct pairs of nodes whose sizes and parities allow a link. Few parts tell most; the many parts, which take
    several times the room, are joined to what is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = gaps(batch.column("look").to_pylist(), batch.column("other").to_pylist())
            ok = possible(batch.column("n_shingles").to_numpy(), batch.column("size").to_numpy(), apart, t)
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    for look in ("thin", "bins"):
        one = looks.select(F.col("node").alias("a"), F.col("n_shingles").alias("size"), F.col(look).alias("other"))
        two = looks.select(F.col("node").alias("b"), "n_shingles", F.col(look).alias("look"))
        pairs = pairs.join(one, "a").join(two, "b").mapInArrow(run, PAIR)
    return pairs


def hub_pairs(grouped: DataFrame, looks: DataFrame, tried: DataFrame | None, t: float, turn: int) -> DataFrame:
    """Each set of a bucket with the bucket's hub, if they stand in different groups, were not tried before, and sizes and
    parities allow a link. Parities join distinct pairs only. Each turn has other hubs."""
    lead = F.col("weight") if turn == 0 else F.xxhash64("node", F.lit(turn))
    best = F.max(F.struct(lead.alias("lead"), (-F.col("node")).alias("first"), F.col("group").alias("home")))
    hubs = grouped.groupBy("key").agg(best.alias("h")).select("key", (-F.col("h.first")).alias("hub"), "h.home")
    pairs = grouped.join(hubs, "key").filter(F.col("home") != F.col("group"))
    pairs = pairs.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct()
    if tried is not None:
        pairs = pairs.join(tried, ["a", "b"], "left_anti")
    return likely(pairs, looks, t)


def cross_pairs(grouped: DataFrame, looks: DataFrame, t: float) -> DataFrame:
    """Pairs of a bucket that stand in different groups, where sizes and parities allow a link: of `grouped` (key, node, group).

    A large bucket is dealt by node to parts of about `TILE` sets, and each two parts (or one with itself) are a tile of their
    own, so that no task holds a bucket. A task takes many tiles and only gives out the pairs that remain."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("tile", kind="stable")
        tile, node, group, side = (rows[c].to_numpy() for c in ("tile", "node", "group", "side"))
        size, bins, out = rows["n_shingles"].to_numpy(), rows["bins"].tolist(), [np.empty((0, 2), np.int64)]
        edges = np.append(np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]])), len(tile))
        for start, stop in zip(edges[:-1].tolist(), edges[1:].tolist()):
            here = np.arange(start, stop)
            own = (side[start:stop] == 0).all()  # a part with itself, else one against the other
            for p in chunks(here[side[here] <= 0]):
                for q in chunks(here if own else here[side[here] > 0]):
                    apart = group[p, None] != group[None, q]
                    if own:
                        apart &= p[:, None] < q[None, :]
                    apart &= possible(size[p, None], size[None, q], 0, t)
                    x, y = np.nonzero(apart)
                    least = min(len(bins[k]) for k in (*p.tolist(), *q.tolist()))
                    one, two = folded([bins[k] for k in p], least), folded([bins[k] for k in q], least)
                    step = max(1, (4 << 20) // least)
                    for k in range(0, len(x), step):
                        u, v = p[x[k : k + step]], q[y[k : k + step]]
                        least_gap = unlike(one[x[k : k + step]], two[y[k : k + step]])
                        ok = possible(size[u], size[v], least_gap, t)
                        out.append(np.stack([node[u[ok]], node[v[ok]]], 1))
        found = pd.DataFrame(np.unique(np.concatenate(out), axis=0), columns=["a", "b"])
        del out, bins
        release()
        return found

    def chunks(rows: np.ndarray) -> list[np.ndarray]:
        return [rows[k : k + TILE] for k in range(0, len(rows), TILE)]

    # Buckets of the same sets make the same pairs: one of them is left. Sizes and parities, of few parts, are joined last.
    rows = grouped.select("key", "node", "group")
    alike = [F.sum(F.xxhash64("node", F.lit(seed)).cast("decimal(38,0)")).alias(f"sum{seed}") for seed in (5, 7)]
    buckets = rows.groupBy("key").agg(F.count("*").alias("n"), *alike).groupBy("n", "sum5", "sum7").agg(F.min("key").alias("key"))
    ways = buckets.select("key", F.ceil(F.col("n") / TILE).alias("ways"))
    dealt = rows.join(ways, "key").withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), "ways"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)))
    tile = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = stored(dealt.select("node", "group", tile.alias("tile"), F.signum(F.col("own") - F.col("other")).cast("int").alias("side")), "dealt")
    n = parts(grouped, dealt.count(), 5_000)
    thin = looks.select("node", "n_shingles", F.col("thin").alias("bins"))
    slots = dealt.join(thin, "node").withColumn("slot", F.pmod("tile", F.lit(n)))
    pairs = slots.repartition(n, "slot").groupBy("slot").applyInPandas(run, PAIR)
    return likely(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), looks, t)


def verified(pairs: DataFrame, docs: DataFrame, t: float, n: int) -> DataFrame:
    """Those of the (written) pairs of ids whose shingle sets are linked, written. Rows of one id are all tried."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    docs = docs.join(small(ids), "doc_id", "left_semi")  # else the texts of all documents would be shuffled
    num, den = int(round(t * 10**6)), 10**6

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lru_cache(maxsize=4)(partial(shingles, n=n))  # hubs come again and again
        for batch in (half for left in slices(batches, "x") for half in slices(iter([left]), "y")):
            ok = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                p, q = known(x or ""), known(y or "")
                both = len(p & q)
                ok.append(den * both >= num * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = pairs.join(docs.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
    two = one.join(docs.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b")
    with batches_of(docs.sparkSession, 128):
        return stored(two.select("a", "b", "x", "y").mapInArrow(run, PAIR).distinct(), "links")


def one_of_each(docs: DataFrame, t: float = 0.8, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs that stay if each group keeps its smallest id, once. Rows without an id all stay."""
    groups = stored(ngram_groups(docs, t, n, key, text), "groups")
    gone = groups.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct()
    left = docs.join(small(gone), key, "left_anti")
    again = groups.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).count().filter("count > 1").select(key)
    if again.isEmpty():
        return left
    # Only ids of several rows are shuffled to keep one of them.
    again = small(stored(again, "repeated-ids"))
    return left.join(again, key, "left_anti").unionByName(left.join(again, key, "left_semi").dropDuplicates([key]))


def ngram_groups(docs: DataFrame, t: float = 0.8, n: int = 5, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles (set size), component_id (smallest id reachable by links)."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = stored(sketches(docs, n), "sketches")
    same_set = ["set1", "set2", "n_shingles"]
    full = rows.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    sets = stored(full.groupBy(same_set).agg(F.min("doc_id").alias("node"), F.first("thin").alias("thin"), F.first("bins").alias("bins")), "sets")
    # The smallest id of a set stands for it, whichever id a task has filed it under.
    nodes = full.select("doc_id", *same_set).join(sets.drop("thin", "bins"), same_set)
    # About (1 - t) / (1 + t) * 2 signatures a shingle in each of two bands.
    expected = int((full.agg(F.sum("n_shingles")).first()[0] or 0) * 4.5 * (1 - t) / (1 + t))
    buckets = met(filed(docs, t, n), parts(docs, expected, 1_000_000))
    buckets = buckets.join(nodes.select(F.col("doc_id").alias("node"), F.col("node").alias("head")).distinct(), "node")
    buckets = stored(buckets.select("key", F.col("head").alias("node")).distinct(), "buckets")
    several = buckets.groupBy("key").agg(F.count("*").alias("members")).filter("members > 1")
    buckets = buckets.join(several, "key")
    weight = buckets.groupBy("node").agg(F.sum("members").alias("weight"))
    members = stored(buckets.select("key", "node").join(weight, "node"), "members")
    looks = sets.select("node", "n_shingles", "thin", "bins")

    # Hubs again and again, while a turn closes half of what is open; the exact comparison of the rest follows.
    links = tried = None
    still, rows_open, turn = members.withColumn("group", F.col("node")), members.count(), 0
    while rows_open:
        pairs = stored(hub_pairs(still, looks, tried, t, turn), "hub-pairs")
        found = verified(pairs, docs, t, n)
        links, tried = (found, pairs) if links is None else (links.unionByName(found), tried.unionByName(pairs))
        groups = components(links).select("node", F.col("component").alias("group"))
        grouped = members.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))
        open_keys = grouped.groupBy("key").agg(F.min("group").alias("p"), F.max("group").alias("q")).filter("p < q").select("key")
        still, before, turn = stored(grouped.join(open_keys, "key"), "open"), rows_open, turn + 1
        rows_open = still.count()
        if 2 * rows_open > before:
            break
    if links is None:
        links = tried = members.select(F.col("node").alias("a"), F.col("node").alias("b"))
    if rows_open:
        rest = cross_pairs(still, looks, t).join(tried, ["a", "b"], "left_anti")
        links = links.unionByName(verified(stored(rest, "cross-pairs"), docs, t, n))

    # Equal ids of different sets, and sets of equal documents, tie nodes together as links do.
    same = nodes.filter("doc_id <> node").select(F.col("doc_id").alias("a"), F.col("node").alias("b"))
    final = components(links.unionByName(same)).withColumnRenamed("node", "doc_id")
    return (rows.select("doc_id", "n_shingles").join(final, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
