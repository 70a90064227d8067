"""Exact top-k by inner product with the three-phase uniform threshold algorithm.

Vectors are cut into slabs of dimensions, and each slab scores candidates on its own. Phase 1: each slab lists its best k per
query. A task holds all slabs of its blocks, so it gives out the k best whole scores of listed objects; the k-th best of all is a safe
bound. The bound, less what the other slabs could add at least, is cut evenly into one threshold per slab. Phase 2: the bound and
the thresholds go with the query blocks, and the objects are collected that reach a slab's threshold and with all slabs the
bound; what stays below all thresholds cannot reach it. The k-th best of the collected ones is the last bound. Phase 3: what
reaches it is scored exactly.

Components x become floor(scale * x). Equal integer vectors are one candidate, which carries the k + 1 smallest ids:
more of them can never be among a query's best. Queries and candidates are packed into blocks of bounded size, and each
pair of blocks is one unit of work; a query block meets all candidate blocks, as is asked for. Query blocks are broadcast in waves of
bounded size to the tasks that read the candidates.

Defined results: vectors that are null, empty or hold a null or non-finite component take no part. Vectors of different
lengths are compared only with their own length. Ids that occur in several rows are separate candidates, and a query is
each distinct (id, vector); its own id is no candidate. Ties go to the smaller id. Scores are 64-bit integers; a table
whose products could leave 2^53 is scored with integers of any size, and scores beyond 64 bits are clipped to them.
An empty table, or one without a sound vector, gives no rows. Only key and vector are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, stored, total_bytes
from ledgerloom.session import scratch_path

SLABS = 2
CANDIDATES = 1024  # vectors in a candidate block
QUERIES = 512  # vectors in a query block
WAVE = 16 << 20  # bytes of query blocks that meet the candidates at a time


def quantized(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, v): the rows that take part, with integral components."""
    x = F.transform(vector, lambda c: c.cast("double") * scale)
    sound = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))
    # floor() makes a long; doubles beyond its range are integral as they are.
    whole = F.transform(x, lambda c: F.when(F.abs(c) < 9e15, F.floor(c).cast("double")).otherwise(c))
    return rows.filter(sound & (F.size(vector) > 0) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), whole.alias("v"))


def blocks(rows: DataFrame, size: int, label: str) -> DataFrame:
    """Rows (no, d, v, and perhaps cuts) packed to about `size` vectors of one length a block."""
    count = max(1, -(-rows.count() // size))
    cuts = "cuts" in rows.columns

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        out = {"block": part["block"].iloc[:1], "d": part["d"].iloc[:1], "numbers": [part["no"].to_numpy().tobytes()]}
        for c in ("v", "cuts") if cuts else ("v",):
            out[c] = [np.array(part[c].tolist(), "<f8").tobytes()]
        return pd.DataFrame(out)

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("no"), F.lit(count))).repartition(parts(rows, count, 16), "block")
    schema = "block long, d long, numbers binary, v binary" + ", cuts binary" * cuts
    return stored(dealt.groupBy("block", "d").applyInPandas(pack, schema), label)


def halves(d: int) -> list[slice]:
    edges = np.linspace(0, d, min(SLABS, d) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def unpack(vectors: bytes, numbers: bytes, d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(vectors, "<f8").reshape(-1, d), np.frombuffer(numbers, np.int64)


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles while all sums stay below 2^53, else in integers of any size."""
    bound = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if bound < 2.0**53:
        return a @ b.T
    ints = [[int(x) for x in row] for row in b]
    return np.array([[sum(int(p) * q for p, q in zip(x, y)) for y in ints] for x in a], object).reshape(len(a), len(b))


def exact(score) -> int:
    return max(-(2**63), min(2**63 - 1, int(score)))


def met(candidates: DataFrame, queries: DataFrame, work: Callable, schema: str, label: str) -> DataFrame:
    """What `work` makes of each query block next to each candidate block of its dimensions, written down.

    Query blocks go to the tasks that read candidates in waves of about `WAVE` bytes, one wave at a time, so that what is sent at
    once stays as it is when the tables grow, and no block is copied for each block that it meets."""
    spark, path = queries.sparkSession, scratch_path(queries.sparkSession, label)
    sent = [c for c in ("v", "cuts") if c in queries.columns]
    waves = max(1, -(-total_bytes(queries.select(F.concat(*sent).alias("sent")), "sent") // WAVE))
    asked = queries.select("d", F.col("block").alias("q_block"), F.col("numbers").alias("q_numbers"), F.col("v").alias("q_v"), *sent[1:])
    for wave in range(waves):
        some = F.broadcast(asked.where(F.pmod("q_block", F.lit(waves)) == wave))
        candidates.join(some, "d").mapInPandas(work, schema).write.parquet(f"{path}/wave={wave}")
    return spark.read.schema(schema).parquet(path).drop("wave")


def slab_scores(q: np.ndarray, x: np.ndarray, d: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Scores by slab, whole scores, and by how much these may be off: not at all while they stay below 2^53."""
    scores = [dots(q[:, cols], x[:, cols]).astype(float) for cols in halves(d)]
    size = sum(np.abs(s) for s in scores)
    return scores, sum(scores), np.where(size < 2.0**53, 0.0, size * 1e-12)


def listed(scores: list[np.ndarray], low: np.ndarray, xs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and `low` of the best k objects of each slab; of one that both list, the second is -inf."""
    top = np.concatenate([np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k] for s in scores], axis=1)
    top.sort(axis=1)
    found = np.take_along_axis(low, top, 1)
    found[:, 1:][top[:, 1:] == top[:, :-1]] = -np.inf
    return xs[top], found


def local_lists(k: int):
    """Phase 1: per slab the best k objects of each query in a block. Of those of all blocks that a task reads, the k whose whole score is
    the most at least, as no others of them can set the bound; and the least score of each slab."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], tuple] = {}
        for batch in batches:
            for r in batch.itertuples():
                x, xs = unpack(r.v, r.numbers, r.d)
                q, qs = unpack(r.q_v, r.q_numbers, r.d)
                scores, total, off = slab_scores(q, x, r.d)
                ids, low = listed(scores, total - off, xs, k)
                least = np.stack([s.min(1) for s in scores], 1)
                if (r.d, r.q_block) in held:
                    _, old_ids, old_low, old_least = held[r.d, r.q_block]
                    ids, low, least = np.hstack([old_ids, ids]), np.hstack([old_low, low]), np.minimum(old_least, least)
                best = np.lexsort((ids, -low), axis=1)[:, :k]
                held[r.d, r.q_block] = qs.copy(), np.take_along_axis(ids, best, 1), np.take_along_axis(low, best, 1), least
        for qs, ids, low, least in held.values():
            sound = low > -np.inf
            yield pd.DataFrame({"q": qs, "x": [i[s] for i, s in zip(ids, sound)], "low": [w[s] for w, s in zip(low, sound)], "least": list(least)})

    return run


def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Phase 2: every object at or above a slab's threshold whose whole score can reach the bound."""
    for batch in batches:
        for r in batch.itertuples():
            x, xs = unpack(r.v, r.numbers, r.d)
            q, qs = unpack(r.q_v, r.q_numbers, r.d)
            scores, total, off = slab_scores(q, x, r.d)
            cuts = np.frombuffer(r.cuts, "<f8").reshape(len(qs), -1)  # one a slab, and the bound
            reach = np.logical_or.reduce([s >= cuts[:, slab, None] for slab, s in enumerate(scores)])
            i, j = np.nonzero(reach & (total + off >= cuts[:, -1, None]))
            if len(i):
                yield pd.DataFrame({"q": qs[i], "x": xs[j], "low": (total - off)[i, j], "high": (total + off)[i, j]})


def bounds(found: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """(q, bound): the k-th largest `low` of each query's objects (q, x, low), an object counting for each of its ids."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("low"), "x"))
    best = found.select("q", "x", "low").distinct().withColumn("place", rank).filter(F.col("place") <= k)
    line = Window.partitionBy("q").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    held = best.join(sizes, "x").withColumn("held", F.sum("size").over(line)).filter(F.col("held") >= k)
    return held.groupBy("q").agg(F.max("low").alias("bound"))


def top_k(rows: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: int = 256) -> DataFrame:
    """(query_id, rank, id, score): the k best other rows of each row that `is_query` holds for."""
    ready = quantized(rows, key, vector, scale)
    asked = quantized(rows.filter(is_query), key, vector, scale).distinct()
    # Up to k + 1 ids of each vector, ranked within a task before they are shuffled.
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    few = ready.withColumn("place", place).filter(F.col("place") <= k + 1)
    classes = few.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    # Distinct vectors are numbered by a hash that is checked to be one.
    classes = stored(classes.select(F.xxhash64("v").alias("no"), F.size("v").cast("long").alias("d"), "v", "ids"), "classes")
    if classes.groupBy("no").count().filter("count > 1").limit(1).count():
        raise RuntimeError("two vectors share a hash")
    wanted = stored(asked.select(F.col("id").alias("query_id"), F.xxhash64("v").alias("q"), F.size("v").cast("long").alias("d"), "v"), "queries")
    distinct = wanted.groupBy("q").agg(F.first("d").alias("d"), F.first("v").alias("v")).withColumnRenamed("q", "no")
    x_blocks = blocks(classes, CANDIDATES, "candidate-blocks")
    q_blocks = blocks(distinct, QUERIES, "query-blocks")

    # Phase 1. k + 1 entries, as one of them may be the query itself.
    sizes = classes.select(F.col("no").alias("x"), F.size("ids").alias("size"))
    lists = met(x_blocks, q_blocks, local_lists(k + 1), "q long, x array<long>, low array<double>, least array<double>", "local-lists")
    found = lists.select("q", F.inline(F.arrays_zip("x", "low")))
    least = lists.select("q", F.posexplode("least").alias("slab", "least")).groupBy("q", "slab").agg(F.min("least").alias("least"))
    floor = least.groupBy("q").agg(F.sum("least").alias("floor"), F.count("*").alias("slabs"))
    # Half a unit below, and some for the rounding of very large scores. Without a bound all objects are collected.
    share = F.col("least") + (F.col("bound") - F.col("floor")) / F.col("slabs") - 0.5 - (
        F.abs("least") + F.abs("floor") + F.abs("bound")) * 1e-12
    none = F.lit(float("-inf"))
    cuts = least.join(floor, "q").join(bounds(found, sizes, k + 1), "q", "left").select(
        "q", "slab", F.coalesce(share, none).alias("cut"), F.coalesce("bound", none).alias("bound"))
    cuts = cuts.groupBy("q", "bound").agg(F.array_sort(F.collect_list(F.struct("slab", "cut"))).alias("c"))
    cuts = cuts.select("q", F.concat(F.transform("c", lambda c: c["cut"]), F.array("bound")).alias("cuts"))

    # Phase 2: the cutoffs travel with the query blocks, whose size is bounded.
    cut_blocks = blocks(distinct.join(stored(cuts, "cuts").withColumnRenamed("q", "no"), "no"), QUERIES, "cut-blocks")
    collected = met(x_blocks, cut_blocks, entries, "q long, x long, low double, high double", "entries")
    sure = bounds(collected, sizes, k + 1)
    left = collected.join(sure, "q", "left").filter(F.col("bound").isNull() | (F.col("high") >= F.col("bound")))

    # Phase 3: exact scores of what is left.
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            p, q = b["v"].tolist(), b["w"].tolist()
            b["score"] = [exact(dots(x[None], y[None])[0, 0]) for x, y in zip(map(np.asarray, p), map(np.asarray, q))]
            yield b[["q", "ids", "score"]]

    pairs = left.select("q", "x").join(classes.select(F.col("no").alias("x"), "v", "ids"), "x")
    pairs = pairs.join(distinct.select(F.col("no").alias("q"), F.col("v").alias("w")), "q").select("q", "ids", "v", "w")
    scored = pairs.mapInPandas(score, "q long, ids array<long>, score long")
    # The k + 1 best ids of each distinct query hold the k best of every id that asks.
    each = scored.select("q", "score", F.explode("ids").alias("id"))
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))
    each = each.withColumn("place", rank).filter(F.col("place") <= k + 1).drop("place")
    answers = wanted.select("query_id", "q").join(each, "q").filter("id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "id"))
    return answers.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")
