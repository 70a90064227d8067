"""Quality selection by importance resampling with hashed n-gram models.

Words and symbol runs are hashed into buckets, single ones and pairs (a word next to itself has a bucket of its
own). The raw model counts all documents, and the target model those of them that are good: where a label says so, or
else a first pair of models, whose counts come from a bounded sample of labelled documents. A target model of labelled documents
alone would lack most rare words of the raw one, and hold every unlabelled document for worse than it is. The
log weight of a text is the sum of the log ratios of its buckets, pairs at a fifth; a document weighs as much as its
worst passage of `WINDOW` words, if that is less than the whole, so that a long text cannot hide one. Buckets that
were not counted are neutral.

A fifth of the sample is held out: its labels are used for no count, and fix the cutoff with the fewest errors on it. As many documents as weigh
the cutoff or more are drawn by Gumbel top-k: noise of a small temperature, fixed by id and text, is added to each
log weight, and the k largest stay.

Defined results: a null text is an empty one; it weighs 0. Labels with a null quality or toxicity are not used. A label
belongs to all rows with its id. Equal rows have equal keys, so ties at the threshold all stay. Without labels
of both kinds everything stays. Long texts are counted and weighed whole; an empty table gives an empty one. Extra columns stay as they are; `log_weight`, `key` and `kept` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import slices, stored

BITS = 17  # buckets of words, and as many of pairs
SAMPLE = 50_000  # labelled documents that are read at most, those of smallest hash
PRIOR = 0.5
WINDOW = 64
TEMPERATURE = 0.25
PAIR_SHARE = 0.2
BINS = 4096
TOKEN = re.compile(r"\w+|[^\w\s]+")


def buckets(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs of neighbours."""
    from xxhash import xxh3_64_intdigest

    h = np.array([xxh3_64_intdigest(w) for w in TOKEN.findall(text.lower())], np.uint64)
    shift = np.uint64(64 - BITS)
    pairs = (((h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1]) * np.uint64(0xBF58476D1CE4E5B9)) >> shift).astype(np.int64)
    pairs[h[1:] == h[:-1]] = 0
    return (h >> shift).astype(np.int64), pairs + (1 << BITS)


@dataclass(frozen=True)
class Model:
    ratios: np.ndarray  # log ratio of each bucket
    cutoff: float

    def weight(self, text: str) -> float:
        return self.weigh(*buckets(text))

    def weigh(self, words: np.ndarray, pairs: np.ndarray) -> float:
        if not len(words):
            return 0.0
        single = self.ratios[words].astype(np.float64)
        total = np.concatenate([[0.0], np.cumsum(single)])
        n = min(WINDOW, len(words))
        worst = float((total[n:] - total[:-n]).min())
        return min(worst, float(total[-1] + PAIR_SHARE * self.ratios[pairs].astype(np.float64).sum()))


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log ratio of target over raw, shrunk to none where counts are small."""
    out = np.zeros(2 << BITS, np.float32)
    for part in (slice(0, 1 << BITS), slice(1 << BITS, 2 << BITS)):
        expected = raw[part] * (target[part].sum() / max(1, raw[part].sum()))
        out[part] = np.log((target[part] + PRIOR) / (expected + PRIOR))
    return out


def best_cutoff(weights: np.ndarray, good: np.ndarray) -> float:
    """The cutoff with the fewest errors; everything stays if there is nothing to tell apart."""
    if not good.any() or good.all():
        return float("-inf")
    order = np.argsort(weights, kind="stable")
    w, g = weights[order], good[order]
    errors = np.concatenate([[0], np.cumsum(g)]) + np.concatenate([np.cumsum(~g[::-1])[::-1], [0]])
    at = int(np.argmin(errors))
    if at == 0:
        return float("-inf")
    return float(w[at - 1] + w[at]) / 2 if at < len(w) else float("inf")


def count_buckets(docs: DataFrame, text: str, good: str, model: Model | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of each bucket in all documents, and in the good ones: those `good` says so of, where it is null those that weigh
    the cutoff of `model` or more. Each task adds up its own, so the driver gets one row a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(2 << BITS, np.int64), np.zeros(2 << BITS, np.int64)
        for batch in slices(batches, "text"):
            for t, known in zip(batch.column("text").to_pylist(), batch.column("good").to_pylist()):
                words, pairs = buckets(t or "")
                found = np.concatenate([words, pairs])
                np.add.at(raw, found, 1)
                if known or (known is None and model is not None and model.weigh(words, pairs) >= model.cutoff):
                    np.add.at(target, found, 1)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (used, raw[used], target[used])], ["bucket", "raw", "target"])

    texts = docs.select(F.col(text).alias("text"), F.col(good).alias("good"))
    counted = texts.mapInArrow(count, "bucket long, raw long, target long")
    raw, target = np.zeros(2 << BITS), np.zeros(2 << BITS)
    for r in counted.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).toLocalIterator():
        raw[r[0]], target[r[0]] = r[1], r[2]
    return raw, target


def with_cutoff(model: Model, held_out: DataFrame) -> Model:
    """The model with the cutoff that fits the held-out (id, text, good) best."""
    held = score(held_out, model, "id").select("log_weight", "good").collect()
    return Model(model.ratios, best_cutoff(np.array([r[0] for r in held]), np.array([r[1] for r in held], bool)))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SAMPLE) -> Model:
    """What reaches the driver is bounded: counts by bucket, and the weights of the held-out fifth of `limit` documents."""
    known = labels.filter(F.col("quality").isNotNull() & F.col("toxic").isNotNull() & F.col(key).isNotNull())
    ids = known.groupBy(F.col(key).alias("id")).agg(F.min((F.col("quality") > 0) & (F.col("toxic") == 0)).alias("good"))
    ids = ids.withColumn("at", F.xxhash64("id", F.lit(11))).orderBy("at", "id").limit(limit)
    # At most `limit` rows of a number and two flags: half a megabyte.
    ids = F.broadcast(stored(ids.withColumn("held_out", F.pmod("at", F.lit(5)) == 0).drop("at"), "labelled"))
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sample = texts.join(ids, "id")
    held_out = sample.filter("held_out").select("id", "text", "good")
    first = Model(log_ratios(*count_buckets(sample.filter("NOT held_out"), "text", "good")), float("-inf"))
    first = with_cutoff(first, held_out)
    # A held-out document is to be judged like one without a label.
    marked = texts.join(ids, "id", "left").withColumn("good", F.expr("CASE WHEN NOT held_out THEN good END"))
    whole = Model(log_ratios(*count_buckets(marked, "text", "good", first)), float("-inf"))
    return with_cutoff(whole, held_out)


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Add `log_weight`, and `key`, the log weight with its noise."""
    kept = [f for f in docs.schema.fields if f.name.lower() not in ("log_weight", "key", "kept")]
    schema = T.StructType([*kept, T.StructField("log_weight", T.DoubleType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            weights = [model.weight(t or "") for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in kept), pa.array(weights, pa.float64())], schema.fieldNames())

    drawn = (F.pmod(F.xxhash64(F.col(key), F.col(text), F.lit(29)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return docs.mapInArrow(run, schema).withColumn("key", F.col("log_weight") - TEMPERATURE * F.log(-F.log(drawn)))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """Exact k-th largest value, from counts in ever narrower bins; no task or driver sees more than the bins."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        step = (high - low) / BINS
        if step == 0 or low + step == low:
            break
        place = F.least(F.floor((F.col(column) - low) / step), F.lit(BINS - 1))
        inside = rows.filter(F.col(column).between(low, high)).groupBy(place.alias("bin"))
        found = inside.agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for r in sorted(found.collect(), key=lambda r: -r["bin"]):
            if k <= r["n"]:
                low, high = r["low"], r["high"]
                break
            k -= r["n"]
    return low


def resample(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """All documents with `log_weight` and `kept`: whether they are among the drawn."""
    model = train(docs, labels, key, text)
    scored = stored(score(docs, model, key, text), "weights")
    k = scored.filter(F.col("log_weight") >= F.lit(model.cutoff)).count()
    threshold = kth_largest(scored.select("key"), "key", k) if k else float("inf")
    return scored.withColumn("kept", F.col("key") >= F.lit(threshold)).drop("key")
