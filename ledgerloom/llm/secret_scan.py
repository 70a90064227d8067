"""Secrets in texts: fixed patterns, and long tokens that look random to two character models.

Each model is a Markov chain over the token alphabet: one of random strings, one of ordinary identifiers, trained
from samples among the labelled documents. The labels at hand tell quality and toxicity, not secrets, so they choose the documents
and the base patterns choose the class. A token is added as a secret if its log-likelihood ratio per step reaches `margin`. All
work is in DataFrame functions: matches and the text between them give every position.

Defined results: a null text is an empty text without spans; an empty table gives no rows. The columns base, spans and has_*
are the operator's own. Positions are code points, the end is exclusive. Repeated rows are judged each for itself. Every token is
judged, however long, in time linear in its length; one that a base span covers whole is not added, one that goes
beyond it is. A class without samples is uniform.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in the order that breaks ties; the part whose length counts, and the
# least length of it.
KINDS = {
    "assign": ("((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}
# What a text must hold for a kind to be looked for.
HINTS = {
    "assign": "(?i)passw|secret|token|api_?key",
    "access": "AKIA[A-Z0-9]{16}",
    "hex": "[0-9a-f]{24}",
}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = "[A-Za-z0-9+/_=-]+"
TOKEN_LENGTH = 20  # shortest token that the models judge
MARGIN = 0.5  # nats per step: ten for the shortest token
SAMPLE_DOCS = 5000  # labelled documents that training reads at most

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def located(text: Column, pattern: str, group: int, least: int, rank: int, kind: str, also: Callable[[Column], Column] | None = None) -> Column:
    """Spans of the leftmost, non-overlapping matches whose group is long enough; `also` is asked of these matches."""
    hits = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(1))
    inner = F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(group + 1))
    gaps = F.split(text, pattern, -1)
    # A kind keeps few matches, but hex runs are everywhere: sums are taken over all, the list over those kept.
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        end = begin + x["size"]
        span = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        old = F.coalesce(acc["spans"], F.array().cast(SPAN))
        return F.struct(end.alias("at"), F.when(x["good"], F.concat(old, F.array(span))).otherwise(acc["spans"]).alias("spans"))

    def good(hit: Column, inner: Column) -> Column:
        long = F.length(inner) >= least
        return long if also is None else F.when(long, also(hit)).otherwise(F.lit(False))

    zipped = F.zip_with(
        F.zip_with(hits, inner, lambda h, i: F.struct(F.length(h).alias("size"), good(h, i).alias("good"))),
        F.transform(gaps, lambda g: F.length(g)),
        lambda m, g: F.struct(g.alias("gap"), m["size"].alias("size"), m["good"].alias("good")),
    )
    # The last gap has no match behind it.
    matches = F.filter(zipped, lambda m: m["size"].isNotNull())
    return F.coalesce(F.aggregate(matches, start, step)["spans"], F.array().cast(SPAN))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add `base`: spans (start, rank, end, kind) of the fixed patterns, in order."""
    body = F.coalesce(F.col(text), F.lit(""))
    hinted = docs.withColumns({f"has_{k}": body.rlike(hint) for k, hint in HINTS.items()})
    lists = [
        F.when(F.col(f"has_{k}"), located(body, *KINDS[k], rank, k)).otherwise(F.array().cast(SPAN))
        for rank, k in enumerate(KINDS)
    ]
    return hinted.withColumn("base", F.array_sort(F.concat(*lists))).drop(*(f"has_{k}" for k in KINDS))


def code(char: Column) -> Column:
    return F.instr(F.lit(ALPHABET), char)


def steps_of(token: Column) -> Column:
    """The overlapping pairs of characters of a token, as numbers. The token is cut into characters once."""
    width, n = len(ALPHABET) + 1, F.length(token)
    codes = F.transform(F.slice(F.split(token, ""), F.lit(1), n), code)
    return F.zip_with(F.slice(codes, F.lit(1), n - 1), F.slice(codes, F.lit(2), n - 1), lambda a, b: a * width + b)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SAMPLE_DOCS) -> list[float]:
    """Log-likelihood ratios of random over ordinary for each pair of characters.

    Reads at most `limit` labelled documents, those of smallest hash: values of base spans are the random class, other
    words of eight or more letters, digits and joints the ordinary one. The counts that reach the driver are bounded
    by the square of the alphabet."""
    ids = labels.select(F.col(key)).distinct().orderBy(F.xxhash64(key), key).limit(limit)
    sample = base_spans(docs.join(ids, key, "left_semi").select(F.coalesce(text, F.lit("")).alias("text")))
    values = F.transform("base", lambda s: F.substr(F.col("text"), s["start"] + 1, s["end"] - s["start"]))
    random = sample.select(F.explode(values).alias("value")).select(
        F.lit(1).alias("random"), F.explode(F.regexp_extract_all("value", F.lit("([A-Za-z0-9+/_=-]+)"))).alias("token"))
    random = random.filter(F.length("token") >= 12)
    words = F.regexp_extract_all("text", F.lit(r"(?<![\w+/=-])([A-Za-z_][A-Za-z_0-9-]{7,})(?![\w+/=-])"))
    plain = sample.filter(F.size("base") == 0).select(F.lit(0).alias("random"), F.explode(words).alias("token"))
    pairs = random.unionByName(plain).select("random", F.explode(steps_of(F.col("token"))).alias("pair"))
    width = len(ALPHABET) + 1
    counts = [[1.0] * width * width for _ in range(2)]
    for r in pairs.groupBy("random", "pair").count().collect():
        counts[r["random"]][r["pair"]] += r["count"]
    ratios = []
    for at in range(width * width):
        row = at // width * width
        p, q = ((c[at] / sum(c[row : row + width])) for c in (counts[1], counts[0]))
        ratios.append(math.log(p / q))
    return ratios


def find_secrets(docs: DataFrame, ratios: list[float], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """Add `base`, and `spans`: the base spans and those that the models add (kind `markov`), in order."""
    body = F.coalesce(F.col(text), F.lit(""))
    table = F.array(*(F.lit(float(r)) for r in ratios))
    hinted = base_spans(docs, text).withColumn("has_token", body.rlike(TOKEN[:-1] + f"{{{TOKEN_LENGTH}}}"))

    def random(token: Column) -> Column:
        score = F.aggregate(steps_of(token), F.lit(0.0), lambda a, p: a + F.element_at(table, p + 1))
        return score >= margin * (F.length(token) - 1)

    tokens = F.when(F.col("has_token"), located(body, TOKEN, 0, TOKEN_LENGTH, len(KINDS), "markov", random)).otherwise(F.array().cast(SPAN))

    def further(s: Column) -> Column:
        return ~F.exists("base", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    return hinted.withColumn("spans", F.array_sort(F.concat("base", F.filter(tokens, further)))).drop("has_token")


def redact(found: DataFrame, text: str = "text", marker: str = "[SECRET]") -> DataFrame:
    """The text with each run of overlapping spans replaced by the marker."""
    body = F.coalesce(F.col(text), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        fresh = F.concat(acc["out"], F.substr(body, acc["at"] + 1, s["start"] - acc["at"]), F.lit(marker))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substr(body, acc["at"] + 1, F.length(body)))

    clean = F.when(F.size("spans") > 0, F.aggregate("spans", start, step, finish)).otherwise(F.col(text))
    return found.withColumn(text, clean)


def count_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind))


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
