"""Mixing sources to target weights by Pareto order sampling.

Each source has a target of words. Target over size is the expected number of copies of each of its documents: the
whole part of it is taken with certainty, the rest is the probability p of one copy more, which differs from source to source.
Documents are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), u fixed by id, source and
size, and taken in that order as long as their words fit into what the target still lacks. A document that does not fit is
passed over, and the search goes on behind it among those that are small enough; `ROUNDS` searches are made. If the
smallest document left brings the words nearer to the target, it is taken at last. So the words taken are of a fixed
number, and the documents a sample of unequal probabilities.

Nothing is sorted whole. Where a source's sample ends is found from sums over `BINS` ranges of its ranks, narrowed until
few documents are in the range; only these are put in order. A source with a third of all documents is as many
partial sums as there are tasks. Sources are numbered by ranges as well, and targets that exceed their limit are found by rounds
of sums over all sources.

Defined results: a null text has no words; a document without words is taken 0 words. Documents without a source are one
source, the last. Repeated rows and ids are documents of their own; equal ones are interchangeable. Without any words all
targets are 0. An empty table gives no rows. Other columns are not read, and cannot clash. Null ids count as empty ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words of the mix to words of all documents
MOST = 2  # copies of a document at most
ROUNDS = 4
BINS = 1024
FEW = 10_000  # documents of a source that are put in order in one task

WORD = "[^\\x20\\x09-\\x0D]+"


def units(docs: DataFrame, key: str, source: str, text: str, row: Column | None = None) -> DataFrame:
    """One (written) row a document: row, key, source, size, and u in (0, 1). `row` numbers it; `name` is its source, never null."""
    row = F.monotonically_increasing_id() if row is None else row
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(row.alias("row"), F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
                       size.alias("size"))
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    seed = F.md5(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("")), name, F.col("size")))
    u = (F.conv(F.substring(seed, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return stored(rows.withColumns({"name": name, "u": u}), "mix-units")


def numbered(sources: DataFrame) -> DataFrame:
    """Add `place`, from 0, in the order of the sources, nulls last, without a sort in one task."""
    order = [F.col("source").isNull(), F.col("source")]
    ranged = sources.repartitionByRange(parts(sources, 0, 1), *order).withColumn("part", F.spark_partition_id())
    ranged = stored(ranged, "mix-sources")
    inner = ranged.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(*order)))
    # One row a range.
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = ranged.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", before).drop("n")
    return inner.join(offsets, "part").withColumn("place", F.col("before") + F.col("at") - 1).drop("part", "at", "before")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, name, source_size, target) from rows of (source, name, source_size).

    Sources share `share` of all words by weight, but none gets more than `most` times its size: what is over goes to the
    others by weight, again and again. Each round is one sum over the sources; the last is the one that finds none above."""
    turns = len(weights)
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("place", F.lit(turns)) + 1).cast("int"))
    rows = stored(numbered(sources).withColumn("weight", pick.cast("long")).drop("place"), "mix-weights")
    limit = F.col("source_size") * float(most)
    words, weight, full = *rows.agg(F.sum("source_size"), F.sum("weight")).first(), 0
    level, words = 0.0, words or 0
    while words and weight:
        # The words that are still to be shared, over the weights that share them.
        level = (share * words - most * full) / weight
        above = limit <= F.col("weight") * F.lit(level)
        now = rows.agg(F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)), F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0))).first()
        if (now[0], now[1]) == (full, weight):
            break
        full, weight = now
    target = F.least(limit, F.col("weight") * F.lit(float(level)))
    return rows.select("source", "name", "source_size", target.alias("target"))


def narrowed(rows: DataFrame, column: str, gaps: DataFrame) -> DataFrame:
    """Per `name` the range of `column` where the running sum of sizes passes `gap`: low, high, the sum before it, and its rows.

    A name whose rows all fit gets none. Narrows until a range has `FEW` rows or one value."""
    state = gaps.select("name", "gap", F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"),
                        F.lit(0).cast("long").alias("before"), F.lit(None).cast("long").alias("n"))
    while True:
        met = rows.join(state, "name").filter(F.col("low").isNull() | F.col(column).between(F.col("low"), F.col("high")))
        wide = F.when(F.col("low").isNull(), F.floor(F.col(column) * BINS)).when(F.col("high") > F.col("low"), F.floor(
            (F.col(column) - F.col("low")) / (F.col("high") - F.col("low")) * BINS)).otherwise(0)
        bins = met.groupBy("name", "gap", "before", F.least(wide, F.lit(BINS - 1)).alias("bin")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        # At most BINS rows a name.
        upto = F.sum("words").over(Window.partitionBy("name").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
        over = bins.withColumn("upto", F.col("before") + upto).filter(F.col("upto") > F.col("gap"))
        first = over.groupBy("name", "gap").agg(F.min_by(F.struct(
            "low", "high", (F.col("upto") - F.col("words")).alias("before"), "n"), "bin").alias("s"))
        state = stored(first.select("name", "gap", "s.low", "s.high", "s.before", "s.n"), "mix-ranges")
        if state.filter((F.col("n") > FEW) & (F.col("low") < F.col("high"))).isEmpty():
            return state


def taken_next(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """The `row`s that are taken from the front of the order (p, tie) of each name, as long as their sum is at most `gap`."""
    ranges = narrowed(rows, "p", gaps)
    bound = gaps.select("name").join(ranges.drop("gap"), "name", "left")
    front = rows.join(bound, "name").filter(F.col("low").isNull() | (F.col("p") < F.col("low"))).select("row")
    met = rows.join(ranges, "name").filter(F.col("p").between(F.col("low"), F.col("high"))).withColumn("rest", F.col("gap") - F.col("before"))
    running = F.sum("size").over(Window.partitionBy("name").orderBy("p", "tie", "row").rowsBetween(Window.unboundedPreceding, 0))
    ordered = met.filter(F.col("n") <= FEW).withColumn("upto", running).filter(F.col("upto") <= F.col("rest")).select("row")
    # So many documents of one rank are copies of one; they are told apart by a random number each.
    copies = met.filter(F.col("n") > FEW).select("row", "name", "size", "tie", "rest")
    again = ranges.filter(F.col("n") > FEW).select("name", (F.col("gap") - F.col("before")).alias("gap"))
    if not again.isEmpty():
        copies = stored(copies, "mix-copies")
        ties = narrowed(copies, "tie", again)
        front = front.unionByName(copies.join(again.select("name").join(ties.select("name", "low"), "name", "left"), "name").filter(
            F.col("low").isNull() | (F.col("tie") < F.col("low"))).select("row"))
        inner = copies.join(ties.drop("gap"), "name").filter(F.col("tie").between(F.col("low"), F.col("high")))
        running = F.sum("size").over(Window.partitionBy("name").orderBy("tie", "row").rowsBetween(Window.unboundedPreceding, 0))
        ordered = ordered.unionByName(inner.withColumn("upto", F.col("before") + running).filter(F.col("upto") <= F.col("rest")).select("row"))
    return front.unionByName(ordered)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, key: str = "doc_id",
        source: str = "source", text: str = "text", row: Column | None = None) -> DataFrame:
    """One row per document: row, key, source, size, source_size, target, copies (0 to `most`) and taken, the words of its copies."""
    rows = units(docs, key, source, text, row)
    sources = rows.groupBy("name").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    aims = stored(targets(sources, weights, share, most), "mix-targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sure = F.floor(expected).cast("long")
    plan = stored(aims.withColumns({"sure": sure, "p": expected - sure, "gap": F.col("target") - sure * F.col("source_size")}), "mix-plan")

    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    drawn = rows.filter("size > 0").select("row", "name", "size", "u").join(plan.filter("gap > 0").select("name", "p"), "name")
    # Odds become a number from 0 to 1 in the same order, which is evenly spread enough for ranges.
    tie = (F.pmod(F.xxhash64("row"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    left = stored(drawn.select("row", "name", "size", (odds / (1 + odds)).alias("p"), tie.alias("tie")), "mix-order")
    gaps, chosen = plan.filter("gap > 0").select("name", "gap"), None
    for _ in range(ROUNDS):
        fitting = left.join(gaps, "name").filter("size <= gap").drop("gap")
        found = stored(taken_next(fitting, gaps).withColumn("more", F.lit(1)), "mix-taken")
        took = left.join(found, "row").groupBy("name").agg(F.sum("size").alias("words"))
        gaps = stored(gaps.join(took, "name", "left").select("name", (F.col("gap") - F.coalesce("words", F.lit(0))).alias("gap")), "mix-gaps")
        left = stored(left.join(found, "row", "left_anti"), "mix-order")
        chosen = found if chosen is None else chosen.unionByName(found)
    # One document more where that is nearer.
    least = left.groupBy("name").agg(F.min(F.struct("size", "p", "tie", "row")).alias("s"))
    last = least.join(gaps, "name").filter(F.col("s.size") < 2 * F.col("gap")).select("s.row", F.lit(1).alias("more"))
    copies = (F.col("sure") + F.coalesce("more", F.lit(0))).cast("long")
    full = rows.join(plan.select("name", "source_size", "target", "sure"), "name").join(chosen.unionByName(last), "row", "left")
    return full.select("row", F.col("key").alias(key), F.col("source").alias(source), "size", "source_size", "target",
                       copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def copied(docs: DataFrame, key: str = "doc_id", **how) -> DataFrame:
    """The mix itself: each row of docs as often as it is taken."""
    fixed = stored(docs.withColumn("mix_row", F.monotonically_increasing_id()), "mix-documents")
    plan = mix(fixed, key=key, row=F.col("mix_row"), **how).filter("copies > 0").select(F.col("row").alias("mix_row"), "copies")
    again = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    return fixed.join(plan.withColumnRenamed("copies", "mix_copies"), "mix_row").withColumn("mix_copies", again).drop("mix_row", "mix_copies")


def sql(weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> str:
    """The mix of the documents table in DuckDB's SQL."""
    rounds = "".join(f"""
l{i} AS (SELECT l.name, l.row, l.size, l.pr FROM l{i - 1} l ANTI JOIN t{i - 1} USING (row)),
g{i} AS (SELECT g.name, gap - coalesce(words, 0) AS gap FROM g{i - 1} g LEFT JOIN (
    SELECT name, sum(size)::BIGINT AS words FROM l{i - 1} JOIN t{i - 1} USING (row) GROUP BY name) USING (name)),
t{i} AS (SELECT row FROM (SELECT row, gap, sum(size) OVER (PARTITION BY name ORDER BY pr, row) AS upto
    FROM l{i} JOIN g{i} USING (name) WHERE size <= gap) WHERE upto <= gap),""" for i in range(1, ROUNDS + 1))
    taken = " UNION ALL ".join(f"SELECT row FROM t{i}" for i in range(1, ROUNDS + 1))
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source, CASE WHEN source IS NULL THEN '' ELSE '=' || source END AS name,
    coalesce(len(regexp_extract_all(text, '{WORD}')), 0)::BIGINT AS size FROM documents),
r AS (SELECT *, (('0x' || substr(md5(concat_ws(':', coalesce(doc_id::VARCHAR, ''), name, size::VARCHAR)), 1, 13))::BIGINT::DOUBLE + 0.5::DOUBLE)
    / {1 << 52}::DOUBLE AS u FROM d),
s AS (SELECT name, any_value(source) AS source, sum(size)::BIGINT AS source_size FROM r GROUP BY name),
w AS (SELECT *, ([{', '.join(map(str, weights))}])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1]::BIGINT AS weight FROM s),
k AS (SELECT *, {most}.0::DOUBLE * source_size / weight AS ratio,
    sum(source_size) OVER ()::BIGINT AS words,
    coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS full_before,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS rest
    FROM w WINDOW o AS (ORDER BY {most}.0::DOUBLE * source_size / weight, name)),
v AS (SELECT coalesce(max(({share}::DOUBLE * words - {most} * full_before) / rest) FILTER (
    ratio > ({share}::DOUBLE * words - {most} * full_before) / rest), 0) AS level FROM k),
a AS (SELECT name, source_size, least({most}.0::DOUBLE * source_size, weight * level) AS target FROM w, v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected FROM a),
p AS (SELECT *, floor(expected)::BIGINT AS sure, expected - floor(expected) AS p, target - floor(expected) * source_size AS gap FROM e),
l0 AS (SELECT name, row, size, ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) AS pr
    FROM r JOIN p USING (name) WHERE size > 0 AND gap > 0),
g0 AS (SELECT name, gap FROM p WHERE gap > 0),
t0 AS (SELECT row FROM l0 WHERE false),{rounds}
z AS (SELECT l.* FROM l{ROUNDS} l ANTI JOIN t{ROUNDS} USING (row)),
h AS (SELECT g.name, gap - coalesce(words, 0) AS gap FROM g{ROUNDS} g LEFT JOIN (
    SELECT name, sum(size)::BIGINT AS words FROM l{ROUNDS} JOIN t{ROUNDS} USING (row) GROUP BY name) USING (name)),
f AS (SELECT row FROM (SELECT row, size, gap FROM z JOIN h USING (name) QUALIFY row_number() OVER (PARTITION BY name ORDER BY size, pr, row) = 1)
    WHERE size < 2 * gap),
m AS (SELECT row, 1 AS more FROM ({taken} UNION ALL SELECT row FROM f))
SELECT doc_id, size, source_size, target, (size * (sure + coalesce(more, 0)))::BIGINT AS taken
FROM r JOIN p USING (name) LEFT JOIN m USING (row)
"""
