"""Document fingerprints of spot signatures: chains of content words behind common words.

A text is lower-cased and cut into words of letters and digits. Each content word that follows a run of common
words (the anchors) starts a chain of `chain` content words; the set of the chains' digests is the fingerprint.
Likeness is the Jaccard likeness of two sets. All work is in DataFrame functions.

`near_pairs` joins fingerprints of a table: sets are partitioned by length, so that only partitions whose lengths
allow the threshold meet, and candidates are pruned by the rarest signatures that a partner must share before sets
are compared.

Defined results: a null text is an empty one. A text without anchors starts a chain at every word; a text without
chains has one signature of its own, an empty text has none. Two empty sets are alike (1), an empty and another are
not (0). A long text is taken whole, as one row's value. Repeated rows each give a row, an empty table none. `against_edits`
reads key and text alone, so other columns cannot clash; `fingerprints` keeps them and replaces `signatures` and `fingerprint`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import parts, stored, total_bytes

# Common words of English, French, German and Spanish.
ANCHORS = (
    "a an and are as at be been by for from had has have he her his in is it its not of on or she that the their "
    "there they this to was were which with "
    "au aux ce ces dans de des du elle en est et il la le les leur mais ne ou par pas pour que qui sa se ses son "
    "sont sur un une vous "
    "als am auch auf aus bei das dem den der des die ein eine einen einer es ist mit nach nicht oder sich sie und "
    "von war wie zu zum zur "
    "al como con del el ella entre era esta las lo los más no para pero por ser si sin sobre su sus una y"
).split()
CHAIN = 2
DIGITS = 8
PART = 8 << 20  # bytes of text in a partition
BOUNDS = 40  # sampled places for each range


def patterns() -> tuple[str, str]:
    """What separates words, and an anchor between its spaces. Neither repeats a group, which Java matches by recursion."""
    return r"[^\p{L}\p{N}]+", " (?:" + "|".join(dict.fromkeys(ANCHORS)) + ") "


def bound(value: Column, use) -> Column:
    """use(value) with the value computed once, though it occurs several times or in a lambda."""
    return F.transform(F.array(value), use)[0]


def signatures(text: Column, chain: int = CHAIN) -> Column:
    """The sorted set of signatures of a text without nulls."""
    other, anchors = patterns()
    # Two spaces between words, so that each has its own; then an anchor is a mark in front of the next word.
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.lower(text), other, "  "), F.lit(" "))

    def own(marked: Column, words: Column) -> Column:
        every = ~F.contains(marked, F.lit("~"))

        def chained(w: Column, i: Column) -> Column:
            rest = [F.try_element_at(words, (i + k).cast("int")) for k in range(2, chain + 1)]
            return F.when(every | F.startswith(w, F.lit("~")), F.trim(F.translate(F.concat_ws(" ", w, *rest), "~", "")))

        chains = F.filter(F.transform(words, chained), lambda c: c.isNotNull() & (c != ""))
        return F.array_distinct(F.transform(chains, lambda c: F.substring(F.md5(c), 1, DIGITS)))

    found = bound(
        F.replace(F.regexp_replace(spaced, anchors, " ~ "), F.lit("~  "), F.lit("~")),
        lambda marked: bound(F.split(F.trim(marked), "  "), lambda words: own(marked, words)),
    )
    whole = F.when(text == "", F.array().cast("array<string>")).otherwise(F.array(F.substring(F.md5(text), 1, DIGITS)))
    return F.array_sort(bound(found, lambda f: F.when(F.size(f) > 0, f).otherwise(whole)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def fingerprints(docs: DataFrame, text: str = "text", chain: int = CHAIN) -> DataFrame:
    """Add `signatures` and `fingerprint`, the signatures in one string."""
    with_sets = docs.withColumn("signatures", signatures(F.coalesce(F.col(text), F.lit("")), chain))
    return with_sets.withColumn("fingerprint", F.array_join("signatures", " "))


def near_pairs(found: DataFrame, threshold: float = 0.8, key: str = "doc_id") -> DataFrame:
    """(a, b, likeness) of fingerprints at or above the threshold; equal fingerprints are one class, (a, b) its
    smallest ids. Classes meet over a signature from the rarest of each that a partner cannot all miss, in partitions
    of lengths that allow the threshold."""
    sets = found.filter(F.size("signatures") > 0).groupBy("signatures").agg(F.min(key).alias("id"))
    sets = stored(sets.withColumn("n", F.size("signatures")), "spot-sets")
    often = sets.select(F.explode("signatures").alias("s")).groupBy("s").count()
    ranked = sets.select("id", "n", F.explode("signatures").alias("s")).join(often, "s")
    need = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    place = F.row_number().over(Window.partitionBy("id").orderBy("count", "s"))
    rare = ranked.withColumn("place", place).filter(F.col("place") <= need)
    part = F.floor(F.log("n") / -math.log(threshold) + 1e-9)
    small = rare.select(F.col("id").alias("a"), F.col("n").alias("na"), "s", F.explode(F.array(part, part + 1)).alias("p"))
    large = rare.select(F.col("id").alias("b"), F.col("n").alias("nb"), "s", part.alias("p"))
    fits = (F.col("na") <= F.col("nb")) & (F.col("na") >= F.col("nb") * threshold - 1e-9)
    once = (F.col("na") < F.col("nb")) | (F.col("a") < F.col("b"))
    meet = small.join(large, ["s", "p"]).filter(fits & once & (F.col("a") != F.col("b"))).select("a", "b").distinct()
    left = sets.select(F.col("id").alias("a"), F.col("signatures").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("signatures").alias("y"))
    scored = meet.join(left, "a").join(right, "b").select("a", "b", likeness(F.col("x"), F.col("y")).alias("likeness"))
    return scored.filter(F.col("likeness") >= threshold)


def range_of(rows: DataFrame, n: int) -> Column:
    """The range of a row's `at` in descending order, of about `n` that are alike in size. The bounds come from `BOUNDS` sampled
    places for each range, which reach the driver; found by halving."""
    share = min(1.0, BOUNDS * n / max(1, rows.count()))
    places = [r["at"] for r in rows.select("at").sample(share, 7).orderBy(F.col("at").desc()).collect()]
    cuts = list(dict.fromkeys(places[len(places) * i // n] for i in range(1, n))) if places else []
    if not cuts:
        return F.lit(0)
    kind = rows.schema["at"].dataType
    bounds = F.array(*(F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(c, kind))) for c in cuts))
    halves = F.array(*(F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))))
    return F.aggregate(halves, F.lit(0), lambda at, step: F.when(
        F.coalesce(F.get(bounds, at + step - 1) >= F.col("at"), F.lit(False)), at + step).otherwise(at))


def against_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", chain: int = CHAIN) -> DataFrame:
    """Per document its fingerprint and that of an edited copy, with their likeness and that to the next document.

    The edit replaces the last third of the code points by the first ones of the next document in descending order of
    the key (nulls last, equal keys by their text; after the last comes the first). The order is laid out by ranges between
    sampled bounds, and each range's last row takes the first of the next range, so no task sees more than a range. The
    bounds are fixed before any job uses them: a row has the same range in all of them.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = parts(docs, total_bytes(docs, text), PART)
    rows = rows.withColumn("at", F.struct("key", F.xxhash64("text").alias("hash")))
    ranged = rows.withColumn("part", range_of(rows, n))
    # Of each range the places of both ends, then their texts alone.
    edges = ranged.groupBy("part").agg(F.max("at").alias("head_at"), F.min("at").alias("last_at"))
    ends = stored(ranged.join(F.broadcast(edges), "part").filter("at = head_at OR at = last_at"), "range-ends")
    inner = ranged.select("key", "text", "at", "part").repartition(n, "part").withColumn("signatures", signatures(F.col("text"), chain))
    line = Window.partitionBy("part").orderBy(F.col("at").desc(), "text")
    inner = inner.withColumn("next", F.lead(F.struct("text", "signatures")).over(line)).filter("next IS NOT NULL").drop("at")

    firsts = ends.filter("at = head_at").groupBy("part").agg(F.min("text").alias("head"))
    # As many rows as there are ranges, two numbers each.
    whole = Window.partitionBy(F.lit(0)).orderBy("part")
    follow = firsts.select("part").withColumn("follows", F.lead("part").over(whole))
    follow = follow.withColumn("follows", F.coalesce("follows", F.min("part").over(Window.partitionBy(F.lit(0)))))
    heads = follow.join(firsts.withColumnRenamed("part", "follows"), "follows").select("part", "head")
    lasts = ends.filter("at = last_at").groupBy("part").agg(F.first("key").alias("key"), F.max("text").alias("text")).join(heads, "part")
    lasts = lasts.withColumn("signatures", signatures(F.col("text"), chain)).select(
        "key", "text", "part", "signatures",
        F.struct(F.col("head").alias("text"), signatures(F.col("head"), chain).alias("signatures")).alias("next"))

    both = inner.unionByName(lasts)
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), size - third), F.substr("next.text", F.lit(1), third))
    return (both.withColumn("n_chars", size.cast("long"))
            .withColumn("edited", edited)
            .withColumn("edited_signatures", signatures(F.col("edited"), chain))
            .select(F.col("key").alias(key), "n_chars", "edited", "signatures", "edited_signatures",
                    likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
                    likeness(F.col("signatures"), F.col("next.signatures")).alias("near_next")))


def sql(chain: int = CHAIN) -> str:
    """The query of `against_edits` as DuckDB SQL."""
    other, anchors = patterns()

    def marked(t: str) -> str:
        return (f"replace(regexp_replace(' ' || regexp_replace(lower({t}), '{other}', '  ', 'g') || ' ', "
                f"'{anchors}', ' ~ ', 'g'), '~  ', '~')")

    def sets(t: str, m: str) -> str:
        rest = ", ".join(f"c[i + {k}]" for k in range(1, chain))
        return (f"""(SELECT CASE WHEN len(f) > 0 THEN list_sort(f) WHEN {t} = '' THEN []::VARCHAR[]
                ELSE [substr(md5({t}), 1, {DIGITS})] END FROM (SELECT list_distinct([substr(md5(x), 1, {DIGITS}) FOR x IN
                list_transform(c, lambda w, i: CASE WHEN NOT contains({m}, '~') OR starts_with(w, '~')
                THEN trim(replace(concat_ws(' ', w, {rest}), '~', ''), ' ') END) IF x IS NOT NULL AND x <> '']) f
                FROM (SELECT string_split(trim({m}, ' '), '  ') c)))""")

    def jaccard(a: str, b: str) -> str:
        both = f"len(list_intersect({a}, {b}))"
        return f"CASE WHEN len({a}) = 0 AND len({b}) = 0 THEN 1.0::DOUBLE ELSE {both}::DOUBLE / (len({a}) + len({b}) - {both}) END"

    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    e AS (SELECT *, coalesce(lead(t) OVER (ORDER BY doc_id DESC), first_value(t) OVER (ORDER BY doc_id DESC)) AS u FROM d),
    g AS (SELECT *, substr(t, 1, length(t) - length(t) // 3) || substr(u, 1, length(t) // 3) AS v FROM e),
    m AS (SELECT *, {marked('t')} AS mt, {marked('u')} AS mu, {marked('v')} AS mv FROM g),
    s AS (SELECT *, {sets('t', 'mt')} AS st, {sets('u', 'mu')} AS su, {sets('v', 'mv')} AS sv FROM m)
    SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(v) AS edited_sha256, array_to_string(st, ' ') AS fingerprint,
           array_to_string(sv, ' ') AS edited_fingerprint, {jaccard('st', 'sv')} AS near_edited,
           {jaccard('st', 'su')} AS near_next
    FROM s"""
