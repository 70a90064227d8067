"""Exact medians of groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the quantile sketch: places are right to a ten-thousandth of a group
ROUNDS = 2  # of narrowing; each leaves about a two-thousandth of a group, copies of its middle values aside
EVEN = [i / 16 for i in range(1, 16)]
CLOSE = [0.5 + side * step / ACCURACY for step in (2, 8, 32, 128) for side in (-1, 1)]


def exact_median(df: DataFrame, group: str, value: str, rounds: int = ROUNDS) -> DataFrame:
    """(group, median): the middle value, or the mean of the two middle ones. Null values do not count; a group
    without values has none.

    Quantile sketches, merged from those of each task, cut the values of a group into ranges that are narrow about its middle, by
    rank and not by size, so that outliers do not matter. Counts of the ranges tell which hold the middle ranks, however good the
    sketch was. Only the values in them go on to the next round, and the values left after the last are ranked, equal ones as
    one row. No task holds the values of a group, and each step combines before it shuffles.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).cast("double").alias("v"))
    groups = rows.groupBy(F.col("g").alias("eg")).agg(F.count("v").alias("n"))
    # 0-based ranks of the two middle values; both are the same one if the count is odd.
    ranks = groups.where("n > 0").select(
        F.col("eg").alias("rg"), F.floor((F.col("n") - 1) / 2).alias("first"), F.floor(F.col("n") / 2).alias("second"))
    inside = rows.where("v IS NOT NULL")
    for _ in range(rounds):
        inside, ranks = narrowed(inside, ranks)

    values = inside.groupBy("g", "v").agg(F.count(F.lit(1)).alias("copies"))
    smaller = Window.partitionBy("g").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = values.withColumn("rank", F.coalesce(F.sum("copies").over(smaller), F.lit(0)))
    placed = ranked.join(ranks, F.col("g").eqNullSafe(F.col("rg")))
    at = [F.max(F.when((F.col("rank") <= m) & (m < F.col("rank") + F.col("copies")), F.col("v")))
          for m in (F.col("first"), F.col("second"))]
    found = placed.groupBy("g").agg(((at[0] + at[1]) / 2).alias("m"))
    return groups.select("eg").join(found, F.col("g").eqNullSafe(F.col("eg")), "left").select(
        F.col("eg").alias(group), F.col("m").alias("median"))


def narrowed(rows: DataFrame, ranks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of the (g, v), those in the ranges that hold ranks `first` to `second` of (rg, first, second); and the ranks among them."""
    cuts = F.percentile_approx("v", sorted({*EVEN, *CLOSE}), ACCURACY)
    bounds = rows.groupBy(F.col("g").alias("bg")).agg(F.array_distinct(cuts).alias("cuts"))
    ranged = rows.join(bounds, F.col("g").eqNullSafe(F.col("bg"))).select("g", "v", _range_of("v", "cuts").alias("r"))
    counts = ranged.groupBy("g", "r").agg(F.count(F.lit(1)).alias("here"))
    before = Window.partitionBy("g").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)  # some fifty ranges
    placed = counts.withColumn("before", F.coalesce(F.sum("here").over(before), F.lit(0)))
    met = placed.join(ranks, F.col("g").eqNullSafe(F.col("rg"))).where(
        (F.col("before") <= F.col("second")) & (F.col("first") < F.col("before") + F.col("here")))
    held = met.groupBy(F.col("g").alias("hg")).agg(
        F.min("r").alias("low"), F.max("r").alias("high"), F.min("before").alias("skipped"),
        F.min("first").alias("first"), F.min("second").alias("second"))
    inside = ranged.join(held, F.col("g").eqNullSafe(F.col("hg"))).where(F.col("r").between(F.col("low"), F.col("high")))
    left = held.select(F.col("hg").alias("rg"), *[(F.col(c) - F.col("skipped")).alias(c) for c in ("first", "second")])
    return inside.select("g", "v"), left


def _range_of(value: str, cuts: str) -> Column:
    """A range for the values between two neighbouring cuts, and one for those that equal a cut, in their order."""
    def passed(n: Column, cut: Column) -> Column:
        return n + F.when(cut < F.col(value), 2).when(cut == F.col(value), 1).otherwise(0)

    return F.aggregate(F.col(cuts), F.lit(0), passed)
