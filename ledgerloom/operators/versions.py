"""Record versions and duplicate keys.

One key may hold a large share of all rows, so nothing here gathers a key group in one task:
`row_number() = 1` is limited per map task before the shuffle (WindowGroupLimit), counts are
pre-aggregated, and row-level joins go against one row per key, which adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.errors import CardinalityError


def latest_version(df: DataFrame, keys: Sequence[str | Column], newest_first: Sequence[Column]) -> DataFrame:
    """The first row per key under `newest_first`, which must be a total order within a key."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.where("_rank = 1").drop("_rank")


def superseded(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Every row but the latest version of its key; of equal copies of the latest, all but one.

    Copies are counted first, so they are one row a task. Winners are found again by all their columns, not by key, so the
    versions of a hot key spread over all tasks. Nulls are values like any other.
    """
    columns = df.columns
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    won = latest_version(df, keys, newest_first).select(*[F.col(c).alias(f"_w_{c}") for c in columns], F.lit(1).alias("_won"))
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in columns))
    left = F.col("_copies") - F.coalesce("_won", F.lit(0))
    met = copies.join(won, same, "left").where(left > 0)
    return met.withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), left))).select(*columns)


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("versions"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count. Null keys are not duplicates."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return key_counts(df.where(present), keys).where("versions > 1")


def duplicate_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows of the duplicated keys, with `versions`."""
    return df.join(duplicate_keys(df, keys), list(keys), "inner")


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> int:
    """Fail before a many-to-one join or a load that relies on unique keys; returns the row count."""
    per_key = key_counts(df, keys)
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    twice = present & (F.col("versions") > 1)
    totals = per_key.agg(
        F.coalesce(F.sum("versions"), F.lit(0)).alias("row_count"), F.count_if(twice).alias("duplicated"),
        F.min(F.when(twice, F.concat_ws("/", *keys))).alias("example"),
    ).first()
    if totals["duplicated"]:
        raise CardinalityError(
            f"{what}: {totals['duplicated']} duplicate {'/'.join(keys)} value(s) (e.g. {totals['example']})")
    return totals["row_count"]
