"""Samples of an exact size that are the same on any partitioning, without sorting the table.

Rows stand in the order of a hash of seed and key. The hash at which a sample ends is found from histograms
of hashes, 15 bits at a time: each pass counts the rows of one bin of the pass before in 32,768 finer ones,
so at most that many counts reach the driver. What lies before the end is then a filter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS, LEVELS = 15, 4


def place(key: Column, seed: int | str = 0) -> Column:
    """A number from 0 to 2**60 - 1 by md5 of seed and key; null keys are empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("long")


def end_of(rows: DataFrame, at: str, need: int, weight: Column | None = None) -> tuple[int, int] | None:
    """(end, before): the smallest place up to which weights add up to `need` or more, and their sum before it. Null if all are less.

    Weights are whole numbers from 0 on, 1 a row unless given.
    """
    amount = F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))
    prefix, before = 0, 0
    for level in range(LEVELS):
        shift = BITS * (LEVELS - 1 - level)
        here = rows.where(F.shiftright(F.col(at), shift + BITS) == prefix) if level else rows
        step = F.shiftright(F.col(at), shift).bitwiseAND((1 << BITS) - 1)
        bins = sorted((r.step, r.n) for r in here.groupBy(step.alias("step")).agg(F.sum(amount).cast("long").alias("n")).collect())
        for step_, n in bins:
            if before + n >= need:
                prefix = prefix << BITS | step_
                break
            before += n
        else:
            return None
    return prefix, before


def exact_sample(df: DataFrame, keys: Sequence[str], k: int, seed: int | str = 0) -> DataFrame:
    """k rows of df without replacement, all if there are no more. Of rows at the last place those with the least keys
    are taken; of rows with equal keys any."""
    if k <= 0:
        return df.limit(0)
    key = F.concat_ws("\x1f", *(F.col(c).cast("string") for c in keys))
    rows = df.withColumn("__place", place(key, seed))
    end = end_of(rows.select("__place"), "__place", k)
    if end is None:
        return df
    last = rows.where(F.col("__place") == end[0]).orderBy(*keys).limit(k - end[1])
    return rows.where(F.col("__place") < end[0]).unionByName(last).drop("__place")


def cluster_sample(df: DataFrame, cluster: str, keys: Sequence[str], enough: int, k: int, seed: int | str = 0) -> DataFrame:
    """k rows out of whole clusters, which are taken in the order of their hash until they have `enough` rows.

    Clusters are chosen by the filter of a semi join; only their number of rows is grouped. A null cluster is one of its own.
    """
    sizes = df.groupBy(cluster).agg(F.count("*").alias("__n")).withColumn("__place", place(F.col(cluster), seed))
    end = end_of(sizes, "__place", enough, F.col("__n"))
    chosen = df if end is None else df.where(place(F.col(cluster), seed) <= end[0])
    return exact_sample(chosen, keys, k, seed)
