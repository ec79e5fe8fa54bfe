"""Operators with a defined row order, where tables have none: first, best, top and patched rows.

Ties end by a column that the caller names, so every result is the same on any partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import materialise


def unused(df: DataFrame, name: str) -> str:
    """The name, with signs added while df has a column of it."""
    had = {c.lower() for c in df.columns}
    while name.lower() in had:
        name += "_"
    return name


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1, rank: str | None = None) -> DataFrame:
    """The first n rows of each group. Spark cuts groups to n rows before the shuffle where n is small."""
    place = rank or unused(df, "__rank")
    out = df.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(place) <= n)
    return out if rank else out.drop(place)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row a key, the first in order; null keys equal each other."""
    return top_per_group(df, keys, order)


def keep_best(df: DataFrame, keys: Sequence[str], metric: str, tie: str) -> DataFrame:
    """One row a key, that with the largest metric."""
    return top_per_group(df, keys, [F.col(metric).desc_nulls_last(), F.col(tie)])


def union_promoted(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; columns that one lacks are null."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def merge_first(tables: Sequence[DataFrame], keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Union by priority: of rows with equal keys that of the earlier table stays."""
    ranked = union_promoted(*(t.withColumn("__source", F.lit(k)) for k, t in enumerate(tables)))
    return keep_first(ranked, keys, [F.col("__source"), *order]).drop("__source")


def replace_slice(master: DataFrame, new: DataFrame, slice_: Column) -> DataFrame:
    """master without the rows where slice_ holds, and all of new. Rows where it's null stay."""
    return union_promoted(master.where(~F.coalesce(slice_, F.lit(False))), new)


def upsert(master: DataFrame, changes: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns of rows whose key is in changes become those of changes, nulls included. One change a key."""
    right = changes.select(F.col(key).alias("__key"), F.lit(True).alias("__hit"), *(F.col(c).alias(f"__new_{c}") for c in columns))
    joined = master.join(right, F.col(key) == F.col("__key"), "left")
    updated = {c: F.when(F.col("__hit"), F.col(f"__new_{c}")).otherwise(F.col(c) if c in master.columns else F.lit(None)) for c in columns}
    return joined.withColumns(updated).drop("__key", "__hit", *(f"__new_{c}" for c in columns))


def patched(left: DataFrame, lookup: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Left join that can't add rows: of lookup rows with equal keys the first in order counts. Null keys match null keys.

    Columns of lookup replace columns of the same name.
    """
    once = keep_first(lookup, keys, order)
    right = once.select(*(F.col(k).alias(f"__{k}") for k in keys), *(c for c in once.columns if c not in keys))
    left = left.drop(*(c for c in once.columns if c not in keys))
    on = [left[k].eqNullSafe(right[f"__{k}"]) for k in keys]
    return left.join(right, on, "left").drop(*(f"__{k}" for k in keys))


def semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(other.select(*keys), list(keys), "left_semi")


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of df whose keys aren't in other; a null key is in nothing, so its rows stay."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def open_work(df: DataFrame, found: str, only_unmatched: bool = True) -> DataFrame:
    """Rows that have no value in `found` yet, as work that's left; all rows if everything is to be done again. Blank text isn't a value."""
    if not only_unmatched:
        return df
    value = F.col(found)
    return df.where(F.nullif(F.trim(value), F.lit("")).isNull() if df.schema[found].dataType.typeName() == "string" else value.isNull())


def conditional_semi(df: DataFrame, condition: Column, key: str, allowed: DataFrame, allowed_key: str) -> DataFrame:
    """Rows where the condition doesn't hold (or is null), and those where it does and the key is allowed."""
    mark = allowed.select(F.col(allowed_key).alias("__allowed")).where("__allowed IS NOT NULL").distinct().withColumn("__in", F.lit(True))
    joined = df.join(mark, df[key] == F.col("__allowed"), "left")
    return joined.where(~F.coalesce(condition, F.lit(False)) | F.col("__in").isNotNull()).drop("__allowed", "__in")


def counts(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    """Rows by keys, null being a value of its own."""
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def classes(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row with how many rows meet each condition."""
    return df.agg(F.count("*").alias("total"), *(F.count_if(c).alias(k) for k, c in conditions.items()))


def coverage(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """One row with the percentage of non-null values in each column; 0 for an empty table."""
    return df.agg(*(F.round(F.coalesce(100 * F.count(c) / F.nullif(F.count("*"), F.lit(0)), F.lit(0.0)), digits).alias(c) for c in columns))


def shuffled(df: DataFrame, key: str, seed: int | str = 0) -> DataFrame:
    """A full order that looks random and is the same everywhere: by md5 of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.col(key))


def stratified(df: DataFrame, stratum: str, key: str, n: int, seed: int | str = 0) -> DataFrame:
    """n rows of each stratum, by md5 of seed and key."""
    return top_per_group(df, [stratum], [F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), F.col(key)], n)


def numbered(df: DataFrame, order: Sequence[str], name: str = "idx", pieces: int | None = None) -> DataFrame:
    """Row numbers from 0 over the whole table in order: within ranges, then by the ranges' counts. Rows aren't sent to one task."""
    part, nth, n, of, start = (unused(df, c) for c in ("__part", "__nth", "__n", "__of", "__start"))
    # Written once: the branches below would each draw ranges of their own.
    ranged = materialise((df.repartitionByRange(pieces, *order) if pieces else df.repartitionByRange(*order)).withColumn(part, F.spark_partition_id()), "ranges")
    within = ranged.withColumn(nth, F.row_number().over(Window.partitionBy(part).orderBy(*order)))
    sizes = ranged.groupBy(part).agg(F.count("*").alias(n))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = sizes.select(F.col(part).alias(of), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    return within.join(F.broadcast(starts), F.col(part) == F.col(of)).withColumn(name, F.col(nth) + F.col(start) - 1).drop(part, nth, of, start)


def running_least(df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str, name: str = "least") -> DataFrame:
    """Adds the least `value` among the rows of equal keys up to each one in order: within ranges, then by what earlier ranges of the key had. A key isn't sent to one task."""
    part, own, held, of = (unused(df, c) for c in ("__part", "__own", "__held", "__of"))
    # Written once, as in numbered().
    ranged = materialise(df.repartitionByRange(*keys, *order).withColumn(part, F.spark_partition_id()), "ranges")
    within = ranged.withColumn(own, F.min(value).over(Window.partitionBy(part, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row for each range of a key
    carried = ranged.groupBy(part, *keys).agg(F.min(value).alias(held)).withColumn(held, F.min(held).over(before)).where(F.col(held).isNotNull())
    # Ranges follow the keys, so at most one key of a range has begun before it: a row a range is broadcast.
    right = carried.select(F.col(part).alias(of), *(F.col(k).alias(f"{of}_{k}") for k in keys), held)
    on = [F.col(part) == F.col(of), *(F.col(k).eqNullSafe(F.col(f"{of}_{k}")) for k in keys)]
    joined = within.join(F.broadcast(right), on, "left").withColumn(name, F.least(held, own))
    return joined.drop(part, own, held, of, *(f"{of}_{k}" for k in keys))
