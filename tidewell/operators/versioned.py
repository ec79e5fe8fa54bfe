"""Shards of several runs: column swaps by version, scrubbing, an address index, one consolidated table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.files import run_id
from tidewell.operators import relational as rel

SWAPPED_BEFORE = "20260524T070916"
FLOWERING, FRUITING = "phenovision_flowering_prob", "phenovision_fruiting_prob"
FRONT = ("gbif_occurrence_id", "image_url_large", "taxon_name", "dataset_role")


def needs_swap(shard: Column, threshold: str = SWAPPED_BEFORE, fixed: Column | None = None) -> Column:
    """Shards of runs before the threshold, or of legacy names, unless they are known as fixed."""
    run = run_id(shard)
    return ((run == "") | (run < threshold)) & ~F.coalesce(fixed if fixed is not None else F.lit(False), F.lit(False))


def swapped(df: DataFrame, needed: Column, a: str = FLOWERING, b: str = FRUITING) -> DataFrame:
    """a and b exchanged, both at once, where needed. Tables without the two columns stay."""
    if a not in df.columns or b not in df.columns:
        return df
    return df.withColumns({a: F.when(needed, F.col(b)).otherwise(F.col(a)), b: F.when(needed, F.col(a)).otherwise(F.col(b))})


def corrected(shards: DataFrame, fix_log: DataFrame, shard: str = "shard_path", threshold: str = SWAPPED_BEFORE, a: str = FLOWERING, b: str = FRUITING) -> DataFrame:
    """Swaps by version, minding the log of shards that were fixed."""
    log = fix_log.select(F.col(shard).alias("__fixed")).distinct()
    marked = shards.join(log, F.col(shard) == F.col("__fixed"), "left")
    return swapped(marked, needs_swap(F.col(shard), threshold, F.col("__fixed").isNotNull()), a, b).drop("__fixed")


def fixed_shards(log: DataFrame, line: str = "value") -> DataFrame:
    """(shard_path) of commit-log lines that tell of a swap fix."""
    path = F.regexp_extract(line, r"(embeddings_[0-9A-Za-z_]+\.parquet)", 1)
    return log.where(F.col(line).rlike("(?i)swap")).select(path.alias("shard_path")).where("shard_path <> ''").distinct()


def scrubbed(shards: DataFrame, canonical: DataFrame, name: str = "taxon_name", role: str = "dataset_role", allowed: str = "name") -> DataFrame:
    """Plants with a canonical name, and every row of other or no role."""
    return rel.conditional_semi(shards, F.col(role) == "plant", name, canonical, allowed)


def scrub_report(shards: DataFrame, canonical: DataFrame, shard: str = "shard_path", name: str = "taxon_name", role: str = "dataset_role", allowed: str = "name") -> DataFrame:
    """Rows before and after by shard, and in all (shard null)."""
    mark = canonical.select(F.col(allowed).alias("__allowed")).where("__allowed IS NOT NULL").distinct()
    joined = shards.join(mark, F.col(name) == F.col("__allowed"), "left")
    keep = ~F.coalesce(F.col(role) == "plant", F.lit(False)) | F.col("__allowed").isNotNull()
    return joined.rollup(shard).agg(F.count("*").alias("rows_before"), F.count_if(keep).alias("rows_after"))


def address_index(shards: DataFrame, url: str = "image_url_large", shard: str = "shard_path") -> DataFrame:
    """(url, shard) with one shard for each address, the least."""
    return shards.groupBy(url).agg(F.min(shard).alias(shard))


def lookup(index: DataFrame, shards: DataFrame, wanted: DataFrame, url: str = "image_url_large", shard: str = "shard_path") -> DataFrame:
    """Rows of the wanted addresses, read from the shard that the index names."""
    places = index.join(wanted.select(url).distinct(), url, "left_semi")
    return shards.join(places, [url, shard], "left_semi")


def consolidated(shards: DataFrame, manifest: DataFrame, keys: tuple[str, ...] = ("gbif_occurrence_id", "image_url_large"), order: str = "photo_id", front: tuple[str, ...] = FRONT) -> DataFrame:
    """Shard rows with the manifest's columns, the front columns first. Tensors don't take part in the join if they're not selected."""
    extra = [c for c in manifest.columns if c not in shards.columns]
    out = rel.patched(shards, manifest.select(*keys, *extra), keys, [F.col(order) if order in extra else F.col(keys[0])])
    first = [c for c in front if c in out.columns]
    return out.select(*first, *(c for c in out.columns if c not in first))
