"""The photo manifest: occurrences joined to their media, names cleaned, tables merged and patched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.files import observation_id, photo_url
from tidewell.functions.names import clean_name, first_filled
from tidewell.operators import relational as rel

KEY = ("gbif_occurrence_id", "image_url_large")
RANKS = ("species", "subspecies", "variety", "form")


def still_images(media: DataFrame, kind: str = "type") -> DataFrame:
    """Rows of type StillImage in any case; all rows where there is no such column."""
    return media.where(F.lower(F.col(kind)) == "stillimage") if kind in media.columns else media


def reverse_keys(names: DataFrame, name: str = "name", key: str = "taxon_key") -> DataFrame:
    """(taxon_key, canonical): of several names with one key the greatest counts."""
    return names.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(name).alias("canonical"))


def media_of_occurrences(media: DataFrame, occurrences: DataFrame, key: str = "gbifID", prefix: str = "occ_") -> DataFrame:
    """Inner join on the key. Columns that both have are the media's; the occurrence's get the prefix."""
    both = (set(media.columns) & set(occurrences.columns)) - {key}
    return media.join(occurrences.withColumnsRenamed({c: prefix + c for c in both}), key)


def build(media: DataFrame, occurrences: DataFrame, names: DataFrame, role: str, stamp: Column, kingdom: str | None = None) -> DataFrame:
    """Manifest rows: one for each photo of a known host. The canonical name of the taxon key goes before the cleaned one."""
    joined = media_of_occurrences(still_images(media), occurrences)
    joined = joined.withColumn("image_url_large", photo_url(F.col("identifier"))).where("image_url_large IS NOT NULL")
    clean = clean_name(*(F.col(c) for c in ("taxonRank", "species", "genus", "infraspecificEpithet", "cultivarEpithet", "scientificName")))
    canonical = reverse_keys(names).withColumnRenamed("taxon_key", "__taxon")
    out = joined.join(canonical, F.col("taxonKey") == F.col("__taxon"), "left")
    return out.select(
        F.col("gbifID").alias("gbif_occurrence_id"),
        observation_id(first_filled(F.col("references"), F.col("occurrenceID"))).alias("inat_observation_id"),
        F.coalesce("canonical", clean).alias("taxon_name"),
        F.col("scientificName").alias("taxon_name_verbatim"),
        F.col("taxonKey").alias("gbif_taxon_key"),
        F.lower("taxonRank").alias("taxon_rank"),
        F.lit(role).alias("dataset_role"),
        F.lit(kingdom).alias("kingdom"),
        "family",
        "image_url_large",
        photo_url(F.col("identifier"), "original").alias("image_url_original"),
        first_filled(F.col("license"), F.col("occ_license")).alias("license"),
        first_filled(F.col("rightsHolder"), F.col("occ_rightsHolder")).alias("rights_holder"),
        "creator",
        F.col("eventDate").alias("observed_on"),
        F.col("decimalLatitude").alias("decimal_latitude"),
        F.col("decimalLongitude").alias("decimal_longitude"),
        F.col("verbatimLocality").alias("locality"),
        F.col("recordedBy").alias("recorder_login"),
        stamp.alias("snapshot_utc"),
    )


def from_api(observations: DataFrame) -> DataFrame:
    """A row for each photo of nested records (key, media array<struct<identifier,references,license,rightsHolder,creator>>); the reference stands in for a missing address."""
    photos = observations.select("*", F.explode("media").alias("photo")).drop("media")
    return photos.withColumn("image_url_large", photo_url(first_filled(F.col("photo.identifier"), F.col("photo.references")))).where("image_url_large IS NOT NULL")


def of_ranks(df: DataFrame, rank: str = "rank") -> DataFrame:
    return df.where(F.col(rank).isin(*RANKS)) if rank in df.columns else df


def without_family(df: DataFrame, family: str = "family", excluded: str = "Formicidae") -> DataFrame:
    """Rows of other families, or of none."""
    return df.where(F.coalesce(F.col(family), F.lit("")) != excluded)


def merged(tables: list[DataFrame], order: str = "photo_id") -> DataFrame:
    """Photos of all tables, each once: that of the earlier table."""
    return rel.merge_first(tables, KEY, [F.col(order)])


def with_attribution(manifest: DataFrame, attribution: DataFrame, order: str = "creator") -> DataFrame:
    return rel.patched(manifest, attribution, KEY, [F.col(order)])


def taxa(occurrences: DataFrame) -> DataFrame:
    """One row for each taxon key with its clean name."""
    parts = ("taxonRank", "species", "genus", "infraspecificEpithet", "cultivarEpithet", "scientificName")
    first = rel.keep_first(occurrences.select("taxonKey", *parts), ["taxonKey"], [F.col(c).asc_nulls_last() for c in parts])
    return first.withColumn("clean_taxon_name", clean_name(*(F.col(c) for c in parts)))


def tagged(species: DataFrame, name: str, role: str, kingdom: str, key: str) -> DataFrame:
    """One (name, role, kingdom, id) view of differing species tables."""
    return species.select(F.col(name).alias("taxon_name"), F.lit(role).alias("dataset_role"), F.lit(kingdom).alias("kingdom"), F.col(key).cast("long").alias("taxon_id"))


def ancestor_ranks(taxa_: DataFrame, details: DataFrame, ranks: tuple[str, ...] = ("kingdom", "phylum", "class", "order", "family", "genus", "species")) -> DataFrame:
    """(taxon_id, a column a rank) from ancestor id arrays: the first ancestor of each rank names it."""
    each = taxa_.select("taxon_id", F.posexplode("ancestor_ids").alias("pos", "ancestor"))
    named = each.join(details.select(F.col("id").alias("ancestor"), "rank", "name"), "ancestor")
    return named.groupBy("taxon_id").pivot("rank", list(ranks)).agg(F.min_by("name", "pos"))


def picked_photos(observations: DataFrame, taxon: str = "taxon_id", votes: str = "votes", photos: str = "photos", tie: str = "observation_id", url: str = "url", size: str = "large") -> DataFrame:
    """One photo a taxon: of its observations by falling votes the first with a photo that has an address, in `size`; ties by `tie`, then by the photo's place.

    Columns: the taxon, the tie column, votes and image_url. Null votes come last, addresses of unknown hosts stay as they are.
    """
    each = observations.select(taxon, tie, votes, F.posexplode(photos).alias("at", "photo"))
    filled = each.withColumn("address", first_filled(F.col("photo")[url])).where("address IS NOT NULL")
    best = rel.top_per_group(filled, [taxon], [F.col(votes).desc_nulls_last(), F.col(tie), F.col("at")])
    return best.select(taxon, tie, votes, F.coalesce(photo_url(F.col("address"), size), F.col("address")).alias("image_url"))
