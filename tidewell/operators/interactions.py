"""Interaction records: those of listed plants in an area, without refuted ones, and the animals among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.functions.names import in_state

# Interaction types by the side on which the plant stands, and the area in degrees.
PLANT_IS_TARGET = ("http://purl.obolibrary.org/obo/RO_0002455", "http://purl.obolibrary.org/obo/RO_0002622")
PLANT_IS_SOURCE = ("http://purl.obolibrary.org/obo/RO_0002456", "http://purl.obolibrary.org/obo/RO_0002623")
LATITUDES, LONGITUDES = (32.53, 42.01), (-124.55, -114.13)
REFUTED_BY = ("sourceTaxonId", "targetTaxonId", "interactionTypeId")
ATTRIBUTES = {"animal_name": "Name", "animal_taxon_id": "Id", "animal_kingdom": "KingdomName", "animal_order": "OrderName", "animal_family": "FamilyName", "animal_path": "PathNames"}


def in_area(latitude: Column, longitude: Column, locality: Column) -> Column:
    """Within the box, or by its locality. Coordinates that are null decide nothing."""
    return (latitude.between(*LATITUDES) & longitude.between(*LONGITUDES)) | in_state(locality)


def area_match(latitude: Column, longitude: Column, locality: Column) -> Column:
    """How a row is in the area: bbox, locality, both, or null."""
    box = F.coalesce(latitude.between(*LATITUDES) & longitude.between(*LONGITUDES), F.lit(False))
    named = in_state(locality)
    return F.when(box & named, "both").when(box, "bbox").when(named, "locality")


def plant_name(kind: str = "interactionTypeId", source: str = "sourceTaxonName", target: str = "targetTaxonName", plant_is_target: tuple = PLANT_IS_TARGET) -> Column:
    return F.when(F.col(kind).isin(*plant_is_target), F.col(target)).otherwise(F.col(source))


def select_interactions(
    interactions: DataFrame,
    listed: DataFrame,
    refuted: DataFrame,
    area: Column,
    kind: str = "interactionTypeId",
    source: str = "sourceTaxonName",
    target: str = "targetTaxonName",
    listed_name: str = "scientific_name",
    refuted_by: tuple[str, ...] = REFUTED_BY,
    plant_is_target: tuple = PLANT_IS_TARGET,
    plant_is_source: tuple = PLANT_IS_SOURCE,
) -> DataFrame:
    """Rows of the four types whose plant is listed, within the area, that no refuted row equals in refuted_by.

    The plant's side follows from the type, so one semi join does for both sides. Null keys are never refuted.
    """
    wanted = interactions.where(F.col(kind).isin(*plant_is_target, *plant_is_source)).where(area)
    names = listed.select(F.col(listed_name).alias("__listed")).distinct()
    kept = wanted.withColumn("__plant", plant_name(kind, source, target, plant_is_target)).join(names, F.col("__plant") == F.col("__listed"), "left_semi").drop("__plant")
    return kept.join(refuted.select(*refuted_by), list(refuted_by), "left_anti")


def animals(interactions: DataFrame, kind: str = "interactionTypeId", attributes: dict[str, str] | None = None, plant_is_target: tuple = PLANT_IS_TARGET, prefix: tuple[str, str] = ("sourceTaxon", "targetTaxon"), plant: tuple[str, str] = ("sourceTaxonName", "targetTaxonName")) -> DataFrame:
    """Each record by its roles: the animal's attributes and plant_name."""
    reverse = F.col(kind).isin(*plant_is_target)
    sides = {k: F.when(reverse, F.col(prefix[0] + v)).otherwise(F.col(prefix[1] + v)) for k, v in (attributes or ATTRIBUTES).items()}
    return interactions.select(*(c.alias(k) for k, c in sides.items()), plant_name(kind, *plant, plant_is_target).alias("plant_name"))


def candidates(roles: DataFrame, keys: tuple[str, ...] = tuple(ATTRIBUTES), kingdom: str | None = "animal_kingdom") -> DataFrame:
    """Animals with their distinct plants and records; kingdom Animalia or unknown. Null keys are groups of their own."""
    kept = roles.where((F.col(kingdom) == "Animalia") | F.col(kingdom).isNull()) if kingdom else roles
    found = kept.groupBy(*keys).agg(F.countDistinct("plant_name").alias("n_ca_native_plants"), F.count("*").alias("n_interactions"), F.sort_array(F.collect_set("plant_name")).alias("plant_examples"))
    return found.orderBy(F.desc("n_ca_native_plants"), F.desc("n_interactions"), *keys)
