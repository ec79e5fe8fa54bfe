"""The bipartite network of plants and animals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators import relational as rel


def richness(records: DataFrame, plant: str = "plant_name", animal: str = "animal_name", order: str = "animal_order", top: int = 3) -> DataFrame:
    """Per plant: distinct animals, records, and its most frequent orders joined by '; ' (ties by name)."""
    known = records.where(F.col(plant).isNotNull())
    sums = known.groupBy(plant).agg(F.countDistinct(animal).alias("globi_pollinator_count"), F.count(animal).alias("globi_interaction_records"))
    by_order = known.where(F.col(order).isNotNull()).groupBy(plant, order).agg(F.count("*").alias("n"))
    first = rel.top_per_group(by_order, [plant], [F.desc("n"), F.col(order)], top, "rank")
    joined = first.groupBy(plant).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", order))), lambda x: x[order]), "; ").alias("top_pollinator_orders"))
    return sums.join(joined, plant, "left")


def with_zeroes(listed: DataFrame, rich: DataFrame, name: str = "scientific_name", plant: str = "plant_name") -> DataFrame:
    """Every listed plant; counts are 0 where nothing is recorded."""
    out = listed.join(rich.withColumnRenamed(plant, "__plant"), F.col(name) == F.col("__plant"), "left").drop("__plant")
    return out.fillna(0, ["globi_pollinator_count", "globi_interaction_records"])


def gaps(rich: DataFrame) -> DataFrame:
    return rich.where("globi_pollinator_count = 0")


def generalists(records: DataFrame, ordinal: str, plant: str = "plant_name", animal: str = "animal_name", order: str = "animal_order", family: str = "animal_family") -> DataFrame:
    """Per animal: distinct plants, records, and its first known order and family by `ordinal`."""
    first = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(ordinal)))
    known = records.where(F.col(animal).isNotNull())
    found = known.groupBy(animal).agg(F.countDistinct(plant).alias("n_distinct_plants"), F.count(plant).alias("n_records"), first(order).alias("animal_order"), first(family).alias("animal_family"))
    return found.orderBy(F.desc("n_distinct_plants"), animal)


def crosstab(records: DataFrame, row: str, column: str, rows: int = 30, columns: int = 15, missing: str = "<null>") -> DataFrame:
    """(row, column, n) in long form: the largest rows, then the largest columns within these. Null is a value; absent pairs have n 0."""
    counted = records.select(F.coalesce(row, F.lit(missing)).alias("row"), F.coalesce(column, F.lit(missing)).alias("col")).groupBy("row", "col").agg(F.count("*").alias("n"))
    top_rows = counted.groupBy("row").agg(F.sum("n").alias("s")).orderBy(F.desc("s"), "row").limit(rows).select("row")
    within = counted.join(F.broadcast(top_rows), "row")  # `rows` rows at most
    top_columns = within.groupBy("col").agg(F.sum("n").alias("s")).orderBy(F.desc("s"), "col").limit(columns).select("col")
    grid = top_rows.join(F.broadcast(top_columns), how="cross")  # rows x columns cells at most
    return grid.join(within, ["row", "col"], "left").fillna(0, ["n"])


def crosstab_wide(long: DataFrame, columns: list[str]) -> DataFrame:
    return long.groupBy("row").pivot("col", columns).agg(F.sum("n")).fillna(0)


def stats(records: DataFrame, plant: str = "plant_name", animal: str = "animal_name") -> DataFrame:
    """One row: nodes, edges, records, density, degrees."""
    edges = records.select(plant, animal).distinct()
    degree = lambda key, name: (
        edges.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("d")).agg(F.count("*").alias(f"n_{name}_nodes"), F.max("d").alias(f"{name}_degree_max"), F.avg("d").alias(f"{name}_degree_mean"), F.expr("percentile(d, 0.5)").alias(f"{name}_degree_median"))
    )
    totals = edges.agg(F.count("*").alias("n_unique_edges")).join(records.agg(F.count("*").alias("n_total_records")), how="cross")
    out = totals.join(degree(plant, "plant"), how="cross").join(degree(animal, "pollinator"), how="cross")  # one row each
    cells = F.col("n_plant_nodes") * F.col("n_pollinator_nodes")
    return out.withColumn("bipartite_density", F.coalesce(F.col("n_unique_edges") / F.nullif(cells, F.lit(0)), F.lit(0.0)))
