"""Queries on readers and writers of files, and on filters of rows: each writes the given tables in a form and reads them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import interactions
from tidewell.operators import relational as rel
from tidewell.plans.registry import query, table
from tidewell.session import fresh_path, materialise
from tidewell.sources import sinks, tables


@query("""
SELECT trim(p_name) AS scientific_name, CAST(p_size AS DOUBLE) AS height_min, CASE p_size % 3 WHEN 0 THEN true WHEN 1 THEN false END AS is_cultivar,
  CASE WHEN p_size % 2 = 0 THEN p_size END AS supported, 'native' AS establishment_means FROM part WHERE p_size >= 5""")
def plants_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the plant export: renamed, without those of blank names, typed, with constants."""
    cells = {
        "Botanical Name": "CASE WHEN p_size < 5 THEN '  ' ELSE concat(' ', p_name, ' ') END",
        "Height (min)": "concat(p_size, ' - 900 ft')",
        "Is Cultivar": "CASE p_size % 3 WHEN 0 THEN ' Yes' WHEN 1 THEN 'FALSE' ELSE 'maybe' END",
        "Butterflies and Moths Supported": "CASE WHEN p_size % 2 = 0 THEN concat(p_size, '.0') ELSE concat(p_size, '.5') END",
    }
    raw = table(spark, sf_dir, "part").select(*(F.expr(e).alias(k) for k, e in cells.items()))
    found = tables.normalised_plants(raw).withColumnRenamed("butterflies_and_moths_supported", "supported")
    return found.select("scientific_name", "height_min", "is_cultivar", "supported", "establishment_means")


PLACES = "l_orderkey, l_linenumber, l_quantity AS latitude, -100 - l_discount * 300 AS longitude, CASE l_returnflag WHEN 'A' THEN 'San Diego Co., CA' WHEN 'R' THEN 'Baja California' END AS locality"


@query(f"""
SELECT l_orderkey, l_linenumber, CASE WHEN box AND named THEN 'both' WHEN box THEN 'bbox' WHEN named THEN 'locality' END AS how FROM (
SELECT *, latitude BETWEEN 32.53 AND 42.01 AND longitude BETWEEN -124.55 AND -114.13 AS box, coalesce(locality LIKE '%, CA', false) AS named FROM (SELECT {PLACES} FROM lineitem))""")
def area_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "lineitem").selectExpr(*PLACES.split(", ", 4)[:4], PLACES.split(", ", 4)[4])
    return places.select("l_orderkey", "l_linenumber", interactions.area_match(F.col("latitude"), F.col("longitude"), F.col("locality")).alias("how"))


@query("""
SELECT s_name AS animal_name, CASE n_regionkey WHEN 0 THEN 'Animalia' END AS animal_kingdom, count(DISTINCT l_partkey) AS n_ca_native_plants, count(*) AS n_interactions
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey WHERE n_regionkey < 3 GROUP BY 1, 2""")
def kingdom_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("n_nationkey") == F.col("s_nationkey"))
    kingdom = F.when(F.col("n_regionkey") == 0, "Animalia").when(F.col("n_regionkey") >= 3, "Plantae")
    roles = table(spark, sf_dir, "lineitem").join(s, F.col("s_suppkey") == F.col("l_suppkey")).select(F.col("s_name").alias("animal_name"), kingdom.alias("animal_kingdom"), F.col("l_partkey").alias("plant_name"))
    return interactions.candidates(roles, ("animal_name", "animal_kingdom")).drop("plant_examples")


@query("SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 10)")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    canonical = table(spark, sf_dir, "part").where("p_size <= 10").select(F.col("p_partkey").alias("l_partkey"))
    return rel.semi(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), canonical, ["l_partkey"])


@query("SELECT c_custkey, row_number() OVER (ORDER BY md5('5:' || c_custkey), c_custkey) - 1 AS place FROM customer")
def seeded_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "customer").select("c_custkey", F.md5(F.concat(F.lit("5:"), F.col("c_custkey").cast("string")).cast("binary")).alias("h"))
    return rel.numbered(keyed, ["h", "c_custkey"], "place").select("c_custkey", "place")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders) WHERE k <= 3")
def first_of_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.top_per_group(table(spark, sf_dir, "orders"), ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_clerk_key END AS more FROM (SELECT o_orderkey, o_orderstatus, o_custkey AS o_clerk_key FROM orders)")
def shard_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of two runs with different columns under one schema."""
    folder, orders = fresh_path(spark, "shards"), table(spark, sf_dir, "orders")
    sinks.bounded_shards(orders.where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_custkey").alias("more")), folder, "r1", 1000)
    sinks.bounded_shards(orders.where("o_orderstatus <> 'F'").select("o_orderkey"), folder, "r2", 1000)
    return tables.shards(spark, folder, ["o_orderkey", "more", "absent"]).drop("shard_path")


@query("SELECT count(*) AS n, true AS bounded FROM orders")
def bounded_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "shards")
    sinks.bounded_shards(table(spark, sf_dir, "orders"), folder, "r1", 300)
    files = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return files.agg(F.sum("n").alias("n"), (F.max("n") <= 300).alias("bounded"))


@query("SELECT n_name AS name, CASE WHEN n_nationkey > 3 THEN CAST(n_nationkey AS BIGINT) END AS taxon_key FROM nation")
def dictionary_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "keys")
    entries = F.map_from_entries(F.collect_list(F.struct("n_name", F.when(F.col("n_nationkey") > 3, F.col("n_nationkey")))))
    body = F.to_json(F.struct(F.count("*").alias("n_names"), entries.alias("name_to_taxon_key")), {"ignoreNullFields": "false"})
    doc = table(spark, sf_dir, "nation").agg(body.cast("binary").alias("content")).select(F.lit("keys.json").alias("path"), "content")
    materialise(sinks.files(doc, folder), "files")
    return tables.key_dictionary(spark, f"{folder}/keys.json")


@query("SELECT s_suppkey AS gbif_occurrence_id, 'https://host/' || s_name AS url, CAST(strlen(s_name) AS BIGINT) AS length FROM supplier")
def pending_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, s = fresh_path(spark, "images"), table(spark, sf_dir, "supplier")
    stem = F.concat(F.lpad((F.col("s_suppkey") % 10).cast("string"), 3, "0"), F.lit("/"), "s_suppkey", F.lit("_ab12"))
    photos = s.select(F.concat(stem, F.lit(".jpg")).alias("path"), F.col("s_name").cast("binary").alias("content"))
    beside = s.select(F.concat(stem, F.lit(".json")).alias("path"), F.to_json(F.struct(F.concat(F.lit("https://host/"), "s_name").alias("image_url_large"))).cast("binary").alias("content"))
    materialise(sinks.files(photos.unionByName(beside), folder), "files")
    return tables.images(spark, folder).select("gbif_occurrence_id", "url", "length")


@query("SELECT o_orderpriority, o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders")
def wide_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with the front columns first, read back by its heading."""
    folder = fresh_path(spark, "wide")
    sinks.wide_csv(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), folder, ["o_orderpriority", "absent"])
    return spark.read.option("header", True).option("enforceSchema", False).schema("o_orderpriority string, o_orderkey bigint, o_totalprice double").csv(folder)


@query("SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_customers, max(o_orderkey) AS last FROM orders")
def stats_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "stats")
    sinks.stats_document(table(spark, sf_dir, "orders").agg(F.count("*").alias("n_rows"), F.countDistinct("o_custkey").alias("n_customers"), F.max("o_orderkey").alias("last")), folder)
    return spark.read.schema("n_rows bigint, n_customers bigint, last bigint").json(folder)


@query("SELECT 'filter' AS type, 'orders' AS stage, count(*) AS n, true AS timed FROM orders UNION ALL SELECT 'filter', 'nation', count(*), true FROM nation")
def provenance_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "log")
    for name in ("orders", "nation"):
        sinks.provenance(spark, folder, "filter", stage=name, n=table(spark, sf_dir, name).count())
    log = tables.event_log(spark, folder)
    return log.select("type", "stage", "n", F.col("ts").rlike(r"^\d{4}-\d\d-\d\dT").alias("timed"))


@query("SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS type, CASE WHEN event_type = 'error' THEN '{''type'': ''' || event_id || '''}}' END AS foreign_line FROM events")
def foreign_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in which some lines aren't JSON: they are kept as they stand, and nothing is read from them."""
    e = table(spark, sf_dir, "events")
    line = F.when(F.col("event_type") == "error", F.concat(F.lit("{'type': '"), "event_id", F.lit("'}}"))).otherwise(F.to_json(F.struct(F.col("event_type").alias("type"), F.col("event_id").alias("n"))))
    folder = fresh_path(spark, "log")
    e.select(line.alias("value")).write.text(folder)
    log = tables.event_log(spark, folder, strict=True)
    return log.select(F.coalesce("n", F.regexp_extract("_corrupt_record", r"'(\d+)'", 1).cast("long")).alias("event_id"), "type", F.col("_corrupt_record").alias("foreign_line"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def open_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that no match was found for so far."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    found = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_partkey").alias("taxon_id"))
    return rel.open_work(orders.join(found, "o_orderkey", "left"), "taxon_id").select("o_orderkey")
