"""Queries that merge, patch, version and publish tables; and those on vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import tensors
from tidewell.operators import manifest, vectors, versioned
from tidewell.operators import relational as rel
from tidewell.plans.registry import query, table
from tidewell.sources import sinks

OCCURRENCES = {
    "gbifID": "o_orderkey", "scientificName": "concat(c_mktsegment, ' L.')", "taxonKey": "o_custkey", "taxonRank": "CASE o_orderstatus WHEN 'F' THEN 'SPECIES' WHEN 'O' THEN 'VARIETY' ELSE 'GENUS' END",
    "species": "concat(c_mktsegment, ' sp')", "genus": "c_mktsegment", "infraspecificEpithet": "CASE WHEN o_totalprice > 250000 THEN 'major' END", "cultivarEpithet": "CAST(NULL AS VARCHAR(9))",
    "decimalLatitude": "o_totalprice / 10000", "decimalLongitude": "-o_totalprice / 5000", "eventDate": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10))", "license": "CASE WHEN o_totalprice < 100000 THEN 'CC0' END",
    "rightsHolder": "c_name", "recordedBy": "c_name", "occurrenceID": "concat('https://x.org/observations/', o_orderkey)", "family": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Formicidae' WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END", "verbatimLocality": "o_orderpriority",
}
MEDIA = {
    "gbifID": "l_orderkey", "type": "CASE l_returnflag WHEN 'A' THEN 'StillImage' WHEN 'R' THEN 'stillimage' ELSE 'Sound' END",
    "identifier": "CASE WHEN l_quantity < 3 THEN NULL WHEN l_quantity < 6 THEN 'https://example.org/square.jpg' ELSE concat('https://static.inaturalist.org/photos/', l_partkey, '/', l_suppkey, '/', l_linenumber, '/Square.jpg') END",
    "references": "CASE WHEN l_discount > 0.05 THEN concat('https://x.org/observations/', l_partkey) ELSE '' END", "license": "CASE WHEN l_tax > 0.04 THEN 'CC-BY' ELSE '' END",
    "rightsHolder": "CASE WHEN l_tax > 0.02 THEN CAST(l_suppkey AS VARCHAR(20)) END", "creator": "CAST(l_suppkey AS VARCHAR(20))",
}


def _sql(fields: dict[str, str]) -> str:
    return ", ".join(f'{v} AS "{k}"' for k, v in fields.items())


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"))
    return joined.select(*(F.expr(v).alias(k) for k, v in OCCURRENCES.items()))


def media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*(F.expr(v).alias(k) for k, v in MEDIA.items()))


MANIFEST = f"""
WITH occ AS (SELECT {_sql(OCCURRENCES)} FROM orders JOIN customer ON o_custkey = c_custkey), med AS (SELECT {_sql(MEDIA)} FROM lineitem),
keys AS (SELECT c_custkey AS taxon_key, max(c_name) AS canonical FROM customer WHERE c_acctbal > 5000 GROUP BY 1)
SELECT m."gbifID" AS gbif_occurrence_id, TRY_CAST(nullif(regexp_extract(coalesce(nullif(trim(m."references"), ''), nullif(trim(o."occurrenceID"), '')), 'observations/(\\d+)', 1), '') AS BIGINT) AS inat_observation_id,
  coalesce(canonical, CASE WHEN o."taxonRank" = 'VARIETY' AND o."infraspecificEpithet" IS NOT NULL THEN o.species || ' var. ' || o."infraspecificEpithet" WHEN o."taxonRank" = 'GENUS' THEN o.genus ELSE o.species END) AS taxon_name,
  o."scientificName" AS taxon_name_verbatim, o."taxonKey" AS gbif_taxon_key, lower(o."taxonRank") AS taxon_rank, 'plant' AS dataset_role, o.family,
  regexp_replace(m.identifier, '(?i)/square\\.jpg', '/large.jpg') AS image_url_large, regexp_replace(m.identifier, '(?i)/square\\.jpg', '/original.jpg') AS image_url_original,
  coalesce(nullif(m.license, ''), o.license) AS license, coalesce(m."rightsHolder", o."rightsHolder") AS rights_holder, m.creator, o."eventDate" AS observed_on, o."decimalLatitude" AS decimal_latitude, o."verbatimLocality" AS locality
FROM med m JOIN occ o ON m."gbifID" = o."gbifID" LEFT JOIN keys ON taxon_key = o."taxonKey"
WHERE lower(m.type) = 'stillimage' AND contains(m.identifier, 'inaturalist')"""
MANIFEST_COLUMNS = "gbif_occurrence_id inat_observation_id taxon_name taxon_name_verbatim gbif_taxon_key taxon_rank dataset_role family image_url_large image_url_original license rights_holder creator observed_on decimal_latitude locality".split()


def built(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "customer").where("c_acctbal > 5000").selectExpr("c_name AS name", "c_custkey AS taxon_key")
    return manifest.build(media(spark, sf_dir), occurrences(spark, sf_dir), names, "plant", F.lit("t"), "Plantae")


@query(MANIFEST)
def manifest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return built(spark, sf_dir).select(*MANIFEST_COLUMNS)


@query(f"SELECT coalesce(family, '<null>') AS family, count(*) AS n FROM ({MANIFEST}) m WHERE coalesce(family, '') <> 'Formicidae' AND taxon_rank IN ('species', 'subspecies', 'variety', 'form') GROUP BY 1")
def family_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = manifest.of_ranks(manifest.without_family(built(spark, sf_dir)), "taxon_rank")
    return rel.counts(kept.withColumn("family", F.coalesce("family", F.lit("<null>"))), ["family"])


LINE = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_extendedprice"
TIES = ["l_linenumber", "l_suppkey", "l_extendedprice"]


@query(f"""
WITH u AS (SELECT *, 0 AS src FROM lineitem WHERE l_returnflag IN ('A', 'R') UNION ALL SELECT *, 1 FROM lineitem WHERE l_linestatus = 'O'),
r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY src, {', '.join(TIES)}) AS k FROM u)
SELECT {LINE} FROM r WHERE k = 1""")
def manifest_merge_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    merged = rel.merge_first([lines.where("l_returnflag IN ('A', 'R')"), lines.where("l_linestatus = 'O'")], ["l_orderkey", "l_partkey"], [F.col(c) for c in TIES])
    return merged.selectExpr(*LINE.split(", "))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus <> 'F' UNION ALL SELECT o_orderkey, o_custkey, 'F', NULL FROM orders WHERE o_totalprice > 400000")
def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    new = orders.where("o_totalprice > 400000").select("o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"))
    return rel.replace_slice(orders.drop("o_totalprice"), new, F.col("o_orderstatus") == "F")


PATCH = """
WITH a AS (SELECT l_orderkey, l_partkey, l_tax, l_shipdate, row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_tax, l_shipdate) AS k FROM lineitem WHERE l_quantity > 20)
SELECT l.l_orderkey, l.l_partkey, l.l_linenumber, a.l_tax AS patched_tax, p.p_name AS clean FROM lineitem l LEFT JOIN a ON a.k = 1 AND a.l_orderkey = l.l_orderkey AND a.l_partkey = l.l_partkey
LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size > 10) p ON p.p_partkey = l.l_partkey"""


def patched(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    lookup = lines.where("l_quantity > 20").selectExpr("l_orderkey", "l_partkey", "l_tax AS patched_tax", "l_shipdate")
    once = rel.patched(lines.select("l_orderkey", "l_partkey", "l_linenumber"), lookup, ["l_orderkey", "l_partkey"], [F.col("patched_tax"), F.col("l_shipdate")])
    clean = part.where("p_size > 10").selectExpr("p_partkey AS l_partkey", "p_name AS clean")
    return rel.patched(once, clean, ["l_partkey"], [F.col("clean")]).drop("l_shipdate")


@query(PATCH)
def attribution_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patched(spark, sf_dir).select("l_orderkey", "l_partkey", "l_linenumber", "patched_tax", "clean")


@query(f"SELECT count(*) AS rows, round(100.0 * count(patched_tax) / count(*), 4) AS patched_tax, round(100.0 * count(clean) / count(*), 4) AS clean FROM ({PATCH}) t")
def coverage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = patched(spark, sf_dir)
    return p.agg(F.count("*").alias("rows"), *(F.round(100 * F.count(c) / F.count("*"), 4).alias(c) for c in ("patched_tax", "clean")))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey) AS k FROM lineitem) t WHERE k = 1")
def keep_max_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return rel.top_per_group(lines, ["l_orderkey"], [F.desc("l_extendedprice"), F.col("l_linenumber"), F.col("l_partkey")]).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT "taxonKey", clean_taxon_name FROM (SELECT o_custkey AS "taxonKey", CASE WHEN o_orderstatus = 'O' AND o_totalprice > 250000 THEN c_mktsegment || ' sp var. major' WHEN o_orderstatus = 'P' THEN c_mktsegment ELSE c_mktsegment || ' sp' END AS clean_taxon_name,
  row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 'SPECIES' WHEN 'O' THEN 'VARIETY' ELSE 'GENUS' END, c_mktsegment, CASE WHEN o_totalprice > 250000 THEN 'major' END NULLS LAST) AS k FROM orders JOIN customer ON o_custkey = c_custkey) t WHERE k = 1""")
def first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.taxa(occurrences(spark, sf_dir)).select("taxonKey", "clean_taxon_name")


@query("SELECT event_type, user_id, n, rank FROM (SELECT event_type, user_id, count(*) AS n, CAST(row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS INTEGER) AS rank FROM events GROUP BY 1, 2) t WHERE rank <= 3")
def topn_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count("*").alias("n"))
    return rel.top_per_group(n, ["event_type"], [F.desc("n"), F.col("user_id")], 3, "rank")


@query("SELECT CASE WHEN p_size > 40 THEN NULL ELSE p_type END AS kind, count(*) AS n FROM part GROUP BY 1")
def value_counts_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rel.counts(table(spark, sf_dir, "part").selectExpr("CASE WHEN p_size > 40 THEN NULL ELSE p_type END AS kind"), ["kind"])


@query("SELECT o_orderstatus AS role, count(DISTINCT o_custkey) AS n_taxa, count(*) AS n_rows, round(avg(CASE WHEN o_totalprice > 100000 THEN 1.0 ELSE 0.0 END), 4) AS matched FROM orders GROUP BY 1")
def role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_orderstatus").alias("role")).agg(F.countDistinct("o_custkey").alias("n_taxa"), F.count("*").alias("n_rows"), F.round(F.avg((F.col("o_totalprice") > 100000).cast("double")), 4).alias("matched"))


@query("SELECT event_id, user_id FROM events e WHERE NOT EXISTS (SELECT 1 FROM events d WHERE d.event_type = 'purchase' AND d.value > 40 AND d.event_id = e.event_id)")
def resume_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return rel.anti(e, e.where("event_type = 'purchase' AND value > 40"), ["event_id"]).select("event_id", "user_id")


@query("""
WITH d AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 40), f AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS u, CAST(round(value * 100) AS BIGINT) AS length FROM events)
SELECT count(*) AS total, count(d.user_id) AS deletable, count(*) FILTER (d.user_id IS NULL AND u IS NOT NULL) AS pending, count(*) FILTER (u IS NULL) AS no_address, CAST(coalesce(sum(CASE WHEN d.user_id IS NOT NULL THEN length END), 0) AS BIGINT) AS freed_bytes FROM f LEFT JOIN d ON u = d.user_id""")
def orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.streaming.stages import orphans as sorted_files

    e = table(spark, sf_dir, "events")
    kept = e.selectExpr("CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS url", "CAST(round(value * 100) AS BIGINT) AS length")
    return sorted_files(kept, e.where("event_type = 'purchase' AND value > 40"), "user_id")


@query("SELECT count(*) AS total, count(d.user_id) AS done, count(*) - count(d.user_id) AS pending FROM (SELECT DISTINCT user_id FROM events) m LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 40) d USING (user_id)")
def progress_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidewell.streaming.stages import progress

    e = table(spark, sf_dir, "events")
    return progress(e, e.where("event_type = 'purchase' AND value > 40"), "user_id")


@query("SELECT DISTINCT user_id AS name, event_type AS kind FROM events e WHERE (user_id, event_type) IN (SELECT user_id, event_type FROM events WHERE value > 60) AND user_id NOT IN (SELECT user_id FROM events WHERE event_type = 'signup' AND value > 80)")
def confirmed_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumnsRenamed({"user_id": "name", "event_type": "kind"})
    local = e.select("name", "kind").distinct()
    pending = sinks.to_publish(local, e.where("kind = 'signup' AND value > 80"))
    return sinks.confirmed(pending, e.where("value > 60"), size="kind")


@query("(SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') INTERSECT SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def set_operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    key = lambda s: orders.where(F.col("o_orderstatus") == s).select("o_custkey")
    return key("F").subtract(key("P")).intersect(table(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")))


@query("SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE NOT coalesce(l_returnflag = 'A', false) OR l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)")
def role_scrub(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("role", F.expr("CASE WHEN l_returnflag = 'A' THEN 'plant' ELSE l_returnflag END"))
    return versioned.scrubbed(lines, table(spark, sf_dir, "part").where("p_size < 20"), "l_partkey", "role", "p_partkey").select("l_orderkey", "l_partkey", "l_linenumber")


@query("""
SELECT shard_path, count(*) AS rows_before, count(*) FILTER (NOT (l_returnflag = 'A') OR l_partkey IN (SELECT p_partkey FROM part WHERE p_size < 20)) AS rows_after
FROM (SELECT *, strftime(l_shipdate, '%Y') AS shard_path FROM lineitem) t GROUP BY ROLLUP (shard_path)""")
def scrub_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumns({"role": F.expr("CASE WHEN l_returnflag = 'A' THEN 'plant' ELSE l_returnflag END"), "shard_path": F.date_format("l_shipdate", "yyyy")})
    return versioned.scrub_report(lines, table(spark, sf_dir, "part").where("p_size < 20"), "shard_path", "l_partkey", "role", "p_partkey")


@query("""
WITH s AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'embeddings_000001.parquet' ELSE 'embeddings_' || strftime(ts, '%Y%m%dT%H0000') || '_000001.parquet' END AS shard_path, value AS fl, value / 2 AS fr FROM events),
f AS (SELECT DISTINCT 'embeddings_' || strftime(ts, '%Y%m%dT%H0000') || '_000001.parquet' AS p FROM events WHERE event_type = 'signup' AND value > 50),
n AS (SELECT s.*, (regexp_extract(shard_path, 'embeddings_(\\d{8}T\\d{6})_', 1) = '' OR regexp_extract(shard_path, 'embeddings_(\\d{8}T\\d{6})_', 1) < '20240115T000000') AND f.p IS NULL AS sw FROM s LEFT JOIN f ON p = shard_path)
SELECT event_id, CASE WHEN sw THEN fr ELSE fl END AS flowering, CASE WHEN sw THEN fl ELSE fr END AS fruiting FROM n""")
def versioned_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    run = F.concat(F.lit("embeddings_"), F.date_format("ts", "yyyyMMdd'T'HH'0000'"), F.lit("_000001.parquet"))
    shards = e.select("event_id", F.when(F.col("event_type") == "error", "embeddings_000001.parquet").otherwise(run).alias("shard_path"), F.col("value").alias("flowering"), (F.col("value") / 2).alias("fruiting"))
    log = e.where("event_type = 'signup' AND value > 50").select(F.concat(F.lit("fix swap in "), run).alias("value"))
    return versioned.corrected(shards, versioned.fixed_shards(log), threshold="20240115T000000", a="flowering", b="fruiting").drop("shard_path")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, o_totalprice FROM (SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem) l
LEFT JOIN (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority <> '5-LOW') o ON o_orderkey = l_orderkey""")
def consolidated(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = table(spark, sf_dir, "lineitem").select("l_partkey", "l_linenumber", "l_orderkey")
    extra = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").selectExpr("o_orderkey AS l_orderkey", "o_orderstatus", "o_totalprice")
    return versioned.consolidated(shards, extra, ("l_orderkey",), "o_totalprice", ("l_orderkey", "l_linenumber"))


@query("""
WITH i AS (SELECT l_partkey, min(strftime(l_shipdate, '%Y')) AS shard_path FROM lineitem GROUP BY 1)
SELECT l_orderkey, l.l_partkey, l_linenumber, i.shard_path FROM lineitem l JOIN i ON l.l_partkey = i.l_partkey AND strftime(l_shipdate, '%Y') = i.shard_path WHERE l.l_partkey IN (SELECT p_partkey FROM part WHERE p_name = 'small ring')""")
def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = table(spark, sf_dir, "lineitem").withColumn("shard_path", F.date_format("l_shipdate", "yyyy"))
    wanted = table(spark, sf_dir, "part").where("p_name = 'small ring'").selectExpr("p_partkey AS l_partkey")
    return versioned.lookup(versioned.address_index(shards, "l_partkey"), shards, wanted, "l_partkey").select("l_orderkey", "l_partkey", "l_linenumber", "shard_path")


@query("""SELECT s_suppkey AS taxon_id, r_name AS region, n_name AS nation, s_name AS supplier FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def ancestor_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, n, r = (table(spark, sf_dir, x) for x in ("supplier", "nation", "region"))
    # Ids of one space: regions below 0, nations from 10**12 on; the same nation twice tells that the first counts.
    details = s.selectExpr("s_suppkey AS id", "'supplier' AS rank", "s_name AS name").unionByName(n.selectExpr("n_nationkey + 1000000000000 AS id", "'nation' AS rank", "n_name AS name")).unionByName(r.selectExpr("CAST(-1 - r_regionkey AS BIGINT) AS id", "'region' AS rank", "r_name AS name"))
    taxa = s.join(n, F.expr("s_nationkey = n_nationkey")).selectExpr("s_suppkey AS taxon_id", "array(CAST(-1 - n_regionkey AS BIGINT), n_nationkey + 1000000000000, 1000000000000, s_suppkey) AS ancestor_ids")
    return manifest.ancestor_ranks(taxa, details, ("region", "nation", "supplier"))


@query("""
SELECT c_custkey, CASE WHEN o.k IS NOT NULL THEN o.d ELSE c_mktsegment END AS c_mktsegment, CASE WHEN o.k IS NOT NULL THEN o.p END AS best_price FROM customer
LEFT JOIN (SELECT o_custkey AS k, max(o_totalprice) AS p, CASE WHEN max(o_totalprice) > 400000 THEN NULL ELSE 'known' END AS d FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON o.k = c_custkey""")
def upsert_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("best_price")).withColumn("c_mktsegment", F.when(~(F.col("best_price") > 400000), "known"))
    return rel.upsert(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), changes, "c_custkey", ["c_mktsegment", "best_price"])


@query("SELECT p_name AS taxon_name, 'plant' AS dataset_role, 'Plantae' AS kingdom, p_partkey AS taxon_id FROM part UNION ALL SELECT s_name, 'pollinator', 'Animalia', s_suppkey FROM supplier")
def species_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    plants = manifest.tagged(table(spark, sf_dir, "part"), "p_name", "plant", "Plantae", "p_partkey")
    return rel.union_promoted(plants, manifest.tagged(table(spark, sf_dir, "supplier"), "s_name", "pollinator", "Animalia", "s_suppkey"))


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity < 5 THEN '' ELSE 'https://static.inaturalist.org/' || l_partkey || '/small.png' END AS a, 'https://static.inaturalist.org/r/' || l_suppkey || '/medium.png' AS b FROM lineitem)
SELECT l_orderkey AS key, regexp_replace(coalesce(nullif(a, ''), b), '/(small|medium)\\.png', '/large.png') AS image_url_large FROM p""")
def api_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    photos = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey AS key", "named_struct('identifier', CASE WHEN l_quantity < 5 THEN '' ELSE concat('https://static.inaturalist.org/', l_partkey, '/small.png') END, 'references', concat('https://static.inaturalist.org/r/', l_suppkey, '/medium.png')) AS photo")
    return manifest.from_api(photos.groupBy("key").agg(F.collect_list("photo").alias("media"))).select("key", "image_url_large")


@query("""
WITH p AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 10 THEN 'https://static.inaturalist.org/' || l_partkey || '/square.jpg' ELSE ' ' END AS url FROM lineitem),
r AS (SELECT o_custkey, o_orderkey, CAST(o_totalprice / 1000 AS INTEGER) AS votes, l_linenumber, url FROM orders JOIN p ON l_orderkey = o_orderkey WHERE trim(url) <> '')
SELECT o_custkey, o_orderkey, votes, replace(url, '/square', '/large') AS image_url FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY votes DESC, o_orderkey, l_linenumber, url) AS k FROM r) WHERE k = 1""")
def picked_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    photo = F.struct(F.col("l_linenumber").isNull().alias("unplaced"), "l_linenumber", F.expr("CASE WHEN l_quantity >= 10 THEN concat('https://static.inaturalist.org/', l_partkey, '/square.jpg') ELSE ' ' END").alias("url"))
    photos = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(photo)).alias("photos"))
    seen = table(spark, sf_dir, "orders").join(photos, F.col("l_orderkey") == F.col("o_orderkey")).withColumn("votes", F.rint(F.col("o_totalprice") / 1000).cast("int"))  # halves go to the even number, as in SQL's cast
    return manifest.picked_photos(seen, "o_custkey", "votes", "photos", "o_orderkey")


@query("SELECT CAST(i - 1 AS INTEGER) AS pos, min(embedding[i]) AS low, max(embedding[i]) AS high FROM embeddings, range(1, 65) r(i) GROUP BY i")
def vector_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.channel_ranges(table(spark, sf_dir, "embeddings"), "embedding")


@query("""
WITH x AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i)), m AS (SELECT i, min(v) AS lo, max(v) AS hi FROM x GROUP BY i)
SELECT vec_id, CAST(sum(CASE WHEN hi = lo THEN 0 ELSE floor((v - lo) / (hi - lo) * 255) END) AS BIGINT) AS total FROM x JOIN m USING (i) GROUP BY vec_id""")
def vector_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    whole = e.crossJoin(F.broadcast(vectors.channel_arrays(e, "v")))  # one row of arrays
    bytes_ = F.transform(F.arrays_zip("v", "low", "high"), lambda c: tensors.to_byte(c["v"], c["low"], c["high"]))
    return whole.select("vec_id", F.aggregate(bytes_, F.lit(0).cast("long"), lambda s, x: s + x).alias("total"))


DISTANCES = """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT q.vec_id AS q, t.vec_id AS t, round(1 - list_dot_product(q.v, t.v) / sqrt(list_dot_product(q.v, q.v) * list_dot_product(t.v, t.v)), 12) AS d, t.v AS tv FROM e q, e t"""
RANKED = """),
r AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY d, t) AS k FROM d)"""


@query(DISTANCES + " WHERE q.vec_id % 100 = 0" + RANKED + " SELECT q, t, CAST(k AS INTEGER) AS rank FROM r WHERE k <= 5")
def knn_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    found = vectors.nearest(e.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "q"), e.withColumnRenamed("vec_id", "t"), 5, "q", "embedding", "t", "embedding")
    return found.select("q", "t", "rank")


@query(DISTANCES + RANKED + " SELECT q, CAST(i - 1 AS INTEGER) AS pos, round(sum(tv[i] / (d + 1e-6)) / sum(1 / (d + 1e-6)), 4) AS value FROM r, range(1, 4) g(i) WHERE k <= 15 GROUP BY q, i")
def knn_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    training = e.withColumnRenamed("vec_id", "t")
    found = vectors.nearest(e.withColumnRenamed("vec_id", "q"), training, 15, "q", "embedding", "t", "embedding")
    return vectors.weighted_projection(found, training.withColumn("target", F.slice("embedding", 1, 3)), "q", "t", "target").withColumn("value", F.round("value", 4))


@query()
def pca_top3(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    mean, components = vectors.principal_components(e, "embedding")
    return vectors.projected(e, "embedding", mean, components).select("vec_id", *(F.round(f"component_{k}", 6).alias(f"component_{k}") for k in range(3)))


@query("SELECT vec_id, true AS fits, CAST(128 AS INTEGER) AS bytes, true AS close FROM embeddings")
def tensor_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = table(spark, sf_dir, "embeddings").withColumn("packed", tensors.pack_half("embedding")).withColumn("back", tensors.unpack_half("packed"))
    apart = F.array_max(F.zip_with("embedding", "back", lambda x, y: F.abs(x - y)))
    return packed.select("vec_id", tensors.packed_fits(F.col("packed"), F.array(F.lit(4), F.lit(16))).alias("fits"), F.length("packed").alias("bytes"), (apart < 0.001).alias("close"))


@query("SELECT vec_id, round(CAST(embedding[1] AS DOUBLE), 5) AS cls, round(CAST(embedding[6] AS DOUBLE), 5) AS first_patch, round(CAST(embedding[64] AS DOUBLE), 5) AS last_patch, CAST(1 AS INTEGER) AS rows FROM embeddings")
def grid_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = tensors.token_grid(F.col("embedding").cast("array<double>"), 1, 59)
    parts = table(spark, sf_dir, "embeddings").select("vec_id", grid.alias("g"))
    return parts.select("vec_id", F.round("g.cls", 5).alias("cls"), F.round(F.col("g.patches")[0][0], 5).alias("first_patch"), F.round(F.col("g.patches")[0][58], 5).alias("last_patch"), F.size("g.patches").alias("rows"))


@query("""
SELECT vec_id, round(1 / (1 + exp(-CAST(embedding[2] AS DOUBLE))), 6) AS flowering, round(1 / (1 + exp(-CAST(embedding[1] AS DOUBLE))), 6) AS fruiting,
  round((embedding[1] * 255.0 / 255 - 0.485) / 0.229, 5) AS red, round((embedding[3] * 255.0 / 255 - 0.406) / 0.225, 5) AS blue FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings) e""")
def label_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    p, n = tensors.label_probabilities(F.col("v")), tensors.pixels_normalised(F.transform(F.slice("v", 1, 3), lambda x: x * 255))
    out = e.select("vec_id", p.alias("p"), n.alias("n"))
    return out.select("vec_id", F.round("p.flowering", 6).alias("flowering"), F.round("p.fruiting", 6).alias("fruiting"), F.round(F.col("n")[0], 5).alias("red"), F.round(F.col("n")[2], 5).alias("blue"))


def checked_components(mean: np.ndarray, components: np.ndarray) -> bool:
    """Whether components are orthonormal, as tests ask."""
    return bool(np.allclose(components @ components.T, np.eye(len(components)), atol=1e-8)) and len(mean) == components.shape[1]
