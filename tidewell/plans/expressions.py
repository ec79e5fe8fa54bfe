"""Queries of the column expressions: names, numbers, localities, addresses, run stamps, logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.functions import files, names
from tidewell.plans.registry import query, table

FORMS = """concat(upper(substring(p_name, 1, 1)), substring(p_name, 2), CASE p_type WHEN 'ECONOMY' THEN ' var. alba' WHEN 'SMALL' THEN ' subsp. minor' WHEN 'MEDIUM' THEN ' f. rosea'
  WHEN 'PROMO' THEN ' x hybrida' WHEN 'LARGE' THEN CASE WHEN p_size > 25 THEN ' × nova' ELSE ' SSP. big' END ELSE '' END)"""


@query(f"""
WITH n AS (SELECT p_partkey, p_size, CASE WHEN p_size = 1 THEN split_part(p_name, ' ', 1) WHEN p_size = 2 THEN upper(p_name) WHEN p_size = 3 THEN '  ' ELSE {FORMS} END AS name FROM part)
SELECT p_partkey, name, CASE WHEN trim(name) = '' THEN 'unknown' WHEN contains(name, ' var. ') THEN 'variety' WHEN contains(name, ' subsp. ') OR contains(name, ' ssp. ') THEN 'subspecies'
  WHEN contains(name, ' f. ') OR contains(name, ' forma ') THEN 'form' WHEN contains(name, '×') OR contains(name, ' x ') THEN 'hybrid'
  WHEN regexp_matches(trim(name), '^\\S+\\s+\\p{{Ll}}') THEN 'species' WHEN NOT regexp_matches(trim(name), '\\s') THEN 'genus' ELSE 'unknown' END AS rank FROM n""")
def rank_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.expr(f"CASE WHEN p_size = 1 THEN split_part(p_name, ' ', 1) WHEN p_size = 2 THEN upper(p_name) WHEN p_size = 3 THEN '  ' ELSE {FORMS} END")
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name")).withColumn("rank", names.derived_rank(F.col("name")))


@query(f"""
WITH n AS (SELECT p_partkey, {FORMS} AS name FROM part),
v AS (SELECT p_partkey, name, CASE WHEN regexp_matches(name, '(?i)\\s+(var\\.|subsp\\.|ssp\\.|f\\.|forma)\\s+') THEN trim(regexp_extract(name, '(?i)^(.*?)\\s+(?:var\\.|subsp\\.|ssp\\.|f\\.|forma)\\s+', 1)) END AS head,
  CASE WHEN contains(name, '×') OR contains(name, ' x ') THEN trim(replace(replace(name, '×', ''), ' x ', ' ')) END AS plain,
  CASE WHEN len(string_split_regex(name, '\\s+')) > 2 THEN array_to_string(string_split_regex(name, '\\s+')[1:2], ' ') END AS two FROM n)
SELECT p_partkey, concat_ws('|', name, CASE WHEN head <> name THEN head END, CASE WHEN plain <> name AND plain IS DISTINCT FROM head THEN plain END,
  CASE WHEN two <> name AND two IS DISTINCT FROM head AND two IS DISTINCT FROM plain THEN two END) AS variants FROM v""")
def name_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(names.name_variants(F.expr(FORMS)), "|").alias("variants"))


PARTS = {
    "rank": "CASE p_type WHEN 'ECONOMY' THEN 'VARIETY' WHEN 'SMALL' THEN 'subspecies' WHEN 'MEDIUM' THEN 'Forma' WHEN 'PROMO' THEN 'CULTIVAR' WHEN 'STANDARD' THEN 'SPECIES' ELSE 'GENUS' END",
    "species": "CASE WHEN p_size = 4 THEN ' ' WHEN p_size = 5 THEN NULL ELSE p_name END",
    "genus": "CASE WHEN p_size = 5 THEN NULL ELSE split_part(p_name, ' ', 1) END",
    "infra": "CASE WHEN p_size < 40 THEN lower(p_brand) WHEN p_size < 45 THEN '' END",
    "cultivar": "CASE WHEN p_type = 'PROMO' AND p_size > 10 THEN p_brand END",
    "scientific": "CASE WHEN p_size = 5 THEN NULL ELSE concat(p_name, ' L. (1753)') END",
}
CLEAN = "\n".join(
    ["WITH r AS (SELECT p_partkey, " + ", ".join(f"nullif(trim({v}), '') AS {k}" for k, v in PARTS.items()) + " FROM part)", "SELECT p_partkey, scientific, CASE WHEN upper(rank) = 'VARIETY' AND species IS NOT NULL AND infra IS NOT NULL THEN species || ' var. ' || infra",
     "WHEN upper(rank) = 'SUBSPECIES' AND species IS NOT NULL AND infra IS NOT NULL THEN species || ' subsp. ' || infra WHEN upper(rank) IN ('FORM', 'FORMA') AND species IS NOT NULL AND infra IS NOT NULL THEN species || ' f. ' || infra",
     "WHEN cultivar IS NOT NULL AND genus IS NOT NULL THEN genus || ' ''' || cultivar || '''' WHEN upper(rank) = 'SPECIES' AND species IS NOT NULL THEN species WHEN upper(rank) = 'GENUS' AND genus IS NOT NULL THEN genus ELSE coalesce(species, genus, scientific, '') END AS clean FROM r"]
)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", *(F.expr(v).alias(k) for k, v in PARTS.items()))
    return parts.select("p_partkey", F.trim("scientific").alias("scientific"), names.clean_name(*(F.col(k) for k in PARTS)).alias("clean"))


@query(f"SELECT p_partkey, clean FROM ({CLEAN}) c")
def clean_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).select("p_partkey", "clean")


AUTHOR = r"(\d{4}\)?|[A-Z]\.\s|Linn|et al\.|ex\s+[A-Z])"


@query(f"SELECT count(*) AS rows, count(*) FILTER (regexp_matches(scientific, '{AUTHOR}')) AS before, count(*) FILTER (regexp_matches(clean, '{AUTHOR}')) AS after FROM ({CLEAN}) c")
def authority_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).agg(F.count("*").alias("rows"), F.count_if(names.has_authority(F.col("scientific"))).alias("before"), F.count_if(names.has_authority(F.col("clean"))).alias("after"))


HEIGHT = "CASE WHEN p_size < 5 THEN p_type WHEN p_size < 10 THEN NULL ELSE concat(p_type, ' ', CAST(p_size AS VARCHAR(9)), '.5 - 236 ft') END"


@query(f"""
WITH h AS (SELECT p_partkey, {HEIGHT} AS t, CASE WHEN p_size < 20 THEN CAST(p_size AS VARCHAR) || '.0' WHEN p_size < 30 THEN CAST(p_size AS VARCHAR) || '.25' WHEN p_size < 40 THEN p_name ELSE CAST(p_size AS VARCHAR) END AS n,
  CASE p_type WHEN 'ECONOMY' THEN ' Yes' WHEN 'SMALL' THEN '1' WHEN 'MEDIUM' THEN 'FALSE ' WHEN 'PROMO' THEN 'maybe' WHEN 'LARGE' THEN 'no' END AS s FROM part)
SELECT p_partkey, TRY_CAST(nullif(regexp_extract(t, '-?\\d+(?:\\.\\d+)?'), '') AS DOUBLE) AS height,
  CASE WHEN TRY_CAST(n AS DOUBLE) = floor(TRY_CAST(n AS DOUBLE)) THEN CAST(TRY_CAST(n AS DOUBLE) AS BIGINT) END AS whole,
  CASE WHEN lower(trim(s)) IN ('yes', 'true', '1') THEN true WHEN lower(trim(s)) IN ('no', 'false', '0') THEN false END AS state FROM h""")
def numeric_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.expr("CASE WHEN p_size < 20 THEN concat(p_size, '.0') WHEN p_size < 30 THEN concat(p_size, '.25') WHEN p_size < 40 THEN p_name ELSE CAST(p_size AS STRING) END")
    s = F.expr("CASE p_type WHEN 'ECONOMY' THEN ' Yes' WHEN 'SMALL' THEN '1' WHEN 'MEDIUM' THEN 'FALSE ' WHEN 'PROMO' THEN 'maybe' WHEN 'LARGE' THEN 'no' END")
    return table(spark, sf_dir, "part").select("p_partkey", names.first_number(F.expr(HEIGHT)).alias("height"), names.lenient_long(n).alias("whole"), names.tri_state(s).alias("state"))


PLACE = "concat(text, CASE lang WHEN 'en' THEN ' Kern Co., California' WHEN 'fr' THEN ' éCA' WHEN 'de' THEN ' Baja  California, CA' ELSE ' Calif.' END)"


@query(f"""
SELECT doc_id, regexp_matches({PLACE}, '(?i)\\b(California|Calif\\.|\\bCA\\b)\\b') AND NOT regexp_matches({PLACE}, '(?i)Baja\\s+California') AS in_state,
  regexp_matches(text, '(?i)\\b(?:that|oui|pour|für|niño|de la)\\b') AS has_word FROM documents""")
def locality_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.col("text").rlike(names.ascii_word(["that", "oui", "pour", "für", "niño", "de la"]))
    return table(spark, sf_dir, "documents").select("doc_id", names.in_state(F.expr(PLACE)).alias("in_state"), word.alias("has_word"))


PHOTO = "concat(CASE WHEN page_id < 10 THEN 'https://example.org' ELSE 'https://static.inaturalist.org' END, '/observations/', page_id, '/', split_part(url, '/', 3), CASE WHEN length(url) < 40 THEN '/Square.JPEG?1' WHEN length(url) < 50 THEN '/small.png' ELSE '/medium.gif' END)"


@query(f"""
WITH p AS (SELECT page_id, {PHOTO} AS u FROM pages),
x AS (SELECT *, CASE WHEN contains(u, 'inaturalist') THEN regexp_replace(u, '/(small|medium|large|original|square)\\.(jpe?g|png|gif|webp)', '/large.\\2', 'gi') END AS large, lower(split_part(regexp_extract(u, '[^.]*$'), '?', 1)) AS e FROM p)
SELECT page_id, large, CASE WHEN large IS NOT NULL THEN regexp_replace(u, '/(small|medium|large|original|square)\\.(jpe?g|png|gif|webp)', '/original.\\2', 'gi') END AS original,
  TRY_CAST(nullif(regexp_extract(u, 'observations/(\\d+)', 1), '') AS BIGINT) AS observation,
  lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || '/' || page_id || '_' || substring(md5(u), 1, 8) || '.' || CASE WHEN e IN ('png', 'gif', 'webp', 'jpg') THEN e ELSE 'jpg' END AS path FROM x""")
def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages").select("page_id", F.expr(PHOTO).alias("u"))
    u = F.col("u")
    return p.select("page_id", files.photo_url(u).alias("large"), files.photo_url(u, "original").alias("original"), files.observation_id(u).alias("observation"), files.photo_path(F.col("page_id"), u).alias("path"))


@query("""
SELECT event_id, strftime(ts, '%Y%m%dT%H%M%S') AS stamp,
  regexp_extract(CASE WHEN event_type = 'view' THEN 'embeddings_' || lpad(CAST(event_id AS VARCHAR), 6, '0') || '.parquet' ELSE 'a/embeddings_' || strftime(ts, '%Y%m%dT%H%M%S') || '_000001.parquet' END, 'embeddings_(\\d{8}T\\d{6})_', 1) AS run,
  CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS leading FROM events""")
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("stamp", files.run_stamp(F.col("ts")))
    shard = F.when(F.col("event_type") == "view", F.concat(F.lit("embeddings_"), F.lpad(F.col("event_id").cast("string"), 6, "0"), F.lit(".parquet"))).otherwise(F.concat(F.lit("a/embeddings_"), "stamp", F.lit("_000001.parquet")))
    photo = F.concat(F.lit("x/"), F.when(F.col("event_type") == "error", "photo").otherwise(F.col("event_id").cast("string")), F.lit("_ab12.jpg"))
    return e.select("event_id", "stamp", files.run_id(shard).alias("run"), files.leading_id(photo).alias("leading"))


@query("""
WITH j AS (SELECT event_id, CASE event_type WHEN 'view' THEN '{"url": "u' || event_id || '"}' WHEN 'click' THEN '{"url": "u", "image_url_large": "l' || event_id || '"}' WHEN 'error' THEN '{not json' ELSE props END AS side, props FROM events)
SELECT event_id, CASE WHEN json_valid(side) THEN coalesce(json_extract_string(side, '$.image_url_large'), json_extract_string(side, '$.url')) END AS url, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM j""")
def json_log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    side = F.expr("""CASE event_type WHEN 'view' THEN concat('{"url": "u', event_id, '"}') WHEN 'click' THEN concat('{"url": "u", "image_url_large": "l', event_id, '"}') WHEN 'error' THEN '{not json' ELSE props END""")
    return table(spark, sf_dir, "events").select("event_id", files.sidecar_url(side).alias("url"), F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("SELECT doc_id, sha256(text) AS sha, substring(md5(text), 1, 8) AS short FROM documents")
def content_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", files.content_sha256(F.col("text").cast("binary")).alias("sha"), files.url_hash(F.col("text")).alias("short"))
