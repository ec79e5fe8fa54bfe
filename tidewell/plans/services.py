"""Queries on services: items fetched by address, records by page and by id, files published.

The services are folders of the shared place, which each query first fills from the given tables; the readers
treat them as they treat web addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators.relational import numbered
from tidewell.plans.registry import query, table
from tidewell.session import fresh_path, materialise
from tidewell.sources import by_id, fetch, publish, sinks
from tidewell.sources.rest import record_stream, records


def site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, html, url) of all pages, of which the site lacks every tenth."""
    folder = fresh_path(spark, "site")
    pages = table(spark, sf_dir, "pages").select("page_id", "html", F.concat(F.lit(f"{folder}/"), "page_id", F.lit(".html")).alias("url"))
    there = pages.where("page_id % 10 <> 3").select(F.concat("page_id", F.lit(".html")).alias("path"), F.col("html").cast("binary").alias("content"))
    materialise(sinks.files(there, folder), "files")
    return pages


@query("""
SELECT page_id, CASE WHEN page_id % 10 = 3 THEN 'fail' ELSE 'ok' END AS status, CASE WHEN page_id % 10 = 3 THEN 'fail' ELSE 'skipped_exists' END AS again,
  CASE WHEN page_id % 10 <> 3 THEN strlen(html) END AS size_bytes, CASE WHEN page_id % 10 <> 3 THEN sha256(html) END AS sha256, CASE WHEN page_id % 10 = 3 THEN 'FileNotFoundError' END AS error FROM pages""")
def items_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, folder = site(spark, sf_dir).select("page_id", "url"), fresh_path(spark, "saved")
    first = materialise(fetch.saved(rows, "page_id", "url", folder, ("page_id", "url")), "first")
    again = materialise(fetch.saved(rows, "page_id", "url", folder), "again").select("page_id", F.col("status").alias("again"))
    return first.join(again, "page_id").select("page_id", "status", "again", "size_bytes", "sha256", "error")


@query("SELECT page_id, page_id % 10 <> 3 AS found, CASE WHEN page_id % 10 <> 3 THEN md5(html) END AS md5 FROM pages")
def items_fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fetch.contents(site(spark, sf_dir).select("page_id", "url"), "url")
    return found.select("page_id", F.col("error").isNull().alias("found"), F.md5("content").alias("md5"))


@query("""
SELECT CASE o_orderstatus WHEN 'F' THEN 'r1' ELSE 'r2' END AS run, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS left_here, true AS recorded FROM orders GROUP BY 1""")
def publish_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, here, remote = table(spark, sf_dir, "orders"), fresh_path(spark, "shards"), fresh_path(spark, "remote")
    for run, chosen in (("r1", "o_orderstatus = 'F'"), ("r2", "o_orderstatus <> 'F'")):
        sinks.bounded_shards(orders.where(chosen), here, run, 500)
        publish.publish(publish.local_files(spark, here), remote, run)
    recorded = publish.published(spark, remote).groupBy("run").agg(F.count("*").alias("files"))
    stay = publish.local_files(spark, here).agg(F.count("*").alias("left_here"))
    sums = spark.read.parquet(remote).groupBy("run").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    return sums.join(recorded, "run", "left").crossJoin(F.broadcast(stay)).select("run", "n", "keys", "left_here", (F.col("files") > 0).alias("recorded"))


@query("""
SELECT DISTINCT l_suppkey AS id, CASE WHEN s_acctbal >= 0 THEN s_name END AS name, CASE WHEN s_acctbal >= 0 THEN '{"key": ' || s_nationkey || '}' END AS nation, coalesce(s_acctbal >= 0, false) AS known, CAST(NULL AS VARCHAR) AS error
FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey""")
def details_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "taxa")
    body = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.struct(F.col("s_nationkey").alias("key")).alias("nation")))
    known = table(spark, sf_dir, "supplier").where("s_acctbal >= 0").select(F.concat("s_suppkey", F.lit(".json")).alias("path"), body.cast("binary").alias("content"))
    materialise(sinks.files(known, folder), "files")
    return by_id.details(table(spark, sf_dir, "lineitem"), "l_suppkey", folder, "name string, nation string")


@query("SELECT n_nationkey, n AS n_records, CASE WHEN n IS NULL THEN 'FileNotFoundError' END AS probe_error FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_acctbal > 9000 GROUP BY 1) ON c_nationkey = n_nationkey")
def count_probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "counts")
    counts = table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy("c_nationkey").agg(F.count("*").alias("count"))
    materialise(sinks.files(counts.select(F.concat("c_nationkey", F.lit(".json")).alias("path"), F.to_json(F.struct("count")).cast("binary").alias("content")), folder), "files")
    asked = table(spark, sf_dir, "nation").select("n_nationkey", F.concat(F.lit(f"{folder}/"), "n_nationkey", F.lit(".json")).alias("address"))
    return by_id.counted(asked, "address").drop("address")


def service(df: DataFrame, order: str, folder: str, per_page: int, repeated: int = 0) -> None:
    """Writes df as pages of a service. The first `repeated` records of a page stand at the end of the page before too, as pages shift while they're read."""
    rows = numbered(df, [order], "__at").withColumn("__record", F.struct(*df.columns))
    page = (F.col("__at") / per_page).cast("long")
    shown = rows.select("__at", page.alias("page"), "__record")
    if repeated:
        shown = shown.unionByName(rows.where((F.col("__at") % per_page < repeated) & (page > 0)).select("__at", (page - 1).alias("page"), "__record"))
    total = F.lit(df.count()).alias("total_results")
    pages = shown.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("__at", "__record"))).alias("r"))
    body = F.to_json(F.struct(total, F.lit(per_page).alias("per_page"), F.col("r.__record").alias("results")))
    materialise(sinks.files(pages.select(F.concat(F.lit("page_"), "page", F.lit(".json")).alias("path"), body.cast("binary").alias("content")), folder), "files")


SUPPLIERS = "SELECT s_suppkey AS id, s_name AS name FROM supplier"


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))


@query(SUPPLIERS)
def paged_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "service")
    service(suppliers(spark, sf_dir), "id", folder, 7, 2)
    return records(spark, folder, "id bigint, name string")


@query(SUPPLIERS)
def paged_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two starts of a stream; between them records were put before the others, so that all pages shifted."""
    folder, out = fresh_path(spark, "service"), fresh_path(spark, "stream")
    every = suppliers(spark, sf_dir)
    for known in (every.where("id % 3 > 0"), every):
        service(known, "id", folder, 5)
        found = record_stream(spark, folder, "id bigint, name string")
        found.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{out}/rows").awaitTermination()
    return spark.read.schema("id bigint, name string").parquet(f"{out}/rows")
