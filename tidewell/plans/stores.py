"""Queries on archives, shards, versioned tables and samples. Each first writes the given tables in the form it's about."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.operators import sampling
from tidewell.plans.registry import query, table
from tidewell.session import fresh_path, materialise
from tidewell.sources import archives, replaced, sinks, workbooks
from tidewell.sources.places import written
from tidewell.sources.projection import projection


@query("SELECT c_custkey, c_name, CAST(CASE WHEN c_acctbal > 0 THEN c_acctbal END AS DOUBLE) AS c_acctbal FROM customer")
def archive_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deflated and stored archives, read back by the executors with columns in another order."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("c_acctbal"), "c_name", "c_mktsegment")
    folder = fresh_path(spark, "archives")
    odd = F.pmod(F.xxhash64("c_custkey"), F.lit(2)) == 1
    made = materialise(sinks.archives(rows.where(odd), folder, "dwca/occurrence.txt"), "made")
    made = made.unionByName(materialise(sinks.archives(rows.where(~odd), folder, "occurrence.txt", stored=True), "made"))
    paths = [r.path for r in made.select("path").collect()]  # an archive a partition
    return archives.zip_table(spark, paths, "occurrence.txt", "c_custkey bigint, c_name string, c_acctbal double", split_bytes=1 << 20)


@query("SELECT s_name, CAST(s_suppkey AS VARCHAR) AS s_suppkey, CASE WHEN s_acctbal > 0 THEN s_phone END AS s_phone FROM (SELECT *, s_name || ' <&> é' AS s_phone FROM supplier)")
def workbook_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks with notes before the headings, read back as text."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.when(F.col("s_acctbal") > 0, F.concat("s_name", F.lit(" <&> é"))).alias("s_phone"))
    made = materialise(sinks.workbooks(s.repartition(3, "s_suppkey"), fresh_path(spark, "workbooks"), 5), "made")
    return workbooks.workbook(spark, [r.path for r in made.select("path").collect()], header=5).select("s_name", "s_suppkey", "s_phone")  # a workbook a partition


PLACE = "CAST(('0x' || left(md5('{seed}:' || {key}), 15)) AS BIGINT)"


@query(f"SELECT l_orderkey, l_linenumber FROM lineitem ORDER BY {PLACE.format(seed=7, key='l_orderkey || chr(31) || l_linenumber')}, l_orderkey, l_linenumber LIMIT 1000")
def exact_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.exact_sample(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], 1000, 7).select("l_orderkey", "l_linenumber")


@query(f"""
WITH c AS (SELECT l_suppkey, {PLACE.format(seed=3, key='l_suppkey')} AS h, count(*) AS n FROM lineitem GROUP BY l_suppkey),
s AS (SELECT l_suppkey, sum(n) OVER (ORDER BY h) - n AS before FROM c)
SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem JOIN s USING (l_suppkey) WHERE before < 3000
ORDER BY {PLACE.format(seed=3, key='l_orderkey || chr(31) || l_linenumber')}, l_orderkey, l_linenumber LIMIT 500""")
def cluster_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sampling.cluster_sample(table(spark, sf_dir, "lineitem"), "l_suppkey", ["l_orderkey", "l_linenumber"], 3000, 500, 3)
    return found.select("l_suppkey", "l_orderkey", "l_linenumber")


@query("SELECT 'rows' AS what, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders UNION ALL SELECT 'failures', 2, NULL")
def shard_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of two runs, among which a cut one and one that's none of Parquet."""
    folder = fresh_path(spark, "shards")
    orders = table(spark, sf_dir, "orders")
    for run, chosen in (("r1", "o_orderstatus = 'F'"), ("r2", "o_orderstatus <> 'F'")):
        sinks.bounded_shards(orders.where(chosen), folder, run, 2000)
    written(f"{folder}/run=r1/cut.parquet", b"PAR1" + b"\0" * 50)
    written(f"{folder}/run=r2/other.parquet", b"<html>")
    rows, failures = projection(spark, folder, "o_orderkey bigint, o_missing string")
    good = rows.where("o_missing IS NULL").agg(F.lit("rows").alias("what"), F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
    return good.unionByName(failures.agg(F.lit("failures").alias("what"), F.count("*").alias("n"), F.lit(None).cast("long").alias("keys")))


@query("""
SELECT * FROM (VALUES (1, true), (2, false), (3, true)) v(step, replaced), (SELECT count(*) AS n_rows FROM supplier) WHERE step < 3
UNION ALL SELECT 3, true, count(*) FROM supplier WHERE s_suppkey > 3""")
def replaced_if_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written, written again in another order, and changed."""
    folder, s = fresh_path(spark, "table"), table(spark, sf_dir, "supplier")
    out = None
    for step, df in enumerate((s, s.repartition(5, "s_nationkey"), s.where("s_suppkey > 3")), 1):
        took = replaced.replace(df, folder)
        row = replaced.current(spark, folder).agg(F.lit(step).alias("step"), F.lit(took).alias("replaced"), F.count("*").alias("n_rows"))
        out = row if out is None else out.unionByName(row)
    return out
