"""Queries that run a streaming stage to its end and give what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.plans.registry import query, table
from tidewell.session import fresh_path
from tidewell.streaming import jobs
from tidewell.streaming.done import DoneTable
from tidewell.streaming.pace import with_progress
from tidewell.streaming.stages import failures, stage, stored

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
RESULT = "event_id bigint, user_id bigint, cents bigint, error string"


def priced(rows: list[dict]) -> list[dict]:
    """A stage's work with failures: errors can't be priced, and one bad row makes its batch raise."""
    if any(r["event_type"] == "error" for r in rows):
        raise ValueError("unpriced")
    return [{"event_id": r["event_id"], "user_id": r["user_id"], "cents": round(r["value"] * 100), "error": None} for r in rows]


def staged(spark: SparkSession, sf_dir: str, starts: int = 2) -> str:
    out = fresh_path(spark, "stage")
    for _ in range(starts):  # the second run finds nothing new, and what failed fails again
        stage(spark, f"{sf_dir}/event[s].parquet", EVENTS, "event_id", priced, RESULT, out, f"{out}/checkpoint").awaitTermination()
    return out


@query("SELECT event_id, user_id, CAST(round(value * 100) AS BIGINT) AS cents FROM events WHERE event_type <> 'error'")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, f"{staged(spark, sf_dir)}/results", "event_id bigint, user_id bigint, cents bigint")


@query("SELECT event_id, 'ValueError: unpriced' AS error FROM events WHERE event_type = 'error'")
def stream_dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failures(spark, staged(spark, sf_dir), "event_id", "event_id bigint, error string")


@query("SELECT event_id, CAST(1 AS BIGINT) AS kept FROM events WHERE event_type = 'error'")
def stream_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that are kept for another try after three starts."""
    return stored(spark, f"{staged(spark, sf_dir, 3)}/again", "event_id bigint").groupBy("event_id").agg(F.count("*").alias("kept"))


HOURS = 6


@query(f"""
WITH e AS (SELECT user_id, ts, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k, min(ts) OVER (PARTITION BY user_id) + INTERVAL {HOURS} HOUR AS due, max(ts) OVER () AS last FROM events),
f AS (SELECT user_id, due, last, min(CASE WHEN event_type IN ('purchase', 'error') AND k > 1 AND ts <= due THEN k END) AS final FROM e GROUP BY ALL)
SELECT CAST(f.user_id AS VARCHAR) AS job, CASE e.event_type WHEN 'purchase' THEN 'ready' WHEN 'error' THEN 'failed' ELSE 'expired' END AS action,
  date_trunc('milliseconds', CASE WHEN final IS NULL THEN f.due ELSE e.ts END) AS at FROM f LEFT JOIN e ON e.user_id = f.user_id AND k = final WHERE final IS NOT NULL OR f.due < f.last""")
def job_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user a job that is submitted by their first event; purchases are final answers, errors failures, and what has none in six hours expires."""
    out = fresh_path(spark, "jobs")
    status = F.when(F.col("event_type") == "purchase", "SUCCEEDED").when(F.col("event_type") == "error", "FAILED").otherwise("RUNNING")
    rows = spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/event[s].parquet").select(F.col("user_id").cast("string").alias("job"), F.col("ts").cast("timestamp").alias("at"), "event_type", status.alias("status"), F.col("event_id").alias("seq"))
    events = rows.select("job", "at", F.lit("answer").alias("kind"), "status", "seq")
    before = spark.conf.get(jobs.STORE)
    jobs.with_timers(spark)
    try:
        found = jobs.tracked(events, poll=10**9, expire=HOURS * 3600, keep=10**9, first_submits=True)
        found.writeStream.option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).format("parquet").start(f"{out}/actions").awaitTermination()
    finally:
        spark.conf.set(jobs.STORE, before)
    return stored(spark, f"{out}/actions", jobs.ACTIONS).where("action IN ('ready', 'failed', 'expired')").select("job", "action", F.col("at").cast("timestamp_ntz").alias("at"))


@query("SELECT event_id FROM events WHERE event_type NOT IN ('purchase', 'error')")
def done_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events without those that were done in two batches, by filters of the files of keys."""
    done, e = DoneTable(spark, fresh_path(spark, "done"), "event_id", "bigint"), table(spark, sf_dir, "events")
    for kind in ("purchase", "error"):
        done.add(e.where(F.col("event_type") == kind).select("event_id"), kind)
    return done.unseen(e.select("event_id"))


@query("""
SELECT o_orderpriority, count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS done, round(count(*) FILTER (o_orderstatus = 'F') / 60.0, 6) AS rate,
  round((count(*) - count(*) FILTER (o_orderstatus = 'F')) / (count(*) FILTER (o_orderstatus = 'F') / 60.0), 6) AS seconds_left FROM orders GROUP BY 1""")
def progress_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("done"))
    return with_progress(counts, F.col("total"), F.col("done"), F.lit(60.0)).withColumns({"rate": F.round("rate", 6), "seconds_left": F.round("seconds_left", 6)})
