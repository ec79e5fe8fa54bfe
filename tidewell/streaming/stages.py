"""Resumable stages over files: each takes what the one before wrote, once by key, whatever restarts come between.

A stage is a stream over a folder of Parquet files. Every micro-batch drops repeated keys and those that the
done-table has (so the state is a table and not memory; see done.py), works on the rest, and appends
results, failures and the done keys. Failed keys aren't done: their rows are kept and tried again when the
stage is next started, one row a key, and then stand in that start's place. Output is named by the stream's id
in its checkpoint and the batch, so a batch that is repeated after a crash overwrites its own, and a new
checkpoint no one's.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewell.session import dropped, materialise, ready
from tidewell.streaming.done import DoneTable
from tidewell.streaming.pace import room

Work = Callable[[list[dict]], list[dict]]


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, empty while nothing was written. Columns that an older one lacks are null, so legacy rows resume nothing."""
    empty = spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).parquet(path).select(*empty.columns)
    except AnalysisException:
        return empty


def worked(df: DataFrame, work: Work, schema: str, batch_rows: int = 256) -> DataFrame:
    """Rows of work(batch) for batches of rows; `schema` names its fields, of which `error` is null for good ones.

    If a whole batch raises, its rows are tried one by one, so a bad row costs itself alone.
    """
    ready(df.sparkSession)
    target = df.sparkSession.createDataFrame([], schema).schema
    names, kinds = target.names, _arrow(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, batch_rows):
                rows = batch.slice(at, batch_rows).to_pylist()
                try:
                    done = work(rows)
                except Exception:
                    done = []
                    for row in rows:
                        try:
                            done += work([row])
                        except Exception as e:
                            done.append({**{k: row.get(k) for k in names}, "error": f"{type(e).__name__}: {e}"})
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in done], t) for n, t in zip(names, kinds, strict=True)], names)

    return df.mapInArrow(run, schema)


def _arrow(spark: SparkSession, schema: str) -> list[pa.DataType]:
    from pyspark.sql.pandas.types import to_arrow_schema

    return [f.type for f in to_arrow_schema(spark.createDataFrame([], schema).schema)]


def stage(
    spark: SparkSession,
    source: str,
    source_schema: str,
    key: str,
    work: Work,
    result_schema: str,
    out: str,
    checkpoint: str,
    seconds: float = 0,
    files_per_trigger: int | None = None,
    shard_rows: int = 10_000,
    size: str | None = None,
    portion_bytes: int = 1 << 30,
    free: Callable[[], int] | None = None,
) -> StreamingQuery:
    """Starts a stage. seconds = 0 takes all there is and stops; otherwise it polls. Writes out/results, out/failed and out/done.

    Given `size` (a column of bytes) a batch is worked on in portions of about portion_bytes, and given `free` each waits
    until that many bytes are free, so what a stage writes ahead of those who take it away is bounded.
    """
    kind = spark.createDataFrame([], source_schema).schema[key].dataType.simpleString()
    reader = spark.readStream.schema(source_schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)

    def write(df: DataFrame, name: str, label: str) -> None:
        out_of = df.withColumn("batch", F.lit(label)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", shard_rows)
        out_of.partitionBy("batch").parquet(f"{out}/{name}")

    def take(rows: DataFrame, label: str) -> None:
        s = rows.sparkSession
        done = DoneTable(s, f"{out}/done", key, kind)
        fresh = done.unseen(rows.dropDuplicates([key]), label)  # a batch that is repeated does its own again
        path = f"{out}/batches/{label}"
        worked(fresh, work, result_schema).write.mode("overwrite").parquet(path)  # work is done once, a retry overwrites
        found = s.read.schema(result_schema).parquet(path)
        good, bad = found.where("error IS NULL"), found.where("error IS NOT NULL")
        write(good.drop("error"), "results", label)
        write(bad, "failed", label)
        write(rows.join(bad.select(key), key, "left_semi").dropDuplicates([key]), "again", label)
        done.add(good.select(key, F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("done_utc")), label)

    def each(batch: DataFrame, number: int) -> None:
        stream = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first().value)["id"]
        if size is None:
            take(batch, f"{stream}-{number}")
            return
        total = batch.agg(F.sum(F.col(size).cast("long"))).first()[0] or 0
        portions = max(1, -(-total // portion_bytes))  # by the batch alone, so a batch that is repeated has the same
        for k in range(portions):
            if free is not None:
                room(free, min(portion_bytes, total))
            take(batch.where(F.pmod(F.xxhash64(key), F.lit(portions)) == k), f"{stream}-{number}-{k}")

    tried = stored(spark, f"{out}/again", f"{source_schema}, batch string")
    labels = [r.batch for r in tried.select("batch").distinct().collect()]  # one for each micro-batch with failures since the last start
    kept = tried.drop("batch").dropDuplicates([key])
    kept = DoneTable(spark, f"{out}/done", key, kind).unseen(kept)
    kept = kept.join(stored(spark, f"{out}/results", f"`{key}` {kind}"), key, "left_anti")  # results without a done key: the stage ended between the two
    if not kept.isEmpty():
        take(materialise(kept, "again"), f"again-{uuid.uuid4().hex}")
    for label in labels:  # what still fails stands under the new label
        dropped(spark, f"{out}/again/batch={label}")

    writer = reader.parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=f"{seconds} seconds") if seconds else writer.trigger(availableNow=True)).start()


def failures(spark: SparkSession, out: str, key: str, schema: str) -> DataFrame:
    """What has failed and isn't done since, one row a key."""
    had = stored(spark, f"{out}/failed", schema)
    return DoneTable(spark, f"{out}/done", key, had.schema[key].dataType.simpleString()).unseen(had.dropDuplicates([key]))


def progress(manifest: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """One row: addresses in the manifest, of them done, and left."""
    wanted, had = manifest.select(key).distinct(), done.select(key).distinct().withColumn("had", F.lit(True))
    return wanted.join(had, key, "left").agg(F.count("*").alias("total"), F.count("had").alias("done"), F.count_if(F.col("had").isNull()).alias("pending"))


def orphans(files: DataFrame, done: DataFrame, key: str, url: str = "url") -> DataFrame:
    """One row that sorts files: done (may be deleted), pending, without sidecar address; and the bytes that deletion frees."""
    marked = files.join(done.select(F.col(key).alias("__done")).distinct(), F.col(url) == F.col("__done"), "left")
    had = F.col("__done").isNotNull()
    return marked.agg(F.count("*").alias("total"), F.count_if(had).alias("deletable"), F.count_if(~had & F.col(url).isNotNull()).alias("pending"), F.count_if(F.col(url).isNull()).alias("no_address"), F.coalesce(F.sum(F.when(had, F.col("length"))), F.lit(0)).alias("freed_bytes"))
