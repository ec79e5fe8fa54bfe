"""Session settings, and the shared folder that cuts of lineage are written to."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

PACKAGE_ROOT = str(Path(__file__).resolve().parents[1])


def build(cpus: int | str = "*", app: str = "tidewell", **conf: str) -> SparkSession:
    """A local session with the settings that the queries assume (UTC, AQE, Arrow)."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    return ready(builder.config(map=settings).getOrCreate())


#: Rows in an Arrow batch, where the session has Spark's own default: texts are long, and each batch is held several times over.
BATCH_ROWS = "2000"
ROWS_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: What Python workers start with: freed memory goes back to the system at once, be it numpy's, Arrow's or a
#: tokenizer thread's, as workers live on from job to job; and tokenizers take two threads, as tasks have the other cores.
WORKERS = {
    "MALLOC_ARENA_MAX": "2",
    "MALLOC_MMAP_THRESHOLD_": "1048576",
    "MALLOC_TRIM_THRESHOLD_": "4194304",
    "ARROW_DEFAULT_MEMORY_POOL": "system",
    "RAYON_NUM_THREADS": "2",
}


def ready(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package wherever the driver was started, and keeps their memory low.

    On a cluster ship the package with --py-files; the path is then merely unused.
    """
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([PACKAGE_ROOT, *filter(None, paths)])
    for name, value in WORKERS.items():
        env.setdefault(name, value)
    if spark.conf.get(ROWS_SETTING) == "10000":
        spark.conf.set(ROWS_SETTING, BATCH_ROWS)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only where the setting is absent (local tests) a temporary folder is made.
    """
    sc = spark.sparkContext
    set_to = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not set_to:
        set_to = tempfile.mkdtemp(prefix="spark-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(set_to)
    return set_to


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut, every executor may be lost.

    df is not run again, so its shuffle files may go as soon as it's written.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Removes a folder with all in it, in any store that Spark reads; nothing happens if there is none."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
