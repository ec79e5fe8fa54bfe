"""Tables that are replaced only when their content changes, at once for every reader.

A version is written to a folder of its own; a small file names the current one and is renamed into place.
Readers resolve it once, so they see all of the old table or all of the new one. Content is compared by a
digest that doesn't depend on the order of rows: their number, and sum and exclusive or of their hashes.
"""

from __future__ import annotations

import hashlib
import json
import posixpath
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewell.session import dropped
from tidewell.sources.places import place, sizes_below, written

POINTER = "_current.json"


def digest(df: DataFrame) -> str:
    """Of rows in any order, and of names and types of columns in theirs. Map columns can't be compared."""
    h = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns), *(F.col(f"`{c}`").isNull() for c in df.columns))
    n, total, mixed = df.agg(F.count("*"), F.sum(h.cast("decimal(38,0)")), F.bit_xor(h)).first()
    return hashlib.sha256(f"{df.schema.simpleString()}|{n}|{total}|{mixed}".encode()).hexdigest()


def pointer(folder: str) -> dict | None:
    """What the current version is; null before the first."""
    store, path = place(f"{folder.rstrip('/')}/{POINTER}")
    if not store.get_file_info(path).is_file:
        return None
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


def replace(df: DataFrame, folder: str) -> bool:
    """Whether df differed from the current table and took its place. What is compared is what was written, so df is run once."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    at = f"{folder.rstrip('/')}/versions/{version}"
    df.write.parquet(at)
    new = spark.read.schema(df.schema).parquet(at)
    seen, now = digest(new), pointer(folder)
    if now is not None and now["digest"] == seen:
        dropped(spark, at)
        return False
    before = [] if now is None else [*now["before"], now["version"]]
    record = {"version": version, "digest": seen, "schema": new.schema.json(), "before": before}
    written(f"{folder.rstrip('/')}/{POINTER}", json.dumps(record).encode())
    return True


def current(spark: SparkSession, folder: str) -> DataFrame:
    """The current table; it stays this one while it's read, whatever is replaced meanwhile."""
    now = pointer(folder)
    if now is None:
        raise FileNotFoundError(f"no table was written to {folder}")
    return spark.read.schema(StructType.fromJson(json.loads(now["schema"]))).parquet(f"{folder.rstrip('/')}/versions/{now['version']}")


def tidied(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Removes versions before the last `keep` ones and the current; how many. Readers of removed versions fail, so keep more than a reader's time."""
    now = pointer(folder)
    old = [] if now is None else now["before"][: max(0, len(now["before"]) - keep)]
    for version in old:
        dropped(spark, f"{folder.rstrip('/')}/versions/{version}")
    if old:
        written(f"{folder.rstrip('/')}/{POINTER}", json.dumps({**now, "before": now["before"][len(old) :]}).encode())
    return len(old)


def archived(path: str, folder: str) -> str | None:
    """Copies a file to folder/<sha256>/<name>, unless a file of that content is there; where it stands now, null if nothing was copied."""
    from tidewell.sources.fetch import opened, streamed

    sha, name = hashlib.sha256(), posixpath.basename(path)
    with opened(path) as f:
        while part := f.read(1 << 20):
            sha.update(part)
    target = f"{folder.rstrip('/')}/{sha.hexdigest()}/{name}"
    if any(p.split("/")[0] == sha.hexdigest() for p in sizes_below(folder)):
        return None
    with opened(path) as f:
        streamed(f, target)
    return target
