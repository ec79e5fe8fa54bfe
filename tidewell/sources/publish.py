"""Publishing files in two phases, as a Spark data source to write to.

    publish(local, remote, run)          # local: (name, path, size_bytes)

A task copies its files to a folder of its own attempt under remote/_staging/<run>. The commit moves them to
their names, lists the remote side again, confirms each name with its size, writes one record of the run and
only then frees the local files. An abort removes what was staged and nothing else. So a task that is killed,
an attempt that runs twice and a commit that is repeated change nothing: what the remote side has in the same
size isn't copied again, and local files go only once they're confirmed.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidewell.session import ready
from tidewell.sources.places import place, removed, size_of, sizes_below, written

LOCAL = "name string, path string, size_bytes long"
CHUNK = 8 << 20


@dataclass
class Staged(WriterCommitMessage):
    """Files of an attempt: (name, staged address or null where the remote side has it, local address, bytes)."""

    files: list[tuple[str, str | None, str, int]]


class PublishSink(DataSource):
    """Options: remote (a folder), run (a name), free (whether confirmed local files are removed)."""

    @classmethod
    def name(cls) -> str:
        return "publish"

    def schema(self) -> str:
        return LOCAL

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return PublishWriter(dict(self.options))


def copied(source: str, target: str) -> int:
    """Copies in chunks; the bytes copied."""
    (from_store, from_path), (to_store, to_path) = place(source), place(target)
    to_store.create_dir(posixpath.dirname(to_path), recursive=True)
    size = 0
    with from_store.open_input_stream(from_path) as f, to_store.open_output_stream(to_path) as out:
        while part := f.read(CHUNK):
            out.write(part)
            size += len(part)
    return size


class PublishWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.remote, self.run, self.free = options["remote"].rstrip("/"), options["run"], options.get("free", "true") == "true"
        self.staging = f"{self.remote}/_staging/{self.run}"

    def write(self, iterator: Iterator) -> Staged:
        attempt, files = f"{self.staging}/{uuid.uuid4().hex}", []
        for row in iterator:
            name, path, size = row["name"], row["path"], row["size_bytes"]
            if not name or name.startswith("/") or any(x in ("", "..") or x.startswith("_") for x in name.split("/")):
                raise ValueError(f"{name!r} can't be the name of a published file")
            had = size_of(f"{self.remote}/{name}")
            if had is not None and had == size:
                files.append((name, None, path, size))
                continue
            staged = f"{attempt}/{name}"
            got = copied(path, staged)
            if size is not None and got != size:
                raise OSError(f"{path} has {got} bytes, not {size}")
            files.append((name, staged, path, got))
        return Staged(files)

    def commit(self, messages: list[Staged | None]) -> None:
        files = [f for m in messages if m for f in m.files]
        for name, staged, _, size in files:
            if staged is not None and size_of(staged) is not None:
                (store, from_path), (_, to_path) = place(staged), place(f"{self.remote}/{name}")
                store.create_dir(posixpath.dirname(to_path), recursive=True)
                removed(f"{self.remote}/{name}")  # of another size
                store.move(from_path, to_path)
            elif staged is not None and size_of(f"{self.remote}/{name}") != size:
                raise OSError(f"{name} is neither staged nor published")
        there = sizes_below(self.remote)
        sound = [(name, path, size) for name, _, path, size in files if there.get(name) == size]
        if len(sound) < len(files):
            raise OSError(f"{len(files) - len(sound)} files aren't confirmed; local files stay")
        record = {"run": self.run, "files": [{"name": name, "size_bytes": size} for name, _, size in sorted(sound)]}
        written(f"{self.remote}/_runs/{self.run}.json", json.dumps(record).encode())
        if self.free:
            for _, path, _ in sound:
                removed(path)
        removed(self.staging)

    def abort(self, messages: list[Staged | None]) -> None:
        removed(self.staging)


def local_files(spark: SparkSession, folder: str, suffix: str = ".parquet") -> DataFrame:
    """(name, path, size_bytes) of the files below a folder that all executors share."""
    found = [(n, f"{folder.rstrip('/')}/{n}", size) for n, size in sorted(sizes_below(folder).items()) if n.endswith(suffix)]
    return spark.createDataFrame(found, LOCAL)


def publish(local: DataFrame, remote: str, run: str, free: bool = True) -> None:
    """One round: files of `local` (name, path, size_bytes) that the remote side lacks or has in another size are copied,
    all are confirmed, and then freed. A run that is repeated under its name publishes what's left. Names are given once;
    of an empty table nothing is published and no record written."""
    spark = ready(local.sparkSession)
    spark.dataSource.register(PublishSink)
    rows = local.select("name", "path", "size_bytes")
    if rows.isEmpty():
        return
    if rows.groupBy("name").count().where("count > 1 OR name IS NULL").count():
        raise ValueError("names of files must be given, and once each")
    rows.write.format("publish").option("remote", remote).option("run", run).option("free", str(free).lower()).mode("append").save()


def published(spark: SparkSession, remote: str) -> DataFrame:
    """(run, name, size_bytes) of all runs that were committed."""
    empty = spark.createDataFrame([], "run string, name string, size_bytes long")
    store, root = place(f"{remote.rstrip('/')}/_runs")
    if not store.get_file_info(root).type.name == "Directory":
        return empty
    runs = spark.read.schema("run string, files array<struct<name: string, size_bytes: long>>").json(f"{remote.rstrip('/')}/_runs")
    return runs.selectExpr("run", "inline(files)")
