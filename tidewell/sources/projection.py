"""Some columns of many Parquet shards, with shards that can't be read reported and not lost silently.

Tasks read the footers first. Row groups are the work that is then dealt out, evenly by their bytes, so a
large shard is many tasks' work and a column projection reads only its columns' pages. A shard without a
readable footer, and a row group that fails while it's read, is a row of `failures`; all others' rows are there.
"""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import materialise, ready
from tidewell.sources.places import place, sizes_below

GROUPS = "shard_path string, row_group int, n_rows long, n_bytes long, error string"


def _file(path: str) -> pq.ParquetFile:
    store, at = place(path)
    return pq.ParquetFile(store.open_input_file(at), pre_buffer=False)


def row_groups(spark: SparkSession, paths: list[str], columns: list[str] | None = None) -> DataFrame:
    """(shard_path, row_group, n_rows, n_bytes, error): bytes are those of the columns asked for; a shard without a readable footer has one row with its error."""
    ready(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    with _file(path) as f:
                        for g in range(f.metadata.num_row_groups):
                            meta = f.metadata.row_group(g)
                            chunks = [meta.column(c) for c in range(meta.num_columns)]
                            wanted = [c.total_compressed_size for c in chunks if columns is None or c.path_in_schema.split(".")[0] in columns]
                            rows.append((path, g, meta.num_rows, sum(wanted), None))
                except Exception as e:
                    rows.append((path, None, None, None, f"{type(e).__name__}: {e}"))
            if rows:
                kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["shard_path", "row_group", "n_rows", "n_bytes", "error"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    return listed.repartition(max(1, min(len(paths), 256)), "path").mapInArrow(run, GROUPS)


def projection(spark: SparkSession, folder: str | list[str], schema: str, target_bytes: int = 64 << 20) -> tuple[DataFrame, DataFrame]:
    """(rows, failures). rows: the columns of `schema` and shard_path (the file's name); columns that a shard lacks are null.
    failures: (shard_path, row_group, error), row_group null where the footer failed. `folder` may be a list of files."""
    from pyspark.sql.pandas.types import to_arrow_schema

    paths = folder if isinstance(folder, list) else [f"{folder.rstrip('/')}/{n}" for n in sorted(sizes_below(folder)) if n.endswith(".parquet")]
    wanted = spark.createDataFrame([], schema).schema
    fields, names = to_arrow_schema(wanted), wanted.names
    groups = materialise(row_groups(spark, paths, names), "row-groups")
    good = groups.where("error IS NULL")
    n_bytes = good.agg(F.sum("n_bytes")).first()[0] or 0
    dealt = good.select("shard_path", "row_group").repartition(max(1, -(-n_bytes // target_bytes)), "shard_path", "row_group")
    target = f"{schema}, shard_path string, row_group int, error string"
    out_fields = to_arrow_schema(spark.createDataFrame([], target).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, g in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    with _file(path) as f:
                        there = [n for n in names if n in f.schema_arrow.names]
                        table = f.read_row_group(g, columns=there)
                        columns = [pc.cast(table.column(n), fields.field(n).type).combine_chunks() if n in there else pa.nulls(table.num_rows, fields.field(n).type) for n in names]
                    n, error = table.num_rows, None
                except Exception as e:
                    columns, n, error = [pa.nulls(1, f.type) for f in fields], 1, f"{type(e).__name__}: {e}"
                columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) else c for c in columns]
                more = [pa.array([posixpath.basename(path)] * n, pa.string()), pa.array([g] * n, pa.int32()), pa.array([error] * n, pa.string())]
                yield pa.RecordBatch.from_arrays([*columns, *more], schema=out_fields)

    read = materialise(dealt.mapInArrow(run, target), "projected")
    name = F.element_at(F.split("shard_path", "/"), -1).alias("shard_path")
    failures = groups.where("error IS NOT NULL").select(name, "row_group", "error").unionByName(read.where("error IS NOT NULL").select("shard_path", "row_group", "error"))
    return read.where("error IS NULL").drop("row_group", "error"), failures
