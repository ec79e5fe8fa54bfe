"""Members of zip archives as tables, inflated by tasks as they read.

    spark.dataSource.register(ZipSource)
    spark.read.format("zip_table").option("path", archives).option("member", "occurrence.txt").schema(...).load()

The plan reads the archives' directories only (their last bytes), through the store; nothing is unpacked to a
folder. Each archive's member is a partition, and a task inflates it as a stream, a block of lines at a time.
Stored members, which can be entered anywhere, are split into ranges of `split_bytes` at line ends. `path` is
an archive or several, comma-separated, in any store that pyarrow knows. An archive that lacks the member has
no rows. Lines with another number of cells than the heading are left out, and so are lines that can't be read
by the schema, as the reader of loose files does; columns are taken by the heading's names, in any order.
"""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidewell.session import ready
from tidewell.sources.places import place

BLOCK, SPLIT = 4 << 20, 64 << 20
LOCAL_HEADER = struct.Struct("<4s5H3L2H")  # of a member: its last two numbers are the lengths of name and extra field


def opened(address: str) -> io.BufferedReader:
    store, path = place(address)
    f = store.open_input_file(path)
    if f.size() < 22:  # the least that a directory's end takes
        raise zipfile.BadZipFile(f"{address} is too short")
    return f


def entry(archive: zipfile.ZipFile, member: str) -> zipfile.ZipInfo | None:
    """A member by its name, or by the last part of it where folders stand before; the first of several."""
    found = [i for i in archive.infolist() if i.filename == member] or [i for i in archive.infolist() if i.filename.rsplit("/", 1)[-1] == member]
    return found[0] if found else None


class Stretch(io.RawIOBase):
    """The lines of a stored member that begin after byte `lo` of it, up to the one that holds byte `hi`; from lo = 0 its first too."""

    def __init__(self, file: io.BufferedReader, start: int, size: int, lo: int, hi: int):
        self.file, self.start, self.size, self.at, self.hi = file, start, size, lo, hi
        if lo:
            self.at = lo - 1
            self._skip_line()
        self.over = self.at >= hi

    def _piece(self, n: int) -> bytes:
        self.file.seek(self.start + self.at)
        return self.file.read(max(0, min(n, self.size - self.at)))

    def _skip_line(self) -> None:
        while piece := self._piece(1 << 16):
            k = piece.find(b"\n")
            self.at += len(piece) if k < 0 else k + 1
            if k >= 0:
                return

    def readable(self) -> bool:
        return True

    def readinto(self, buffer: memoryview) -> int:
        if self.over or self.at >= self.size:
            return 0
        piece = self._piece(len(buffer))
        if self.at + len(piece) >= self.hi:
            k = piece.find(b"\n", max(0, self.hi - 1 - self.at))
            if k >= 0:
                piece, self.over = piece[: k + 1], True
        self.at += len(piece)
        buffer[: len(piece)] = piece
        return len(piece)


def data_start(file: io.BufferedReader, info: zipfile.ZipInfo) -> int:
    file.seek(info.header_offset)
    header = LOCAL_HEADER.unpack(file.read(LOCAL_HEADER.size))
    return info.header_offset + LOCAL_HEADER.size + header[-2] + header[-1]


class ZipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zip_table"

    def schema(self) -> str:
        raise ValueError("a table of an archive needs a schema")

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZipReader(schema, dict(self.options))


class ZipReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        from pyspark.sql.pandas.types import to_arrow_schema

        self.fields, self.member, self.sep = to_arrow_schema(schema), options["member"], options.get("sep", "\t")
        self.paths = [p.strip() for p in options["path"].split(",") if p.strip()]
        self.split = int(options.get("split_bytes", SPLIT))

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in self.paths:
            with opened(path) as f, zipfile.ZipFile(f) as z:
                info = entry(z, self.member)
                if info is None:
                    continue
                splits = info.compress_type == zipfile.ZIP_STORED and not info.flag_bits & 1
                bounds = [*range(0, max(info.file_size, 1), self.split), info.file_size] if splits else [0, -1]
                out += [InputPartition((path, a, b)) for a, b in zip(bounds, bounds[1:], strict=False)]
        return out or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        path, lo, hi = partition.value
        with opened(path) as f, zipfile.ZipFile(f) as z:
            info = entry(z, self.member)
            if hi < 0:
                with z.open(info) as lines:
                    yield from self.rows(lines, None)
                return
            start = data_start(f, info)
            heading = io.BufferedReader(Stretch(f, start, info.file_size, 0, 1)).readline() if lo else None
            yield from self.rows(io.BufferedReader(Stretch(f, start, info.file_size, lo, hi), 1 << 20), heading)

    def rows(self, lines: io.BufferedIOBase, heading: bytes | None) -> Iterator[pa.RecordBatch]:
        """Record batches of the schema's columns, read as text and cast; a heading that isn't in `lines` is given."""
        first = (heading if heading is not None else lines.readline()).decode("utf-8-sig", "replace").rstrip("\r\n")
        if not first:
            return
        names = [n.strip('"') for n in first.split(self.sep)]
        wanted = [f for f in self.fields if f.name in names]
        read = csv.ReadOptions(column_names=names, block_size=BLOCK)
        parse = csv.ParseOptions(delimiter=self.sep, invalid_row_handler=lambda _: "skip", newlines_in_values=False)
        convert = csv.ConvertOptions(include_columns=[f.name for f in wanted], column_types={f.name: pa.string() for f in wanted}, strings_can_be_null=True, null_values=[""], quoted_strings_can_be_null=True, check_utf8=False)
        try:
            batches = csv.open_csv(lines, read, parse, convert)
        except pa.ArrowInvalid as e:
            if "Empty CSV" in str(e):
                return
            raise
        for batch in batches:
            columns = [self.cast(batch.column(f.name), f.type) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type) for f in self.fields]
            bad = [pc.and_(pc.is_valid(batch.column(f.name)), pc.is_null(c)) for f, c in zip(self.fields, columns, strict=True) if f.name in batch.schema.names]
            out = pa.RecordBatch.from_arrays(columns, schema=self.fields)
            if bad:
                out = out.filter(pc.invert(reduce(pc.or_, bad)))
            yield out

    @staticmethod
    def cast(column: pa.Array, kind: pa.DataType) -> pa.Array:
        """Values of a type; null where a text isn't one."""
        if pa.types.is_string(kind):
            return column
        try:
            return column.cast(kind)
        except pa.ArrowInvalid:
            one = lambda x: None if x is None else pa.array([x]).cast(kind)[0].as_py()
            out = []
            for x in column.to_pylist():
                try:
                    out.append(one(x))
                except pa.ArrowInvalid:
                    out.append(None)
            return pa.array(out, kind)


def zip_table(spark: SparkSession, paths: str | list[str], member: str, schema: str, columns: list[str] | None = None, parts: int | None = None, split_bytes: int = SPLIT) -> DataFrame:
    """A member of one or more archives as a table, with only the columns asked for; rows are dealt to `parts` partitions if given, as a deflated member is one task."""
    ready(spark).dataSource.register(ZipSource)
    fields = spark.createDataFrame([], schema).schema
    if columns:
        fields = StructType([fields[c] for c in columns])
    listed = paths if isinstance(paths, str) else ",".join(paths)
    df = spark.read.format("zip_table").schema(fields).option("path", listed).option("member", member).option("split_bytes", split_bytes).load()
    return df.repartition(parts) if parts else df


def members(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, member, size_bytes, packed_bytes) of archives, by their directories; error where one can't be read."""
    ready(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    with opened(path) as f, zipfile.ZipFile(f) as z:
                        rows += [(path, i.filename, i.file_size, i.compress_size, None) for i in z.infolist() if not i.is_dir()]
                except Exception as e:
                    rows.append((path, None, None, None, type(e).__name__))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)], ["path", "member", "size_bytes", "packed_bytes", "error"])

    df = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 64)), F.col("path"))
    return df.mapInArrow(run, "path string, member string, size_bytes long, packed_bytes long, error string")
