"""Writers: bounded shards, consolidated text, documents, logs, and confirmed publishing."""

from __future__ import annotations

import itertools
import re
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import ready
from tidewell.sources.places import place, written


UNFIT = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")  # what XML can't hold


def bounded_shards(df: DataFrame, folder: str, run: str, rows: int = 10_000) -> None:
    """Parquet files of at most `rows` rows, under run=<run>, so that readers prune by run."""
    df.withColumn("run", F.lit(run)).write.option("maxRecordsPerFile", rows).mode("append").partitionBy("run").parquet(folder)


def wide_csv(df: DataFrame, folder: str, front: list[str], one_file: bool = False) -> None:
    """Text with a header, the front columns first. One file only where asked, for tables that one task can write."""
    out = df.select(*[c for c in front if c in df.columns], *[c for c in df.columns if c not in front])
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).csv(folder)


def stats_document(df: DataFrame, folder: str) -> None:
    """A row of figures as JSON."""
    df.limit(1).coalesce(1).write.mode("overwrite").json(folder)


def provenance(spark: SparkSession, folder: str, kind: str, **values: object) -> None:
    """Appends one JSON event with its time."""
    fields = [F.lit(v).alias(k) for k, v in values.items()]
    spark.range(1).select(F.lit(kind).alias("type"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ts"), *fields).coalesce(1).write.mode("append").json(folder)


def files(df: DataFrame, folder: str, path: str = "path", content: str = "content") -> DataFrame:
    """(path, size_bytes): a file a row below the folder, which all executors share, written when the rows are taken.
    A file appears whole; of rows with equal paths one counts; null content is an empty file."""
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, bodies = batch.column(0).to_pylist(), [x or b"" for x in batch.column(1).to_pylist()]
            for name, body in zip(names, bodies, strict=True):
                written(f"{folder.rstrip('/')}/{name}", body)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in bodies], pa.int64())], ["path", "size_bytes"])

    return df.select(F.col(path), F.col(content)).mapInArrow(run, "path string, size_bytes long")


def archives(df: DataFrame, folder: str, member: str, stored: bool = False) -> DataFrame:
    """(path, n_rows): a zip archive for each partition that has rows, with them as tab-separated text in one member, written as they come.
    Null is an empty cell; tabs and line ends in cells become blanks."""
    ready(df.sparkSession)
    names, kind = df.columns, zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first, n = next(batches, None), 0
        if first is None:
            return
        store, root = place(folder.rstrip("/"))
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.zip"
        with store.open_output_stream(f"{root}/{name}.tmp") as out, zipfile.ZipFile(out, "w", kind) as z, z.open(member, "w", force_zip64=True) as f:
            f.write(("\t".join(names) + "\n").encode())
            for batch in itertools.chain([first], batches):
                cells = zip(*(c.to_pylist() for c in batch.columns), strict=True)
                f.write("".join("\t".join(x or "" for x in row) + "\n" for row in cells).encode())
                n += batch.num_rows
        store.move(f"{root}/{name}.tmp", f"{root}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([n], pa.int64())], ["path", "n_rows"])

    text = [F.translate(F.col(f"`{c}`").cast("string"), "\t\r\n", "   ").alias(c) for c in names]
    return df.select(*text).mapInArrow(run, "path string, n_rows long")


# The parts of a workbook of one sheet.
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
_TYPES = f'{_XML}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>'
_RELATIONS = '{xml}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/{kind}" Target="{target}"/></Relationships>'
_BOOK = f'{_XML}<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
_MOST_ROWS = 1_048_576


def workbooks(df: DataFrame, folder: str, before: int = 0) -> DataFrame:
    """(path, n_rows): an Excel workbook for each partition that has rows, with headings after `before` rows of notes; cells as text, null as none.
    A sheet has a limit of 1,048,576 rows, beyond which the task fails: repartition first."""
    ready(df.sparkSession)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = (b for b in batches if b.num_rows)
        first, n = next(batches, None), 0
        if first is None:
            return
        store, root = place(folder.rstrip("/"))
        store.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.xlsx"

        def row(cells: Sequence[str | None]) -> str:
            own = "".join('<c/>' if x is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(UNFIT.sub("", x))}</t></is></c>' for x in cells)
            return f"<row>{own}</row>"

        with store.open_output_stream(f"{root}/{name}.tmp") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("[Content_Types].xml", _TYPES)
            z.writestr("_rels/.rels", _RELATIONS.format(xml=_XML, kind="officeDocument", target="xl/workbook.xml"))
            z.writestr("xl/workbook.xml", _BOOK)
            z.writestr("xl/_rels/workbook.xml.rels", _RELATIONS.format(xml=_XML, kind="worksheet", target="worksheets/sheet1.xml"))
            with z.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
                f.write(f'{_XML}<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'.encode())
                f.write("".join([row(["notes"])] * before + [row(names)]).encode())
                for batch in itertools.chain([first], batches):
                    n += batch.num_rows
                    if before + 1 + n > _MOST_ROWS:
                        raise ValueError(f"a sheet can't hold more than {_MOST_ROWS} rows")
                    f.write("".join(map(row, zip(*(c.to_pylist() for c in batch.columns), strict=True))).encode())
                f.write(b"</sheetData></worksheet>")
        store.move(f"{root}/{name}.tmp", f"{root}/{name}")
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder.rstrip('/')}/{name}"]), pa.array([n], pa.int64())], ["path", "n_rows"])

    return df.select(*(F.col(f"`{c}`").cast("string").alias(c) for c in names)).mapInArrow(run, "path string, n_rows long")


def replace_role(df: DataFrame, folder: str, role: str = "dataset_role") -> None:
    """Overwrites only the roles that df has."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(role).parquet(folder)


def to_publish(local: DataFrame, remote: DataFrame, name: str = "name") -> DataFrame:
    """Local files that the remote side lacks."""
    return local.join(remote.select(name), name, "left_anti")


def confirmed(local: DataFrame, remote: DataFrame, name: str = "name", size: str = "size") -> DataFrame:
    """Local files that the remote side has in the same size: these may be deleted."""
    return local.join(remote.select(name, size), [name, size], "left_semi")


def card(spark: SparkSession, title: str, counts: dict[str, int]) -> str:
    """A short description of a data set with its row counts, as Markdown."""
    rows = "\n".join(f"| {k} | {v:,} |" for k, v in counts.items())
    return f"# {title}\n\n| table | rows |\n|---|---:|\n{rows}\n"
