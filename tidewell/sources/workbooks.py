"""Sheets of Excel workbooks as tables of text, read by tasks row by row.

    spark.dataSource.register(WorkbookSource)
    spark.read.format("workbook").option("path", files).option("header", 5).load()

`path` is a workbook (.xlsx) or several, comma-separated; each is a partition, as its rows can't be entered in
the middle. `sheet` is a name or a number from 0, `header` the number of the row with the headings, from 0;
rows before it are skipped. Columns come from the first workbook's headings (blank ones are column_<n>,
repeated ones get .1, .2), others are read by name. Cells are text as stored: whole numbers without a point,
true and false, formulas by their last value; empty ones and empty rows' cells are null, empty rows at all
are left out. Styles, so dates too, aren't applied.
"""

from __future__ import annotations

import itertools
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType, StructField, StructType

from tidewell.session import ready
from tidewell.sources.archives import opened

# The namespaces of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_of(reference: str) -> int:
    """'C7' is column 2."""
    n = 0
    for c in re.match("[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


def _text(item: ElementTree.Element) -> str:
    """All runs of text of a string, without those that tell how to read it aloud."""
    return "".join(t.text or "" for part in item if part.tag in (f"{MAIN}t", f"{MAIN}r") for t in part.iter(f"{MAIN}t"))


def _shared(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    with z.open("xl/sharedStrings.xml") as f:
        for _, e in ElementTree.iterparse(f):
            if e.tag == f"{MAIN}si":
                out.append(_text(e))
                e.clear()
    return out


def _sheet(z: zipfile.ZipFile, sheet: str) -> str:
    """The member that holds a sheet, by its name or number."""
    listed = [(s.get("name"), s.get(RELATION)) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{MAIN}sheet")]
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    found = [k for k, (name, _) in enumerate(listed) if name == sheet] or [int(sheet)]
    target = targets[listed[found[0]][1]]
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _value(cell: ElementTree.Element, shared: list[str]) -> str | None:
    kind, v = cell.get("t", "n"), cell.find(f"{MAIN}v")
    if kind == "inlineStr":
        found = cell.find(f"{MAIN}is")
        return None if found is None else _text(found) or None
    if v is None or not v.text:
        return None
    if kind == "s":
        return shared[int(v.text)] or None
    if kind == "b":
        return "true" if v.text == "1" else "false"
    if kind == "n" and re.fullmatch(r"-?\d+\.0+", v.text):
        return v.text.partition(".")[0]
    return None if kind == "e" else v.text


def rows_of(address: str, sheet: str) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number from 0, cells by column) of the rows that have cells."""
    with opened(address) as f, zipfile.ZipFile(f) as z:
        shared, number = _shared(z), -1
        with z.open(_sheet(z, sheet)) as s:
            for _, e in ElementTree.iterparse(s):
                if e.tag != f"{MAIN}row":
                    continue
                number = int(e.get("r")) - 1 if e.get("r") else number + 1
                cells, at = {}, -1
                for c in e.iter(f"{MAIN}c"):
                    at = column_of(c.get("r")) if c.get("r") else at + 1
                    value = _value(c, shared)
                    if value is not None:
                        cells[at] = value
                e.clear()
                if cells:
                    yield number, cells


def headings(address: str, sheet: str, header: int) -> dict[str, int]:
    """Columns by heading."""
    cells = next((c for n, c in rows_of(address, sheet) if n == header), {})
    out: dict[str, int] = {}
    for k in range(max(cells, default=-1) + 1):
        name = cells.get(k, "").strip() or f"column_{k}"
        names = itertools.chain([name], (f"{name}.{n}" for n in itertools.count(1)))
        out[next(n for n in names if n not in out)] = k
    return out


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def of(self) -> tuple[list[str], str, int]:
        paths = [p.strip() for p in self.options["path"].split(",") if p.strip()]
        return paths, self.options.get("sheet", "0"), int(self.options.get("header", 0))

    def schema(self) -> StructType:
        paths, sheet, header = self.of()
        return StructType([StructField(n, StringType()) for n in headings(paths[0], sheet, header)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return WorkbookReader([f.name for f in schema.fields], *self.of())


class WorkbookReader(DataSourceReader):
    def __init__(self, names: list[str], paths: list[str], sheet: str, header: int):
        self.names, self.paths, self.sheet, self.header = names, paths, sheet, header

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        at = headings(partition.value, self.sheet, self.header)
        places = [at.get(n) for n in self.names]
        for number, cells in rows_of(partition.value, self.sheet):
            if number > self.header:
                yield tuple(None if k is None else cells.get(k) for k in places)


def workbook(spark: SparkSession, paths: str | list[str], sheet: str | int = 0, header: int = 0) -> DataFrame:
    """All columns of a sheet as text."""
    ready(spark).dataSource.register(WorkbookSource)
    listed = paths if isinstance(paths, str) else ",".join(paths)
    return spark.read.format("workbook").option("path", listed).option("sheet", str(sheet)).option("header", header).load()
