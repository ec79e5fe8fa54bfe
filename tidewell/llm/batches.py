"""Arrow batches of (id, text) in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE_BYTES = 2 << 20


def id_and_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """(id long, text binary) and no other column of df, so that no name can clash."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
        *(c.alias(k) for k, c in more.items()),
    )


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cuts batches where the column passes `most` bytes. A longer single value is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // most
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)


def grouped(batches: Iterable[pa.RecordBatch], most: int, column: str = "text") -> Iterator[list[pa.RecordBatch]]:
    """Batches that follow one another, until their column passes `most` bytes."""
    group, held = [], 0
    for batch in batches:
        group.append(batch)
        held += pc.sum(pc.binary_length(batch.column(column))).as_py() or 0
        if held > most:
            yield group
            group, held = [], 0
    if group:
        yield group


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).to_pylist()


def decoded(raw: bytes | None) -> str:
    """The text of a row; null is empty."""
    return raw.decode("utf-8", "replace") if raw else ""


def place_of(df: DataFrame, name: str) -> int:
    """Where a column stands, by its name or, as Spark finds it, by the name in other case; -1 if there is none."""
    names = df.columns
    return names.index(name) if name in names else next((k for k, c in enumerate(names) if c.lower() == name.lower()), -1)


def unused(df: DataFrame, name: str) -> str:
    """The name, with signs added while df has a column of it."""
    while place_of(df, name) >= 0:
        name += "_"
    return name


def rows_where(docs: DataFrame, keep: Callable[[list[bytes | None]], np.ndarray], text_col: str = "text", most: int = 1 << 19) -> DataFrame:
    """The rows of docs, with all their columns, whose texts `keep` marks."""
    at = place_of(docs, text_col)
    name = docs.columns[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], name, most):
                yield part.filter(pa.array(keep(part.column(at).cast(pa.binary()).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
