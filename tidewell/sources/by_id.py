"""Services that are asked for records by id, so many ids a call.

    spark.dataSource.register(IdSource)
    spark.read.format("by_id").option("base", address).schema("id bigint, name string").load().where("id IN (3, 5)")
    details(ids, "taxon_id", address, "name string, rank string")   # ids of any number, from a table

The source takes its ids from the filter (spark.sql.python.filterPushdown.enabled); load it anew for each query,
as Spark keeps the last pushed filter with a loaded source. `details` takes ids from a table. `base` is an address with {ids}, or a folder of <id>.json files that all executors share. Every id
that is asked for gets a row: one that the service lacks has nulls.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from tidewell.session import ready
from tidewell.sources.fetch import Limits, contents, in_order
from tidewell.sources.rest import as_row, file_json, get_json

PER_CALL = 30


def asked(base: str, ids: Sequence[int]) -> dict[int, dict]:
    """One call: records by id. Unknown ids have none."""
    if "{ids}" in base:
        body = get_json(base.format(ids=",".join(map(str, ids)))) or {}
        return {int(r["id"]): r for r in body.get("results") or []}
    found = {k: file_json(f"{base.rstrip('/')}/{k}.json") for k in ids}
    return {k: r for k, r in found.items() if r is not None}


def packed(ids: Sequence[int], per_call: int) -> list[list[int]]:
    return [list(ids[k : k + per_call]) for k in range(0, len(ids), per_call)]


class IdSource(DataSource):
    """Options: base, per_call (30), calls (calls of a partition, 1)."""

    @classmethod
    def name(cls) -> str:
        return "by_id"

    def schema(self) -> str:
        return "id bigint, record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return IdReader(schema, dict(self.options))


class IdReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.base, self.per_call, self.calls = options["base"], int(options.get("per_call", PER_CALL)), int(options.get("calls", 1))
        self.ids: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and f.attribute == ("id",):
                wanted = {int(v) for v in ([f.value] if isinstance(f, EqualTo) else f.value) if v is not None}
                self.ids = wanted if self.ids is None else self.ids & wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        if self.ids is None:
            raise ValueError("this service is asked by id: filter by id = or id IN, with spark.sql.python.filterPushdown.enabled")
        return [InputPartition(calls) for calls in packed(packed(sorted(self.ids), self.per_call), self.calls)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        for ids in partition.value:
            found = asked(self.base, ids)
            for k in ids:
                yield as_row({**found.get(k, {}), "id": k}, self.names, 0, 0) if k in found else tuple(k if c == "id" else None for c in self.names)


def details(df: DataFrame, id_col: str, base: str, schema: str, per_call: int = PER_CALL, partitions: int | None = None, limits: Limits = Limits(in_flight=4)) -> DataFrame:
    """(id, the schema's fields, known, error): a row for each distinct id of df that isn't null.

    Ids are dealt out once and packed `per_call` to a call, so a partition makes one call that isn't full at
    most. A call that fails in spite of its retries gives its ids an error and known = null: they aren't
    taken for unknown. A task has as many calls under way as `limits` says.
    """
    spark = ready(df.sparkSession)
    ids = df.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
    ids = ids.distinct() if partitions is None else ids.repartition(partitions, "id").distinct()
    fields = spark.createDataFrame([], schema).schema.fields
    names = [f.name for f in fields]
    target = spark.createDataFrame([], f"id bigint, {schema}, known boolean, error string").schema

    def answer(pack: list[int]) -> list[tuple]:
        try:
            found = asked(base, pack)
        except Exception as e:
            return [(k, *[None] * len(names), None, f"{type(e).__name__}: {e}") for k in pack]
        return [(k, *(as_row(found[k], names, 0, 0) if k in found else [None] * len(names)), k in found, None) for k in pack]

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[list[int]]:
        held: list[int] = []
        for batch in batches:
            held += batch.column("id").to_pylist()
            full = len(held) // per_call * per_call
            yield from packed(held[:full], per_call)
            held = held[full:]
        if held:
            yield held

    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_order(packs(batches), answer, lambda _: "", limits):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), kinds, strict=True)], schema=kinds)

    return ids.mapInArrow(run, target)


def counted(df: DataFrame, url: str, limits: Limits = Limits()) -> DataFrame:
    """df with n_records (what the service at each address says it has; null where it fails) and probe_error. Addresses ask for no records."""
    found = contents(df, url, limits=limits)
    body = F.col("content").cast("string")
    n = F.coalesce(F.get_json_object(body, "$.count"), F.get_json_object(body, "$.total_results")).try_cast("long")
    return found.withColumns({"n_records": n, "probe_error": F.col("error")}).drop("content", "attempts", "http_status", "error")
