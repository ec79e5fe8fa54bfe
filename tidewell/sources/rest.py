"""Paginated JSON services as a Spark data source, to read once or as a stream.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").option("base", url_or_folder).schema(...).load()
    records(spark, base, schema, key)        # one row a key
    record_stream(spark, base, schema, key)  # each key once, over all restarts of the query

`base` is an address with {page} (or {offset}), or a folder of page_<n>.json files that all executors share.
Where the first page tells the total, pages are planned from it and dealt to `partitions`; a page without
records before the end is an error, so a service that fails for a while cuts no table short. Without a total
one task walks the pages until one is empty or the last by `endOfRecords`. An address that isn't found is an
error too, unless end_on_404 says that the service ends so; `pages` reads only so many.

The schema's columns are fields of records; `record` is the whole record as JSON, `_page` and `_place` say
where it stood. As a stream the service is asked for its total and first page at each trigger: when they
change, its pages are read again (with order = append only those from the last one on), as new records may
push others to later pages. What was seen before is dropped by key, by state that the checkpoint keeps.
"""

from __future__ import annotations

import itertools
import json
import random
import time
import urllib.error
import urllib.request
import zlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from tidewell.operators.relational import keep_first
from tidewell.session import ready
from tidewell.sources.places import place

RETRIED = (429, 500, 502, 503, 504)


def get_json(address: str, attempts: int = 5, longest: float = 10.0, opener=urllib.request.urlopen, sleep=time.sleep) -> dict | None:
    """A GET with retries on throttling and server errors, waiting as told or ever longer; null where the service has nothing."""
    for attempt in range(attempts):
        try:
            with opener(address, timeout=60) as response:
                return json.load(response)
        except urllib.error.HTTPError as e:
            if e.code == 404:
                return None
            if e.code not in RETRIED or attempt == attempts - 1:
                raise
            told = e.headers.get("Retry-After") if e.headers else None
            sleep(min(longest, float(told) if told and told.isdigit() else 2**attempt + random.random()))
        except urllib.error.URLError:
            if attempt == attempts - 1:
                raise
            sleep(min(longest, 2**attempt))
    return None


def file_json(address: str) -> dict | None:
    """The JSON document of a file; null if there is none."""
    store, path = place(address)
    if not store.get_file_info(path).is_file:
        return None
    with store.open_input_stream(path) as f:
        return json.loads(f.read())


def as_row(record: dict, names: Sequence[str], page: int, at: int) -> tuple:
    """Values of columns; nested ones as JSON."""
    own = {"record": json.dumps(record), "_page": page, "_place": at} | {k: json.dumps(v) if isinstance(v, (dict, list)) else v for k, v in record.items()}
    return tuple(own.get(c) for c in names)


class Pages:
    """The pages of a service by its options."""

    def __init__(self, options: dict):
        self.base, self.size = options["base"].rstrip("/"), int(options["per_page"]) if options.get("per_page") else None
        self.parts, self.end_on_404 = int(options.get("partitions", 4)), options.get("end_on_404") == "true"
        self.pages = int(options["pages"]) if options.get("pages") else None

    def page(self, n: int) -> dict | None:
        """A page's document; null after the end."""
        if "{page}" not in self.base and "{offset}" not in self.base:
            return file_json(f"{self.base}/page_{n}.json")
        address = self.base.format(page=n + 1, offset=n * (self.size or 300))
        body = get_json(address)
        if body is None and not self.end_on_404:
            raise OSError(f"nothing at {address}")
        return body

    def counted(self) -> tuple[int | None, int | None, dict | None]:
        """(records in all, number of pages, first page), null where the service doesn't say."""
        first = self.page(0)
        if first is None:
            return 0, 0, None
        total = first.get("total_results", first.get("count"))
        size = first.get("per_page") or self.size
        return total, None if total is None or not size else -(-int(total) // int(size)), first

    def read(self, numbers: Iterator[int] | range, planned: bool, names: Sequence[str]) -> Iterator[tuple]:
        for n in numbers:
            body = self.page(n)
            found = (body or {}).get("results") or []
            if not found:
                _, pages, _ = self.counted() if planned else (None, 0, None)
                if planned and n < (pages or 0):
                    raise OSError(f"page {n} of {pages} is empty")
                return
            for at, r in enumerate(found):
                yield as_row(r, names, n, at)
            if not planned and body.get("endOfRecords"):
                return

    def dealt(self, first: int, pages: int) -> list[InputPartition]:
        parts = min(self.parts, pages - first)
        return [InputPartition((first + k, pages, parts)) for k in range(max(0, parts))]


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id bigint, record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PagedReader(schema, dict(self.options))

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return PagedStreamReader(schema, dict(self.options))


class PagedReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.of = [f.name for f in schema.fields], Pages(options)

    def partitions(self) -> list[InputPartition]:
        _, pages, _ = self.of.counted()
        if pages is None:
            return [InputPartition((0, self.of.pages, 0))]
        return self.of.dealt(0, pages if self.of.pages is None else min(pages, self.of.pages)) or [InputPartition((0, 0, 1))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        first, pages, step = partition.value
        if step:
            yield from self.of.read(range(first, pages, step), True, self.names)
        else:
            yield from self.of.read(itertools.count() if pages is None else range(pages), False, self.names)


class PagedStreamReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.of, self.append = [f.name for f in schema.fields], Pages(options), options.get("order") == "append"

    def initialOffset(self) -> dict:
        return {"records": 0, "first": 0}

    def latestOffset(self) -> dict:
        total, pages, first = self.of.counted()
        if pages is None:
            raise OSError("a stream of pages needs a service that tells its total and its pages' size")
        return {"records": int(total), "first": zlib.crc32(json.dumps(first, sort_keys=True).encode()), "pages": pages}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start == end:
            return []
        return self.of.dealt(max(0, start.get("pages", 0) - 1) if self.append else 0, end["pages"])

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        first, pages, step = partition.value
        yield from self.of.read(range(first, pages, step), True, self.names)


def records(spark: SparkSession, base: str, schema: str, key: str = "id", **options: object) -> DataFrame:
    """Records of a service, one a key: that which stood first. Null keys are one key."""
    ready(spark).dataSource.register(PagedSource)
    reader = spark.read.format("paged").schema(f"{schema}, _page int, _place int").option("base", base).options(**options)
    return keep_first(reader.load(), [key], [F.col("_page"), F.col("_place")]).drop("_page", "_place")


def record_stream(spark: SparkSession, base: str, schema: str, key: str = "id", **options: object) -> DataFrame:
    """Records of a service as a stream that gives each key once, whatever restarts and shifts of pages come between."""
    ready(spark).dataSource.register(PagedSource)
    return spark.readStream.format("paged").schema(schema).option("base", base).options(**options).load().dropDuplicates([key])
