"""Keys that were done, in a table of which a batch reads only the files that can hold its keys.

Keys are written by label (a batch) and bucket of their hash, one Bloom filter for each file, 16 bits a key.
A batch's keys meet the filters of their buckets first; the files of filters that any key passes are read and
decide. So a batch of new keys reads next to no keys, however many were done before. `merged` rewrites many
labels as one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.session import dropped, ready

BUCKETS, BITS, HASHES = 64, 16, 8
FILTERS = "bucket int, label string, n bigint, bits binary"


def bucket_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _places(h: np.ndarray, g: np.ndarray, size: int) -> np.ndarray:
    """The bits of keys in a filter of `size` bits, a power of two: a row a key."""
    step = g.view(np.uint64) | np.uint64(1)
    return (h.view(np.uint64)[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)


def bloom(h: np.ndarray, g: np.ndarray) -> bytes:
    """A filter of keys by two hashes each."""
    size = 1 << max(6, int(len(h) * BITS - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[_places(h, g, size).ravel()] = True
    return np.packbits(bits).tobytes()


def passing(h: np.ndarray, g: np.ndarray, bits: bytes) -> np.ndarray:
    packed = np.frombuffer(bits, np.uint8)
    at = _places(h, g, len(packed) * 8)
    return (packed[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8) & 1).all(1)


class DoneTable:
    """At a folder: keys/label=/bucket= and filters/label=."""

    def __init__(self, spark: SparkSession, path: str, key: str, kind: str):
        self.spark, self.path, self.key, self.kind = ready(spark), path, key, kind

    def hashed(self, keys: DataFrame) -> DataFrame:
        return keys.select(F.col(self.key), bucket_of(self.key).alias("bucket"), F.xxhash64(F.lit(2), F.col(self.key)).alias("h"), F.xxhash64(F.lit(1), F.col(self.key)).alias("g"))

    def add(self, keys: DataFrame, label: str) -> None:
        """Adds keys under a label, in place of what stood under it; columns of keys besides the key are kept. The filter comes
        first: without its keys it costs a look, keys without it would be done again."""

        def build(table: pa.Table) -> pa.Table:
            h, g = (table.column(c).to_numpy() for c in ("h", "g"))
            bits = pa.array([bloom(h, g)], pa.binary())
            return pa.Table.from_arrays([table.column("bucket").slice(0, 1).combine_chunks(), pa.array([label]), pa.array([len(h)], pa.int64()), bits], ["bucket", "label", "n", "bits"])

        keys = keys.where(F.col(self.key).isNotNull())
        self.hashed(keys).groupBy("bucket").applyInArrow(build, FILTERS).write.mode("overwrite").parquet(f"{self.path}/filters/label={label}")
        keys.withColumn("bucket", bucket_of(self.key)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/keys/label={label}")

    def filters(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(FILTERS).parquet(f"{self.path}/filters/label=*")
        except AnalysisException:
            return None

    def may_hold(self, rows: DataFrame, but: str | None = None) -> list[tuple[str, int]]:
        """(label, bucket) of files that may hold keys of rows: as many as there are files at most. The label `but` doesn't count."""
        filters = self.filters()
        if filters is None:
            return []
        if but is not None:
            filters = filters.where(F.col("label") != but)

        def test(keys: pa.Table, known: pa.Table) -> pa.Table:
            h, g = (keys.column(c).to_numpy() for c in ("h", "g"))
            met = [(r["label"], r["bucket"]) for r in known.to_pylist() if len(h) and passing(h, g, r["bits"]).any()]
            return pa.Table.from_arrays([pa.array([x for x, _ in met], pa.string()), pa.array([x for _, x in met], pa.int32())], ["label", "bucket"])

        asked = self.hashed(rows.select(self.key).where(F.col(self.key).isNotNull()))
        found = asked.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(test, "label string, bucket int")
        return sorted((r.label, r.bucket) for r in found.distinct().collect())

    def keys_of(self, files: list[tuple[str, int]]) -> DataFrame:
        """Keys of files; one whose keys were never written has none."""
        schema = f"`{self.key}` {self.kind}"
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        paths = []
        for label, bucket in files:
            at = f"{self.path}/keys/label={label}/bucket={bucket}"
            if fs.Path(at).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(fs.Path(at)):
                paths.append(at)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def unseen(self, rows: DataFrame, but: str | None = None) -> DataFrame:
        """Rows whose key isn't done under another label than `but`; null keys never are."""
        return rows.join(self.keys_of(self.may_hold(rows, but)), self.key, "left_anti")

    def merged(self, label: str) -> int:
        """Rewrites all labels but `label` under it; how many there were. For times when no stage runs."""
        filters = self.filters()
        old = [] if filters is None else [r.label for r in filters.select("label").distinct().collect() if r.label != label]
        if old:
            every = self.spark.read.option("basePath", f"{self.path}/keys").parquet(*[f"{self.path}/keys/label={x}" for x in old]).drop("label", "bucket")
            self.add(every.dropDuplicates([self.key]), label)
            for x in old:
                dropped(self.spark, f"{self.path}/keys/label={x}")
                dropped(self.spark, f"{self.path}/filters/label={x}")
        return len(old)
