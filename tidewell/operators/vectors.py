"""Vectors: ranges, principal components, nearest neighbours and projection by them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.operators.relational import top_per_group
from tidewell.session import ready

MOST_CELL_BYTES = 64 << 20


def channel_ranges(df: DataFrame, vector: str) -> DataFrame:
    """(pos, low, high) for each position of the vectors."""
    return df.select(F.posexplode(vector).alias("pos", "x")).groupBy("pos").agg(F.min("x").alias("low"), F.max("x").alias("high"))


def channel_arrays(df: DataFrame, vector: str) -> DataFrame:
    """One row: low and high of all positions as arrays."""
    row = F.sort_array(F.collect_list(F.struct("pos", "low", "high")))  # as many entries as a vector has
    return channel_ranges(df, vector).agg(row.alias("r")).select(F.col("r.low").alias("low"), F.col("r.high").alias("high"))


def moments(df: DataFrame, vector: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sum and Gram matrix of vectors, added up within tasks and then over them."""
    ready(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, gram = 0, None, None
        for batch in batches:
            rows = [v for v in batch.column(0).to_pylist() if v is not None]
            if rows:
                x = np.array(rows, np.float64)
                n, total, gram = n + len(x), x.sum(0) + (0 if total is None else total), x.T @ x + (0 if gram is None else gram)
        if n:
            flat = np.concatenate((total, gram.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array([n] * len(flat), pa.int64()), pa.array(range(len(flat)), pa.int32()), pa.array(flat)], ["n", "at", "x"])

    parts = df.select(F.col(vector).cast("array<double>")).mapInArrow(run, "n long, at int, x double")
    rows = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum("x").alias("x")).orderBy("at").collect()  # d + d**2 rows
    if not rows:
        return 0, np.empty(0), np.empty((0, 0))
    d = int((np.sqrt(4 * len(rows) + 1) - 1) / 2)
    flat = np.array([r.x for r in rows])
    return rows[0].n, flat[:d], flat[d:].reshape(d, d)


def principal_components(df: DataFrame, vector: str, k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(mean, components k x d). In each component the entry of largest size is positive."""
    n, total, gram = moments(df, vector)
    mean = total / max(n, 1)
    values, vectors = np.linalg.eigh(gram / max(n, 1) - np.outer(mean, mean))
    top = vectors[:, np.argsort(values)[::-1][:k]].T
    return mean, top * np.sign(top[np.arange(len(top)), np.abs(top).argmax(1)])[:, None]


def projected(df: DataFrame, vector: str, mean: np.ndarray, components: np.ndarray, name: str = "component") -> DataFrame:
    """Adds name_0, name_1, ... as column arithmetic on the array."""
    centred = F.zip_with(F.col(vector).cast("array<double>"), F.array(*map(F.lit, mean.tolist())), lambda x, m: x - m)
    dot = lambda w: F.aggregate(F.zip_with(centred, F.array(*map(F.lit, w.tolist())), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return df.withColumns({f"{name}_{k}": dot(w) for k, w in enumerate(components)})


def _near(like: np.ndarray, last: np.ndarray | None, k: int, slack: float) -> np.ndarray:
    """Which of these similarities may be among the k nearest: above `last`, or about the k greatest of each row."""
    if last is not None:
        return like > (last - slack).astype(like.dtype)[:, None]
    far, k = -like, min(k, like.shape[1])  # so that NaN is far
    return far <= (np.partition(far, k - 1, axis=1)[:, k - 1] + 2 * slack).astype(like.dtype)[:, None]


def _top(x: np.ndarray, ids: np.ndarray, t: np.ndarray, k: int, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, id, distance) of the k nearest of t for each row of x, `block` x `block` pairs at a time. Distances have 12 decimals, so equal vectors are tied.

    Single precision tells which pairs may be near, with more slack than its error for unit vectors; their distances are
    then worked out in double. Where many are that close, as of equal vectors, double precision tells them apart first.
    """
    order = np.argsort(ids, kind="stable")  # so that of ties the earlier block's win
    ids, t = ids[order], t[order]
    x32, t32, slack, step = x.astype(np.float32), t.astype(np.float32), 2.4e-7 * (x.shape[1] + 4), max(1, (4 << 20) // x.shape[1])
    room = np.empty(min(block, len(x)) * min(block, len(t)), np.float32)
    rows, best, near = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
    for a in range(0, len(x), block):
        held, xa = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)), x[a : a + block]
        for b in range(0, len(t), block):
            tb = t[b : b + block]
            last = 1 - held[2][k - 1 :: k] if len(held[0]) == len(xa) * k else None  # rows with k already take only what is nearer
            like = np.matmul(x32[a : a + block], t32[b : b + block].T, out=room[: len(xa) * len(tb)].reshape(len(xa), len(tb)))
            found = _near(like, last, k, slack)
            if np.count_nonzero(found) > found.size // 32:
                found = _near(xa @ tb.T, last, k, 1e-12 if last is None else -4e-13)
            at = np.flatnonzero(found)
            if not len(at):
                continue
            r, c = np.divmod(at, len(tb))
            d = np.concatenate([np.einsum("ij,ij->i", xa[r[p : p + step]], tb[c[p : p + step]]) for p in range(0, len(r), step)])
            held = tuple(np.concatenate(z) for z in zip(held, (r, ids[b + c], np.round(1 - d, 12)), strict=True))
            order = np.lexsort((held[1], held[2], held[0]))
            r = held[0][order]
            first = np.searchsorted(r, r)  # where a row's candidates begin
            held = tuple(z[order][np.arange(len(r)) - first < k] for z in held)
        rows, best, near = np.concatenate((rows, a + held[0])), np.concatenate((best, held[1])), np.concatenate((near, held[2]))
    return rows, best, near


def nearest(queries: DataFrame, training: DataFrame, k: int, query_id: str, vector: str, training_id: str, training_vector: str, block: int = 1024, cell_bytes: int = MOST_CELL_BYTES) -> DataFrame:
    """(query_id, rank from 1, training_id, distance): the k nearest by cosine distance, ties by id.

    Both sides are cut into parts of at most about `cell_bytes` by hash, and each part of queries meets each
    part of training rows in a task that gives k rows a query; these are merged by rank. Nothing passes the
    driver but the two counts. Zero and null vectors have no neighbours and are none; so are rows without id.
    """
    spark = ready(queries.sparkSession)
    wide = lambda c: F.col(c).cast("array<float>").cast("array<double>").alias("v")
    asked = queries.select(F.col(query_id).cast("long").alias("q"), F.col(vector).cast("array<double>").alias("v")).where("v IS NOT NULL AND q IS NOT NULL AND exists(v, e -> e <> 0)")
    rows = training.select(F.col(training_id).cast("long").alias("id"), wide(training_vector)).where("v IS NOT NULL AND id IS NOT NULL AND exists(v, e -> e <> 0)")
    figures = [df.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(1))).first() for df in (asked, rows)]
    parts = [max(1, -(-n * size * 8 // cell_bytes)) for n, size in figures]
    parts[1] = max(parts[1], min(spark.sparkContext.defaultParallelism, -(-figures[1][0] // 2000)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.withColumn("qc", F.pmod(F.xxhash64("q", "v"), F.lit(parts[0])).cast("int")).withColumn("tc", every(parts[1]))
    right = rows.withColumn("tc", F.pmod(F.xxhash64("id", "v"), F.lit(parts[1])).cast("int")).withColumn("qc", every(parts[0]))

    def matrix(table: pa.Table) -> np.ndarray:
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(table.num_rows, -1)
        return x / np.linalg.norm(x, axis=1)[:, None]

    def cell(one: pa.Table, other: pa.Table) -> pa.Table:
        names = ["q", "t", "distance"]
        if not one.num_rows or not other.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        at, t, d = _top(matrix(one), other.column("id").to_numpy(), matrix(other), k, block)
        return pa.Table.from_arrays([pa.array(one.column("q").to_numpy()[at]), pa.array(t), pa.array(d)], names)

    found = left.groupBy("qc", "tc").cogroup(right.groupBy("qc", "tc")).applyInArrow(cell, "q long, t long, distance double")
    ranked = top_per_group(found, ["q"], [F.col("distance"), F.col("t")], k, "rank")
    return ranked.select(F.col("q").alias(query_id), "rank", F.col("t").alias(training_id), "distance")


def weighted_projection(neighbours: DataFrame, targets: DataFrame, query_id: str, training_id: str, target: str) -> DataFrame:
    """(query_id, pos, value): targets of neighbours weighted by 1 / (distance + 1e-6). A query's neighbours, which are few, are one row."""
    w = (1 / (F.col("distance") + 1e-6)).alias("w")
    near = neighbours.join(targets.select(training_id, F.col(target).cast("array<double>").alias("x")), training_id).groupBy(query_id).agg(F.sort_array(F.collect_list(F.struct(w, "x"))).alias("near"))
    total = lambda of: F.aggregate("near", F.lit(0.0), lambda s, r: s + of(r))
    places = F.sequence(F.lit(0), F.size(F.col("near")[0]["x"]) - 1)
    values = F.transform(places, lambda p: total(lambda r: r["w"] * F.get(r["x"], p)) / total(lambda r: r["w"]))
    return near.select(query_id, F.posexplode(values).alias("pos", "value"))
