"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 2**RING_BITS segments. Every shard owns `vnodes` points on it; a key hashes to a segment,
whose owner is the first point clockwise. No shard takes more than (1 + slack) times the mean bytes:
keys that meet a full shard go on clockwise to the next one with room. Keys join in ring order, so the
fill is planned over the bytes of each segment (at most 2**RING_BITS rows, whatever the input), as cuts
in byte offsets; the rows themselves are placed by a window within their segment and a join to that
bounded plan. All of it is DataFrame code.

Defined results: a null text weighs OVERHEAD bytes; a null id is placed by its text; equal rows follow
one another; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.session import materialise

OVERHEAD = 16
RING_BITS = 12


def ring_points(shards: int, vnodes: int, segments: int = 1 << RING_BITS) -> list[tuple[int, int]]:
    """(segment, shard) of every virtual node in ring order; a shard's points depend on its number alone."""
    at = lambda s, v: int.from_bytes(hashlib.blake2b(f"{s}:{v}".encode(), digest_size=8).digest(), "big")
    every = sorted((at(s, v), s) for s in range(shards) for v in range(vnodes))
    return [(h * segments >> 64, s) for h, s in every]


def plan(loads: dict[int, int], shards: int, vnodes: int, slack: float, segments: int = 1 << RING_BITS) -> list[dict]:
    """Pieces (seg, lo, hi, shard) of byte offsets within segments; hi is None in a segment's last one."""
    points = ring_points(shards, vnodes, segments)
    room = [math.ceil(sum(loads.values()) * (1 + slack) / shards)] * shards
    pieces, first = [], 0
    for seg in range(segments):
        while first < len(points) and points[first][0] < seg:
            first += 1
        left, lo, step = loads.get(seg, 0), 0, 0
        while left > 0:
            shard = points[(first + step) % len(points)][1]
            take = min(left, room[shard])
            if take > 0:
                pieces.append({"seg": seg, "lo": lo, "hi": lo + take if take < left else None, "shard": shard})
                room[shard] -= take
                lo, left = lo + take, left - take
            step += 1
    return [{"piece": k, **p} for k, p in enumerate(pieces)]


def bounded_ring_shards(docs: DataFrame, shards: int = 40, vnodes: int = 64, slack: float = 0.001, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot (gapless from 0 in each shard), grown_shard (null: the law isn't `key`)."""
    spark, text = docs.sparkSession, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keys = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        (F.octet_length(text).cast("long") + OVERHEAD).alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
    ).withColumn("place", F.xxhash64("id", "crc"))
    keys = keys.withColumn("seg", F.expr(f"shiftrightunsigned(place, {64 - RING_BITS})").cast("int"))
    in_segment = Window.partitionBy("seg").orderBy("place", "id", "crc", "size").rowsBetween(Window.unboundedPreceding, 0)
    keys = materialise(keys.withColumns({"lo": F.sum("size").over(in_segment) - F.col("size"), "rank": F.row_number().over(in_segment)}), "ring-keys")
    loads = {r.seg: r.load for r in keys.groupBy("seg").agg(F.sum("size").alias("load")).collect()}  # at most 2**RING_BITS rows
    planned = json.dumps(plan(loads, shards, vnodes, slack))
    pieces = spark.range(1).select(F.inline(F.from_json(F.lit(planned), "array<struct<piece:int,seg:int,lo:long,hi:long,shard:int>>"))).withColumnsRenamed({"seg": "p_seg", "lo": "p_lo"})
    inside = (F.col("seg") == F.col("p_seg")) & (F.col("lo") >= F.col("p_lo")) & (F.col("hi").isNull() | (F.col("lo") < F.col("hi")))
    placed = keys.join(F.broadcast(pieces), inside).select("id", "size", "crc", "rank", "shard", "piece")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "piece").agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    starts = starts.select(F.col("piece").alias("s_piece"), (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return placed.join(F.broadcast(starts), F.col("piece") == F.col("s_piece")).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") + F.col("shift")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
