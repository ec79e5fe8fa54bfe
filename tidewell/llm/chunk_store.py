"""A content-addressed store of token ids.

Documents are encoded and end with an end id. A rolling hash over WINDOW ids cuts each id stream where
its low bits are zero (between LEAST and MOST ids), so equal passages give equal chunks wherever they
stand. Two Parquet tables make the store:

* chunks: one row for each place a chunk is used; the ids (little-endian, two bytes where the vocabulary
  allows) stand in one row for each digest only. Rows with ids are dealt by digest, the others evenly, and
  a task sends the ids of a chunk once, so a passage that a third of the documents share is no hot group.
* recipes: one row for each document, in ascending id order: its start in the stream of all ids, its
  length, its chunks and the Merkle root over their digests.

Reading back recomputes every digest from the stored ids, every root from the digests, and the crc32 of
each document from the chunks' checksums, which combine linearly.

Defined results: null text is empty and holds the end id alone; rows with the same id or none are kept
apart, null ids first, equal ids in the order of the table; an empty table gives an empty store; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.batches import decoded, grouped, id_and_text, slices, texts
from tidewell.llm.many_words import Merges, fit
from tidewell.llm.many_words import encode as encode_words
from tidewell.llm.textwords import mix
from tidewell.llm.token_counts import byte_letters
from tidewell.llm.units import FIRST, LATIN, PIECES, WORD, Memo, blank_keys, keys, single_spaced, unit_of
from tidewell.session import fresh_path, materialise, ready

END = 2
WINDOW, LEAST, MEAN_BITS, MOST = 8, 64, 9, 4096
COPIES_BYTES = 16 << 20  # of ids that a task keeps for exact copies of texts
TOGETHER_BYTES = 16 << 20  # of texts whose distinct words are encoded together
POLYNOMIAL = 0xEDB88320  # of crc32, lowest power first
SENT = 200_000  # digests whose ids a task knows to have sent
CUT = regex.compile(PIECES)
LETTER_OF = {b: x for x, b in byte_letters().items()}
BLANK = LETTER_OF[32]


class Encoder:
    """Ids as bytes. `many` takes texts together and encodes their distinct words by columns; what isn't fit for that
    is encoded by units, each of which, and each piece of them, is encoded once while it's remembered."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.merges = Merges(f.read(), {b: x for x, b in byte_letters().items()})
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = {s: np.array([i], self.dtype).tobytes() for s, i in added.items()}
        self.parts = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.of_key = Memo(self._of_key, most=600_000)
        self.kind = "H" if self.dtype.itemsize == 2 else "I"
        self.stops = {x: self._of_piece(x) for x in ".,"}  # a piece of their own after a letter

    def _of_key(self, key: str) -> bytes:
        if key.isascii() and key.isalpha():
            return self._of_piece(BLANK + key)
        if key[-1] in self.stops and key[:-1].isalpha() and WORD.fullmatch(key, 0, len(key) - 1):
            return self.of_key[key[:-1]] + self.stops[key[-1]]
        unit = unit_of(key)
        if WORD.fullmatch(unit):
            return self._of_piece(unit.encode().decode("latin-1").translate(LETTER_OF))
        if LATIN.fullmatch(unit):  # several pieces, that Unicode's versions can't differ on
            found = CUT.findall(unit)
            if len(found) > 1:
                return b"".join([self.of_key[x[1:] if x[0] == " " and x != " " else FIRST + x] for x in found])
            return self._of_piece(unit.encode().decode("latin-1").translate(LETTER_OF))
        return array(self.kind, self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()

    def _of_piece(self, letters: str) -> bytes:
        """Of what the pre-tokeniser leaves whole, in letters that stand for bytes."""
        return array(self.kind, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.of_key.__getitem__, keys(text)))

    def encode(self, text: str) -> bytes:
        if self.parts is None or not any(s in text for s in self.special):
            return self._plain(text)
        return b"".join([self.special.get(x) or self._plain(x) for x in self.parts.split(text) if x])

    def many(self, texts: list[str]) -> list[bytes]:
        """encode() of each text."""
        simple = [bool(x) and self.merges.plain and single_spaced(x) and not any(s in x for s in self.special) for x in texts]
        together = iter(self._together([blank_keys(x) for x, ok in zip(texts, simple, strict=True) if ok]))
        return [next(together) if ok else self.encode(x) for x, ok in zip(texts, simple, strict=True)]

    def _together(self, lines: list[str]) -> list[bytes]:
        words = pc.split_pattern(pa.array(lines, pa.large_string()), " ")
        flat = words.flatten().dictionary_encode()
        distinct = flat.dictionary
        _, ends, raw = distinct.buffers()
        offsets = np.frombuffer(ends or bytes(8), np.int64)[distinct.offset : distinct.offset + len(distinct) + 1]
        data = np.frombuffer(raw or b"", np.uint8)
        good = fit(data, offsets)
        known, odd = np.flatnonzero(good), np.flatnonzero(~good)
        values, place = encode_words(self.merges, data, offsets[known], np.diff(offsets)[known], self.dtype)
        rest = pa.array([self.of_key[x] for x in distinct.take(pa.array(odd)).to_pylist()], pa.large_binary())
        at = np.empty(len(distinct), np.int64)
        at[known], at[odd] = place, len(known) + np.arange(len(odd))
        ids = pa.concat_arrays([values, rest]).take(pa.array(at[flat.indices.to_numpy()]))
        _, ends, raw = ids.buffers()
        stream, to = memoryview(raw or b""), np.frombuffer(ends or bytes(8), np.int64)[words.offsets.to_numpy()].tolist()
        return [bytes(stream[a:b]) for a, b in zip(to, to[1:], strict=False)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_points(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the chunks of all documents ids[start:end] end, and the number of chunks of each."""
    n = len(ids) - WINDOW + 1
    rolled = np.zeros(max(n, 0), np.uint64)
    own = mix(ids.astype(np.uint64))
    for k in range(WINDOW if n > 0 else 0):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + own[k : k + n]
    marks = np.flatnonzero(mix(rolled) & np.uint64((1 << MEAN_BITS) - 1) == 0) + WINDOW  # a chunk may end before this position
    cuts, counts = [], []
    for a, b, i, j in zip(starts.tolist(), ends.tolist(), np.searchsorted(marks, starts).tolist(), np.searchsorted(marks, ends).tolist(), strict=True):
        before, at = len(cuts), a
        for mark in marks[i:j].tolist():
            while mark - at > MOST:
                at += MOST
                cuts.append(at)
            if mark - at >= LEAST:
                cuts.append(mark)
                at = mark
        while b - at > MOST:
            at += MOST
            cuts.append(at)
        if b > at:
            cuts.append(b)
        counts.append(len(cuts) - before)
    return np.array(cuts, np.int64), np.array(counts, np.int64)


def merkle_root(digests: list[bytes]) -> bytes:
    """Pairs are hashed level by level; an odd one goes up as it is. One digest is hashed once, so a root is never a leaf."""
    level = [hashlib.sha256(b"\0" + d).digest() for d in digests]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + b"".join(level[k : k + 2])).digest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0]


def crc_times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials over two elements modulo crc32's, bit-reversed as crc32 has them."""
    out = np.zeros(len(a), np.uint64)
    b = b.copy()
    for k in range(31, -1, -1):
        out ^= np.where(a >> np.uint64(k) & np.uint64(1), b, np.uint64(0))
        b = (b >> np.uint64(1)) ^ np.where(b & np.uint64(1), np.uint64(POLYNOMIAL), np.uint64(0))
    return out


@lru_cache(maxsize=64)
def crc_table(k: int) -> np.ndarray:
    """4 x 256: what each byte of a crc32 gives when 2**k bytes follow."""
    if not k:
        power = np.array([1 << 23], np.uint64)  # x**8
        bytes_ = np.arange(256, dtype=np.uint64) << np.array([[0], [8], [16], [24]], np.uint64)
        return crc_times(bytes_.ravel(), np.broadcast_to(power, 1024)).reshape(4, 256).astype(np.uint32)
    return crc_moved(crc_table(k - 1), k - 1)


def crc_moved(crc: np.ndarray, k: int) -> np.ndarray:
    table = crc_table(k)
    return table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24]


def crc_shifted(crc: np.ndarray, after: np.ndarray) -> np.ndarray:
    """What a part's crc32 adds, by exclusive or, to that of a whole with `after` more bytes."""
    out, left, k = crc.astype(np.uint32), after.astype(np.int64), 0
    while left.any():
        odd = np.flatnonzero(left & 1)
        out[odd] = crc_moved(out[odd], k)
        left, k = left >> 1, k + 1
    return out


@dataclass
class Store:
    """Paths of the two tables."""

    chunks: str
    recipes: str


def encoded(batches: Iterator[pa.RecordBatch], e: Encoder, last: bytes) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Small slices of the batches, with the ids of their texts, each of which ends with `last`."""
    copies: dict[bytes, bytes] = {}
    held = 0
    for group in grouped(slices(batches, most=1 << 20), TOGETHER_BYTES):
        if held > COPIES_BYTES:
            copies, held = {}, 0
        named, new = [], {}
        for batch in group:
            own = []
            for x in texts(batch):
                key = hashlib.blake2b(x or b"", digest_size=16).digest()
                if key not in copies:
                    new[key] = x
                own.append(key)
            named.append(own)
        for key, ids in zip(new, e.many([decoded(x) for x in new.values()]), strict=True):
            copies[key] = ids + last
            held += len(ids)
        for batch, own in zip(group, named, strict=True):
            yield batch, [copies[key] for key in own]


def chunked(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """A row for each chunk of each document; `ids` is null where the task has sent the chunk before."""
    ready(docs.sparkSession)
    names = ["row", "id", "seq", "at", "total", "digest", "n", "ids", "root"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e, sent = encoder(tokenizer), {}
        last = np.array([end], e.dtype).tobytes()
        width = e.dtype.itemsize
        for batch, streams in encoded(batches, e, last):
            totals = np.array([len(x) // width for x in streams])
            starts = np.cumsum(totals) - totals
            data = b"".join(streams)
            to, counts = cut_points(np.frombuffer(data, e.dtype), starts, starts + totals)
            since = np.concatenate(([0], to[:-1]))
            pieces = [data[a:b] for a, b in zip((since * width).tolist(), (to * width).tolist(), strict=True)]
            digests = [hashlib.sha256(x).digest() for x in pieces]
            if len(sent) > SENT:
                sent.clear()
            once: list[bytes | None] = []
            for digest, x in zip(digests, pieces, strict=True):
                once.append(None if digest in sent else x)
                sent[digest] = None
            heads = np.cumsum(counts) - counts
            roots: list[bytes | None] = [None] * len(pieces)
            for a, n in zip(heads.tolist(), counts.tolist(), strict=True):
                roots[a] = merkle_root(digests[a : a + n])
            of = np.repeat(np.arange(batch.num_rows), counts)
            columns = [
                batch.column("row").take(pa.array(of)), batch.column("id").take(pa.array(of)), np.arange(len(of)) - heads[of], since - starts[of], totals[of], digests, to - since, once, roots,
            ]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    keyed = id_and_text(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    return keyed.mapInArrow(run, "row long, id long, seq int, at long, total long, digest binary, n int, ids binary, root binary")


def running_start(df: DataFrame, order: list[str], value: str, name: str = "start") -> DataFrame:
    """df in ascending order with the sum of `value` over all rows before. Sums run within ranges of the order, and over the ranges' totals."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    totals = ranged.groupBy("__part").agg(F.sum(value).alias("__sum"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = totals.select(F.col("__part").alias("__of"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return summed.join(F.broadcast(offsets), F.col("__part") == F.col("__of")).withColumn(name, F.col(name) + F.col("__offset")).drop("__of", "__offset", "__sum")


def write(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int = END, to: Store | None = None) -> Store:
    spark = docs.sparkSession
    to = to or Store(fresh_path(spark, "chunks"), fresh_path(spark, "recipes"))
    place = F.when(F.col("ids").isNotNull(), F.xxhash64("digest")).otherwise(F.xxhash64("row", "seq"))
    dealt = chunked(docs, tokenizer, id_col, text_col, end).withColumn("place", place).repartition("place")
    nth = F.row_number().over(Window.partitionBy("place", F.col("digest"), F.col("ids").isNotNull()).orderBy("row", "seq"))
    once = dealt.withColumn("ids", F.when(nth == 1, F.col("ids")))
    once.drop("place").write.parquet(to.chunks)
    parts = F.sort_array(F.collect_list(F.struct("seq", "at", "n", "digest")))
    whole = spark.read.parquet(to.chunks).groupBy("row").agg(F.first("id").alias("id"), F.first("total").alias("total"), F.max("root").alias("root"), parts.alias("parts"))
    ordered = running_start(whole, ["id", "row"], "total")
    ordered.sortWithinPartitions("id", "row").drop("__part").write.parquet(to.recipes)
    return to


def read_chunks(spark: SparkSession, store: Store) -> DataFrame:
    """digest, stored (the number of ids read), crc (of the ids as 32-bit numbers), intact (the digest is that of the ids read)."""
    names = ["digest", "stored", "crc", "intact"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            ids, widths = texts(batch, "ids"), batch.column("width").to_pylist()
            wide = [np.frombuffer(x[: len(x) // w * w], f"<u{w}").astype("<u4") for x, w in zip(ids, widths, strict=True)]
            crc = [zlib.crc32(x) for x in wide]
            intact = [hashlib.sha256(x).digest() == d for x, d in zip(ids, batch.column("digest").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array([len(x) for x in wide], pa.int64()), pa.array(crc, pa.int64()), pa.array(intact, pa.bool_())], names)

    width = F.when(F.octet_length("ids") >= 4 * F.col("n"), 4).otherwise(2)
    stored = spark.read.parquet(store.chunks).where("ids IS NOT NULL").select("digest", width.alias("width"), "ids")
    return stored.mapInArrow(run, "digest binary, stored long, crc long, intact boolean")


def verified(spark: SparkSession, store: Store, id_col: str = "doc_id") -> DataFrame:
    """Reads the store back. Per document of the recipes: id, start, n_tokens and ids_crc32 (of the ids read), n_chunks, root (hex),
    intact (each chunk is there, has its digest and its length, they follow one another without gaps, and the root is theirs).
    """
    recipes = spark.read.parquet(store.recipes)
    uses = recipes.select("row", "total", F.explode("parts").alias("part")).select("row", "part.digest", "part.n", (4 * (F.col("total") - F.col("part.at") - F.col("part.n"))).alias("after"))

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term = crc_shifted(batch.column("crc").to_numpy(), batch.column("after").to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(term.astype(np.int64)), batch.column("stored"), batch.column("holds")], ["row", "term", "stored", "holds"])

    read = uses.join(read_chunks(spark, store), "digest", "left")
    holds = F.coalesce(F.col("intact") & (F.col("stored") == F.col("n")), F.lit(False)).alias("holds")
    found = read.select("row", F.coalesce("crc", F.lit(0)).alias("crc"), "after", F.coalesce("stored", F.lit(0)).cast("long").alias("stored"), holds)
    terms = found.mapInArrow(shift, "row long, term long, stored long, holds boolean")
    sums = terms.groupBy("row").agg(F.bit_xor("term").alias("crc"), F.sum("stored").alias("n_tokens"), F.bool_and("holds").alias("chunks_hold"))
    names = ["row", "id", "start", "n_chunks", "root", "root_holds"]

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, stored = batch.column("parts"), batch.column("root").to_pylist()
            counts, flat = parts.value_lengths().fill_null(0).to_numpy(), parts.flatten()
            heads, sizes = np.cumsum(counts) - counts, flat.field("n").to_numpy()
            before = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
            wrong = np.concatenate(([0], np.cumsum(flat.field("at").to_numpy() != before[:-1] - np.repeat(before[heads], counts))))
            whole = (wrong[heads + counts] == wrong[heads]) & (before[heads + counts] - before[heads] == batch.column("total").to_numpy()) & (counts > 0)
            digests = flat.field("digest").to_pylist()
            holds = [ok and merkle_root(digests[a : a + n]) == root for ok, a, n, root in zip(whole.tolist(), heads.tolist(), counts.tolist(), stored, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in ("row", "id", "start")), pa.array(counts, pa.int64()), pa.array([x and x.hex() for x in stored], pa.string()), pa.array(holds, pa.bool_())], names)

    checked = recipes.select("row", "id", "start", "total", "parts", "root").mapInArrow(roots, "row long, id long, start long, n_chunks long, root string, root_holds boolean")
    hold = F.coalesce(F.col("chunks_hold") & F.col("root_holds"), F.lit(False))
    return checked.join(sums, "row", "left").select(F.col("id").alias(id_col), "start", F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), F.coalesce("crc", F.lit(0)).alias("ids_crc32"), "n_chunks", "root", hold.alias("intact"))


def reconstructed(spark: SparkSession, store: Store, id_col: str = "doc_id") -> DataFrame:
    """Per document: id, start, ids (array of int), put together from its chunks."""
    uses = spark.read.parquet(store.recipes).select("row", "id", "start", F.explode("parts").alias("part")).select("row", "id", "start", "part.seq", "part.n", "part.digest")
    ids = spark.read.parquet(store.chunks).where("ids IS NOT NULL").select("digest", "ids")
    whole = uses.join(ids, "digest").groupBy("row").agg(F.first("id").alias("id"), F.first("start").alias("start"), F.sort_array(F.collect_list(F.struct("seq", "n", "ids"))).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [np.concatenate([np.frombuffer(p["ids"], f"<u{len(p['ids']) // p['n']}") for p in own]).astype(np.int32) for own in batch.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("start"), pa.array(got, pa.list_(pa.int32()))], [id_col, "start", "ids"])

    return whole.select("id", "start", "parts").mapInArrow(run, f"`{id_col}` long, start long, ids array<int>")
