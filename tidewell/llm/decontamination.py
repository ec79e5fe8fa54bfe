"""Benchmark decontamination with an FM-index for each training shard.

A shard is a slice of documents. Its words become numbers of the benchmark's vocabulary; words that no
test phrase has can be in no occurrence and become separators, as do document ends. Over that text the
shard's FM-index is built: suffix array, Burrows-Wheeler transform, wavelet matrix, and the suffix
positions sampled at every STEP-th word and at each start of a run. All phrases are searched backwards at
once by ranks in the wavelet matrix; ranges that stay are walked to the next sampled position. Hits merge
into spans of words and bytes.

A phrase is WIDTH consecutive words of a benchmark item, or all words of a shorter item. The benchmark
goes to the executors in blocks of at most BLOCK_BYTES of text; documents pass one map for each block,
and nothing is shuffled. Where passages are cut out, spans of all blocks are found on the same text and
their union is cut at once; texts that were cut pass all blocks again, until none hits.

Defined results: null and wordless texts have no words and no hits; null items and items without words
have no phrase; items with the same id count as one; repeated rows are answered each; empty tables give
no rows (documents) or no hits (benchmark); extra columns are ignored or, in decontaminate(), kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import place_of, slices, texts, unused
from tidewell.llm.textwords import ALNUM, Words, words
from tidewell.session import materialise, ready

WIDTH, STEP = 10, 8
BLOCK_BYTES = 8 << 20


class Phrases:
    """The distinct windows of a block of items, as rows of vocabulary numbers from 1 (0 pads short ones on the left)."""

    def __init__(self, items: list[tuple[str, bytes]], width: int = WIDTH):
        found = words([t for _, t in items], ALNUM)
        self.vocabulary = np.unique(found.hashes)
        ids = np.searchsorted(self.vocabulary, found.hashes) + 1
        rows, owners = [], []
        for k in range(len(items)):
            a, b = found.first[k], found.first[k + 1]
            if b - a >= width:
                rows.append(np.lib.stride_tricks.sliding_window_view(ids[a:b], width))
                owners += [k] * (b - a - width + 1)
            elif b > a:
                rows.append(np.concatenate((np.zeros(width - (b - a), np.int64), ids[a:b]))[None])
                owners.append(k)
        self.items = sorted({i for i, _ in items})
        number = {i: k for k, i in enumerate(self.items)}
        every = np.concatenate(rows) if rows else np.empty((0, width), np.int64)
        self.rows, of = np.unique(every, axis=0, return_inverse=True) if len(every) else (every, np.empty(0, np.int64))
        self.lengths = (self.rows > 0).sum(1)
        pairs = np.unique(np.stack([of.ravel(), np.array([number[items[k][0]] for k in owners], np.int64)], 1), axis=0) if len(every) else np.empty((0, 2), np.int64)
        self.item_of = pairs[:, 1]  # items of window w: item_of[item_at[w] : item_at[w + 1]]
        self.item_at = np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """By prefix doubling. Zeros are separators, each different from all others, so ties end within a run."""
    n, zero = len(symbols), symbols == 0
    rank = np.where(zero, np.cumsum(zero) - 1, symbols + zero.sum()).astype(np.int64)
    step = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        key = rank * (int(max(rank.max(), after.max())) + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.cumsum(np.concatenate(([0], key[order][1:] != key[order][:-1])))
        rank = new
        if rank[order[-1]] == n - 1:
            return order
        step *= 2


class FmIndex:
    def __init__(self, symbols: np.ndarray, sizes: int, step: int = STEP):
        """symbols: numbers below `sizes`, the last one 0 (the separator)."""
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1]
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=sizes))))
        self.levels, left = [], self.bwt
        for bit in reversed(range(max(1, int(sizes - 1).bit_length()))):
            ones = (left >> bit & 1).astype(bool)
            self.levels.append((bit, np.concatenate(([0], np.cumsum(ones))), len(left) - int(ones.sum())))
            left = np.concatenate((left[~ones], left[ones]))
        first = np.concatenate(([True], symbols[:-1] == 0))  # walks never go past the start of a run
        self.sampled = (order % step == 0) | first[order]
        self.position = np.where(self.sampled, order, -1)

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of symbol in the first `at` letters of the transform."""
        low = np.zeros_like(at)
        for bit, ones, zeros in self.levels:
            up = (symbol >> bit & 1).astype(bool)
            at, low = np.where(up, zeros + ones[at], at - ones[at]), np.where(up, zeros + ones[low], low - ones[low])
        return at - low

    def search(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, low, high) of the rows that occur; zeros on the left of a row pad it."""
        which = np.arange(len(rows))
        low, high = self.before[rows[:, -1]], self.before[rows[:, -1] + 1]
        for k in range(rows.shape[1] - 2, -1, -1):
            keep = high > low
            which, low, high = which[keep], low[keep], high[keep]
            c = rows[which, k]
            more = c > 0
            low, high = np.where(more, self.before[c] + self.rank(c, low), low), np.where(more, self.before[c] + self.rank(c, high), high)
        keep = high > low
        return which[keep], low[keep], high[keep]

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of rows of the suffix array."""
        out, walking, steps = np.empty(len(at), np.int64), np.arange(len(at)), 0
        while len(walking):
            there = self.sampled[at]
            out[walking[there]] = self.position[at[there]] + steps
            walking, at = walking[~there], at[~there]
            c = self.bwt[at]
            at = self.before[c] + self.rank(c, at)
            steps += 1
        return out


@dataclass
class Hits:
    first: np.ndarray  # word positions in the shard, end exclusive; a row for each occurrence
    last: np.ndarray
    document: np.ndarray
    window: np.ndarray


def hits(found: Words, phrases: Phrases) -> Hits:
    """Every occurrence of every phrase in a shard."""
    none = np.empty(0, np.int64)
    if not len(phrases.rows) or not len(found.hashes):
        return Hits(none, none, none, none)
    place = np.minimum(np.searchsorted(phrases.vocabulary, found.hashes), len(phrases.vocabulary) - 1)
    ids = np.where(phrases.vocabulary[place] == found.hashes, place + 1, 0)
    # Runs of vocabulary words within documents that are as long as the shortest phrase, each with a separator after it.
    document = np.repeat(np.arange(len(found.first) - 1), np.diff(found.first))
    known = np.concatenate(([False], ids > 0, [False]))
    fresh = np.concatenate(([False], document[1:] != document[:-1], [False]))
    begin = np.flatnonzero(known[1:-1] & (~known[:-2] | fresh[:-1][: len(ids)]))
    over = np.flatnonzero(known[1:-1] & (~known[2:] | np.concatenate((fresh[1:-1], [True])))) + 1
    keep = over - begin >= phrases.lengths.min()
    begin, over = begin[keep], over[keep]
    if not len(begin):
        return Hits(none, none, none, none)
    sizes = over - begin + 1
    origin = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes - begin, sizes)
    symbols = ids[np.minimum(origin, len(ids) - 1)]
    symbols[np.cumsum(sizes) - 1] = 0
    index = FmIndex(symbols, len(phrases.vocabulary) + 1)
    which, low, high = index.search(phrases.rows)
    count = high - low
    rows = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)
    window = np.repeat(which, count)
    first = origin[index.locate(rows)]
    return Hits(first, first + phrases.lengths[window], document[first], window)


def merged(first: np.ndarray, last: np.ndarray) -> list[tuple[int, int]]:
    """The union of spans, as disjoint spans in order; spans that touch become one."""
    out: list[tuple[int, int]] = []
    for k in np.argsort(first, kind="stable").tolist():
        a, b = int(first[k]), int(last[k])
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", most: int = BLOCK_BYTES, width: int = WIDTH) -> Iterator[Phrases]:
    """The benchmark in blocks of about `most` bytes at most; one item alone may be longer."""
    items = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text")).where("item IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    count = max(1, -(-2 * total // most) if total > most else 1)
    for k in range(count):
        block = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == k) if count > 1 else items
        yield Phrases(sorted((r.item, bytes(r.text)) for r in block.collect()), width)


def _scan(docs: DataFrame, held, last: bool) -> DataFrame:
    """One block: adds its spans (pairs of word positions in the document) and items to those so far."""
    so_far = "array<struct<a:long,b:long>>"
    names = ["id", "n_words", "spans", "bytes", "items"] if last else ["id", "text", "spans", "items"]
    schema = f"id long, n_words long, spans {so_far}, bytes {so_far}, items array<string>" if last else f"id long, text binary, spans {so_far}, items array<string>"
    pairs = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases: Phrases = held.value
        for batch in slices(batches):
            found = words(texts(batch), ALNUM)
            got = hits(found, phrases)
            spans = [[(x["a"], x["b"]) for x in row or ()] for row in batch.column("spans").to_pylist()]
            items = [set(row or ()) for row in batch.column("items").to_pylist()]
            order = np.argsort(got.document, kind="stable")
            edges = np.searchsorted(got.document[order], np.arange(batch.num_rows + 1))
            in_bytes: list[list[tuple[int, int]]] = [[] for _ in spans]
            for k in np.unique(got.document).tolist():
                own = order[edges[k] : edges[k + 1]]
                for w in np.unique(got.window[own]).tolist():
                    items[k].update(phrases.items[i] for i in phrases.item_of[phrases.item_at[w] : phrases.item_at[w + 1]])
                new = merged(got.first[own] - found.first[k], got.last[own] - found.first[k])
                spans[k] = merged(*np.array(spans[k] + new).T)
            if last:
                for k, row in enumerate(spans):
                    at, base = found.first[k], found.base[k]
                    in_bytes[k] = [(int(found.starts[at + a] - base), int(found.ends[at + b - 1] - base)) for a, b in row]
            put = lambda rows: pa.array([[{"a": a, "b": b} for a, b in r] for r in rows], pairs)
            listed = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
            columns = [pa.array(np.diff(found.first).astype(np.int64)), put(spans), put(in_bytes), listed] if last else [batch.column("text"), put(spans), listed]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    return docs.select("id", "text", "spans", "items").mapInArrow(run, schema)


def occurrences(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", width: int = WIDTH) -> DataFrame:
    """Per row: id, n_words, spans (merged, of word positions), bytes (the same in bytes of the text), items (that occur, sorted as strings)."""
    spark = ready(docs.sparkSession)
    blocks = list(benchmark_blocks(benchmark, item_col, text_col, width=width))
    out = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"),
        F.lit(None).cast("array<struct<a:long,b:long>>").alias("spans"),
        F.lit(None).cast("array<string>").alias("items"),
    )
    for k, phrases in enumerate(blocks):
        out = _scan(out, spark.sparkContext.broadcast(phrases), k == len(blocks) - 1)
    return out.withColumnRenamed("id", id_col)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id") -> DataFrame:
    """Per row: id, n_words, n_hit (words inside occurrences), n_items, items_sha256, contaminated."""
    found = occurrences(docs, benchmark, id_col, text_col, item_col)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["b"] - x["a"])
    return found.select(
        id_col,
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


_WORD = re.compile(r"[0-9A-Za-z]|[^\x00-\x7F]")  # what a word has


def _cut_out(text: bytes, spans: list[tuple[int, int]], starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The text without spans of its words, which begin and end at these bytes."""
    parts, at = [], 0
    for a, b in spans:
        parts.append(text[at : starts[a]].rstrip(b" "))
        at = int(ends[b - 1])
    return b"\n".join([*parts, text[at:].lstrip(b" .,;")]).strip()


def without(text: bytes, phrases: list[Phrases]) -> bytes:
    """The text without the spans that phrases hit, until none does."""
    while True:
        found = words([text], ALNUM)
        got = [hits(found, p) for p in phrases]
        spans = merged(np.concatenate([g.first for g in got]), np.concatenate([g.last for g in got]))
        if not spans:
            return text
        text = _cut_out(text, spans, found.starts - found.base[0], found.ends - found.base[0])


def _encoded(part: pa.RecordBatch, at: int) -> list[bytes | None]:
    return [None if x is None else x.encode() for x in part.column(at).to_pylist()]


def _replaced(part: pa.RecordBatch, text_at: int, length_at: int, new: dict[int, bytes]) -> pa.RecordBatch:
    """The batch with new texts for some rows, and their lengths made to fit; of these, rows left without a word go."""
    columns = list(part.columns)
    cut = {k: x.decode("utf-8", "replace") for k, x in new.items()}
    columns[text_at] = pa.array([cut.get(k, x) for k, x in enumerate(columns[text_at].to_pylist())], columns[text_at].type)
    if length_at >= 0:
        columns[length_at] = pa.array([len(cut[k]) if k in cut else n for k, n in enumerate(columns[length_at].to_pylist())], columns[length_at].type)
    left = pa.RecordBatch.from_arrays(columns, schema=part.schema)
    return left.filter(pa.array([k not in cut or _WORD.search(cut[k]) is not None for k in range(part.num_rows)]))


def _spanned(docs: DataFrame, held, text_col: str, spans_col: str) -> DataFrame:
    """One block: docs with its spans (word positions a, b, a, b, ... of disjoint ones) added to those so far."""
    text_at, spans_at = docs.columns.index(text_col), docs.columns.index(spans_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], text_col):
                found = words(_encoded(part, text_at), ALNUM)
                got = hits(found, held.value)
                spans = part.column(spans_at).to_pylist()
                for k in np.unique(got.document).tolist():
                    own, old = got.document == k, np.array(spans[k] or [], np.int64)
                    first, last = got.first[own] - found.first[k], got.last[own] - found.first[k]
                    spans[k] = [x for pair in merged(np.concatenate((old[::2], first)), np.concatenate((old[1::2], last))) for x in pair]
                yield part.set_column(spans_at, part.schema.field(spans_at), pa.array(spans, part.schema.field(spans_at).type))

    return docs.mapInArrow(run, docs.schema)


def _passages_cut(docs: DataFrame, text_col: str, length_at: int, spans_col: str, cut_col: str) -> DataFrame:
    """docs with their spans cut out of the text, and whether a row was cut in place of its spans."""
    names = docs.columns
    text_at, spans_at = names.index(text_col), names.index(spans_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch], text_col):
                raw, spans = _encoded(part, text_at), part.column(spans_at).to_pylist()
                found, new = words(raw, ALNUM), {}
                for k, row in enumerate(spans):
                    if row:
                        own = slice(found.first[k], found.first[k + 1])
                        new[k] = _cut_out(raw[k], list(zip(row[::2], row[1::2], strict=True)), found.starts[own] - found.base[k], found.ends[own] - found.base[k])
                yield _replaced(part.set_column(spans_at, cut_col, pa.array([bool(x) for x in spans])), text_at, length_at, new)

    return docs.mapInArrow(run, docs.drop(spans_col).withColumn(cut_col, F.lit(True)).schema)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", length_col: str | None = "n_chars") -> DataFrame:
    """docs with every hit span cut out of the text, and length_col (if docs have it) made to fit; rows left without a word go."""
    spark = ready(docs.sparkSession)
    schema = docs.schema
    text_at, length_at = place_of(docs, text_col), place_of(docs, length_col) if length_col else -1
    item_text, text_col, spans_col, cut_col = text_col, docs.columns[text_at], unused(docs, "__spans"), unused(docs, "__cut")
    blocks = [spark.sparkContext.broadcast(p) for p in benchmark_blocks(benchmark, item_col, item_text)]
    if len(blocks) == 1:  # all rounds within the task
        held = blocks[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices([batch], text_col):
                    raw = _encoded(part, text_at)
                    hit = np.unique(hits(words(raw, ALNUM), held.value).document).tolist()
                    yield _replaced(part, text_at, length_at, {k: without(raw[k], [held.value]) for k in hit}) if hit else part

        return docs.mapInArrow(run, schema)
    done, left = None, docs
    while True:
        left = left.withColumn(spans_col, F.lit(None).cast("array<long>"))
        for held in blocks:
            left = _spanned(left, held, text_col, spans_col)
        cut = materialise(_passages_cut(left, text_col, length_at, spans_col, cut_col), "passages")
        whole = cut.where(f"NOT {cut_col}").drop(cut_col)
        done = whole if done is None else done.unionByName(whole)
        left = cut.where(cut_col).drop(cut_col)
        if left.isEmpty():
            return done
