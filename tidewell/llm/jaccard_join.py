"""Near duplicates: documents whose sets of word shingles have a Jaccard of at least 3/4.

A parity-sketch join (see parity.py). Exact copies fold into one set first. Each set sends the words of
its sketch that the pigeonhole argument asks for, as keys. Sets that share a key are candidates:

1. in a few rounds, every set is compared with the centres that its keys name most often, by bit sketches
   and then in full, and what holds is folded into components. A key's sets are dealt to parts of bounded
   size, each with a centre of its own (least by a hash), so a family of copies costs a few comparisons
   each, not pairs, and no centre has many;
2. for keys that then still join sets of different components, all such pairs are compared by size
   and by the Hamming distance of bit sketches within the join, and what passes is verified. A pair
   counts at a key only if the sets share none of their LOOK_BACK keys before it; at the least key
   that two sets share that always holds.

So no link that could change a component is lost, and none leads out of one. Links themselves are then
counted (near_duplicates()) or listed (set_links()) by comparing each component with itself in blocks.
Verification compares whole sets of 64-bit shingle hashes.

Defined results: null, empty and wordless texts have no shingle and are linked with nothing; texts of
fewer than WIDTH words are one shingle; a null id never is a component's id unless all its ids are null;
repeated rows are answered each; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm import parity
from tidewell.llm.batches import id_and_text, slices, texts, unused
from tidewell.llm.components import components
from tidewell.llm.textwords import NOT_SPACE, U, shingle_sets, words
from tidewell.session import materialise, ready

STAR_ROUNDS = 3
BITMAP_BITS = 26  # of the filter that tells which sets are candidates; its size is fixed
PIECES = 64  # that counts and bitmaps are summed in
LOOK_BACK = 4
SIZE_STEP = 1.4  # sizes that fit, by 4/3 at most, are a step apart at most
CENTRES = 3  # that a set is compared with in a round, of those its keys name
HOT_KEY = 256  # sets in a part of a key; each part has a centre
BLOCK_SETS, BLOCK_BYTES = 256, 8 << 20  # of a component, that a task compares with as many others
COLUMNS = 4096  # shingles in one product of matrices
REMEMBERED = 500_000  # set ids by which a task leaves out copies it has met
MOST_COUNTED = (1 << 16) - 1  # counts end there: what is as common comes last in any case
Block = tuple[list[int], list[int], list[np.ndarray]]  # set ids, their copies, their shingles
SKETCH = [f"k{i}" for i in range(parity.SKETCH_WORDS)]


def _sets(batch: pa.RecordBatch) -> list[np.ndarray]:
    return shingle_sets(words(texts(batch), NOT_SPACE), parity.WIDTH)


class _Ids:
    """Set ids; the second hash where the first is known to stand for several sets."""

    def __init__(self, shared: frozenset[int]):
        self.shared, self.met = shared, set()

    def of(self, sets: list[np.ndarray]) -> list[int]:
        first, second = parity.set_ids(sets)
        return [y if x in self.shared else x for x, y in zip(first.tolist(), second.tolist(), strict=True)] if self.shared else first.tolist()

    def fresh(self, sets: list[np.ndarray]) -> tuple[list[int], list[np.ndarray]]:
        """Ids and sets of the non-empty ones that the task meets for the first time, as far as it remembers."""
        out = []
        for sid, s in zip(self.of(sets), sets, strict=True):
            if len(s) and sid not in self.met:
                if len(self.met) >= REMEMBERED:
                    self.met.clear()
                self.met.add(sid)
                out.append((sid, s))
        return [x for x, _ in out], [x for _, x in out]


def document_sets(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, frozenset[int], np.ndarray]:
    """(id, n, sid) of every row, written to the shared folder; the first hashes that several sets share (none, but by chance);
    and the number of sets by shingle, in 2**COUNT_BITS buckets of shingles. Counts cover all documents, order keys and decide nothing else.
    """
    names = ["id", "n", "s1", "s2", "piece", "task", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts = _Ids(frozenset()), np.zeros(1 << parity.COUNT_BITS, np.uint16)
        for batch in slices(batches):
            found = _sets(batch)
            _, fresh = ids.fresh(found)
            if fresh:
                at, n = np.unique((np.concatenate(fresh) >> U(64 - parity.COUNT_BITS)).astype(np.int64), return_counts=True)
                counts[at] = np.minimum(counts[at] + n, MOST_COUNTED)
            s1, s2 = parity.set_ids(found)
            none = [pa.nulls(batch.num_rows, t) for t in (pa.int32(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(s) for s in found], pa.int64()), pa.array(s1), pa.array(s2), *none], names)
        pieces = _pieces(counts)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(pieces.num_rows, pa.int64())] * 4, *pieces.columns], names)

    both = materialise(id_and_text(docs, id_col, text_col).mapInArrow(run, "id long, n long, s1 long, s2 long, piece int, task long, data binary"), "sets")
    rows = both.where("piece IS NULL").select("id", "n", "s1", "s2")
    shared = rows.groupBy("s1").agg(F.min("s2").alias("least"), F.max("s2").alias("most")).where("least <> most").select("s1")
    # In expectation (distinct sets)**2 / 2**65 rows: a few dozen for 10**10 sets.
    clashing = frozenset(r.s1 for r in shared.collect())
    counts = _summed(both.where("piece IS NOT NULL").select("piece", "task", "data"), "<u2", _Saturating)
    sid = F.when(F.col("s1").isin(*clashing), F.col("s2")).otherwise(F.col("s1")) if clashing else F.col("s1")
    return rows.select("id", "n", sid.alias("sid")), clashing, counts if len(counts) else np.zeros(1 << parity.COUNT_BITS, "<u2")


def _summed(parts: DataFrame, dtype: str, join) -> np.ndarray:
    """One array of a fixed size from the pieces of all tasks: first within groups of tasks, then over these."""

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = join.reduce(np.stack([np.frombuffer(zlib.decompress(x), dtype) for x in pdf["data"]]))
        return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "data": [zlib.compress(whole.astype(dtype).tobytes(), 1)]})

    few = parts.groupBy("piece", F.pmod("task", F.lit(64)).alias("some")).applyInPandas(lambda pdf: total(pdf), "piece int, data binary")
    rows = few.groupBy("piece").applyInPandas(total, "piece int, data binary").collect()  # PIECES rows of a fixed size
    return np.concatenate([np.frombuffer(zlib.decompress(r.data), dtype) for r in sorted(rows)]) if rows else np.empty(0, dtype)


def _pieces(whole: np.ndarray) -> pa.RecordBatch:
    from pyspark import TaskContext

    context = TaskContext.get()
    parts = np.array_split(whole, PIECES)
    return pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), pa.array([context.partitionId() if context else 0] * PIECES, pa.int64()), pa.array([zlib.compress(p.tobytes(), 1) for p in parts], pa.binary())], ["piece", "task", "data"])


class _Saturating:
    @staticmethod
    def reduce(rows: np.ndarray) -> np.ndarray:
        return np.minimum(rows.astype(np.int64).sum(0), MOST_COUNTED)


def key_rows(kept: DataFrame, counts: np.ndarray, clashing: frozenset[int]) -> DataFrame:
    """(key, sid, n, parts): keys that at least two sets have, and the parts (a power of two) that the rows of a key of many sets are dealt to."""
    held = kept.sparkSession.sparkContext.broadcast(counts)  # 2**COUNT_BITS numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _Ids(clashing)
        for batch in slices(batches):
            sids, sets = ids.fresh(_sets(batch))
            found, of = parity.keys(sets, held.value)
            sizes = np.array([len(x) for x in sets], np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(np.array(sids, np.int64)[of]), pa.array(sizes[of])], ["key", "sid", "n"])

    every = kept.mapInArrow(run, "key long, sid long, n int")
    own = Window.partitionBy("key")
    several = every.withColumns({"least": F.min("sid").over(own), "most": F.max("sid").over(own), "rows": F.count("*").over(own)}).where("least <> most")
    parts = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(F.col("rows") / HOT_KEY)))).cast("int")
    return materialise(several.select("key", "sid", "n", parts.alias("parts")).distinct(), "keys")


def candidate_sets(kept: DataFrame, keyed: DataFrame, clashing: frozenset[int]) -> DataFrame:
    """(sid, n, shingles, bit sketch) of the sets that share a key. A bitmap of a fixed size keeps most others from the shuffle."""
    spark = kept.sparkSession
    wanted = materialise(keyed.select("sid").distinct(), "candidates")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << BITMAP_BITS - 3, np.uint8)
        for batch in batches:
            at = batch.column("sid").to_numpy().view(np.uint64) & U((1 << BITMAP_BITS) - 1)
            np.bitwise_or.at(bits, (at >> U(3)).astype(np.int64), np.left_shift(1, (at & U(7)).astype(np.int64)).astype(np.uint8))
        yield _pieces(bits)

    bitmap = _summed(wanted.coalesce(64).mapInArrow(mark, "piece int, task long, data binary"), "u1", np.bitwise_or)
    held = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, bits = _Ids(clashing), held.value
        for batch in slices(batches):
            found = _sets(batch)
            marked = [s for s, sid in zip(found, ids.of(found), strict=True) if len(bits) and bits[(sid & (1 << BITMAP_BITS) - 1) >> 3] >> (sid & 7) & 1]
            rows = [(sid, len(s), s.tobytes(), parity.wide_sketch(s), *parity.bit_sketch(s).tolist()) for sid, s in zip(*ids.fresh(marked), strict=True)]
            columns = zip(*rows, strict=True) if rows else [[]] * (4 + len(SKETCH))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), *[pa.int64()] * len(SKETCH)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["sid", "n", "shingles", "wide", *SKETCH])

    found = kept.mapInArrow(run, "sid long, n int, shingles binary, wide binary, " + ", ".join(f"{k} long" for k in SKETCH))
    # The same set from several tasks is the same row: rows of one sid are side by side after the shuffle, the first stays.
    dealt = found.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "sid").join(wanted, "sid", "left_semi")
    once = dealt.withColumn("nth", F.row_number().over(Window.partitionBy("sid").orderBy("n"))).where("nth = 1").drop("nth")
    # On disk and by sid, so that no join with it moves it again; what a lost executor held is made anew.
    return once.persist(StorageLevel.DISK_ONLY)


def _with_both(pairs: DataFrame, sets: DataFrame, column: str) -> DataFrame:
    """(a, b, m, n, x, y): the sizes and a column of both sets of each pair. The kept sets stay where they are: pairs go to those of a, then to those of b."""
    side = lambda key, n, x: sets.select(F.col("sid").alias(key), F.col("n").alias(n), F.col(column).alias(x))
    return pairs.join(side("a", "m", "x"), "a").join(side("b", "n", "y"), "b")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of set ids that are linked: by wide sketches, which rule out most, then by whole sets."""

    def by_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in ("m", "n", "x", "y")), strict=True)
            keep = [7 * parity.distance(x, y) <= m + n for m, n, x, y in rows]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def by_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "x"):
            keep = [parity.linked(np.frombuffer(x, U), np.frombuffer(y, U)) for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    close = _with_both(pairs, sets, "wide").select("a", "b", "m", "n", "x", "y").mapInArrow(by_sketch, "a long, b long")
    return _with_both(materialise(close, "close-pairs"), sets, "shingles").select("a", "b", "x", "y").mapInArrow(by_sets, "a long, b long")


def _sizes_fit(n: Column, m: Column) -> Column:
    return 4 * F.least(n, m) >= 3 * F.greatest(n, m)


def _apart() -> Column:
    """The Hamming distance of the bit sketches of sides a and b: at most |A xor B|, so at most (|A| + |B|) / 7 where they're linked."""
    return sum((F.bit_count(F.col(f"a_{k}").bitwiseXOR(F.col(f"b_{k}"))) for k in SKETCH), F.lit(0))


def _labelled(keyed: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Key rows with their components; only those with a row of another component at their key whose size may fit."""
    if labels is None:
        return keyed.withColumn("label", F.col("sid"))
    with_label = keyed.join(labels.withColumnsRenamed({"node": "sid", "label": "found"}), "sid", "left").withColumn("label", F.coalesce("found", "sid")).drop("found")
    with_label = with_label.withColumn("size", F.floor(F.log(F.col("n")) / math.log(SIZE_STEP)))
    own = with_label.groupBy("key", "size").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    near = own.withColumn("size", F.explode(F.array(*(F.col("size") + k for k in (-1, 0, 1)))))
    several = near.groupBy("key", "size").agg(F.min("least").alias("least"), F.max("most").alias("most")).where("least <> most").select("key", "size")
    return materialise(with_label.join(several, ["key", "size"], "left_semi").drop("size"), "open-keys")


def _joined(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges. Known labels are edges to the smallest node of their component."""
    known = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b") if labels is not None else None
    return components(edges if known is None else known.unionByName(edges))


def set_components(keyed: DataFrame, sets: DataFrame) -> DataFrame:
    """(node, label) of every set that is linked with another."""
    labels, rows = None, _labelled(keyed, None)
    for round_ in range(STAR_ROUNDS):
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("sid", F.lit(round_)), F.col("parts")))
        centre = F.min(F.struct(F.xxhash64("sid", F.lit(-1 - round_)).alias("place"), "sid", "n", "label")).over(Window.partitionBy("key", "part"))
        apart = dealt.withColumn("c", centre).where((F.col("label") != F.col("c.label")) & _sizes_fit(F.col("n"), F.col("c.n")))
        votes = apart.groupBy(F.col("sid").alias("a"), F.col("c.sid").alias("b")).agg(F.count("*").alias("votes"))
        pairs = top_voted(votes)
        labels = materialise(_joined(labels, verified(pairs, sets)), "labels")
        rows = _labelled(keyed, labels)
    return materialise(_joined(labels, verified(_close_pairs(rows, sets), sets)), "labels")


def top_voted(votes: DataFrame) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("a").orderBy(F.col("votes").desc(), "b"))
    return votes.withColumn("nth", nth).where(F.col("nth") <= CENTRES).select("a", "b")


def _close_pairs(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """The distinct pairs of sets of different labels that share a key, fit in size and by bit sketches.

    Of such a pair one at least isn't of the key's most frequent label: those rows, dealt to parts of HOT_KEY
    rows, meet all rows of the key; what a label already holds together is never paired.
    """
    rows = rows.select("key", "sid", "n", "label")
    by_label = rows.groupBy("key", "label").agg(F.count("*").alias("count"))
    keys = by_label.groupBy("key").agg(F.max(F.struct("count", "label")).alias("top"), F.sum("count").alias("all"))
    alone = F.col("all") - F.col("top.count")
    parts = F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(alone / HOT_KEY)))).cast("int")
    rows = rows.join(keys.select("key", F.col("top.label").alias("top"), parts.alias("parts"), (alone == 1).alias("single")), "key")
    # Only now, and by sid, where the kept sets are, rows get what they are compared by.
    back = F.array(*(F.lag("key", k).over(Window.partitionBy("sid").orderBy("key")) for k in range(1, LOOK_BACK + 1)))
    rows = rows.join(sets.select("sid", *SKETCH), "sid").withColumn("back", back)
    carried = ("sid", "n", "label", "back", *SKETCH)
    every = rows.where("label = top OR NOT single").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("key", "part", *(F.col(c).alias(f"a_{c}") for c in carried))
    some = rows.where("label <> top").withColumn("part", F.pmod(F.xxhash64("sid"), F.col("parts"))).select(F.col("key").alias("b_key"), F.col("part").alias("b_part"), *(F.col(c).alias(f"b_{c}") for c in carried))
    close = (F.col("a_label") != F.col("b_label")) & _sizes_fit(F.col("a_n"), F.col("b_n")) & (7 * _apart() <= F.col("a_n") + F.col("b_n"))
    close = close & ~F.coalesce(F.arrays_overlap("a_back", "b_back"), F.lit(False))
    met = every.join(some, (F.col("key") == F.col("b_key")) & (F.col("part") == F.col("b_part")) & close)
    return met.select(F.least("a_sid", "b_sid").alias("a"), F.greatest("a_sid", "b_sid").alias("b")).distinct()


def compared(labels: DataFrame, sets: DataFrame, copies: DataFrame, run: Callable[[Block, Block], pa.RecordBatch], schema: str) -> DataFrame:
    """run() on all pairs of blocks of each component. Components are dealt to blocks by a hash, of BLOCK_SETS sets or BLOCK_BYTES about;
    a set goes to the tasks of its block's pairs, which hold two blocks at a time and give no pairs away but what run() makes of them.
    """
    linked = labels.select(F.col("node").alias("sid"), "label").join(sets.select("sid", "n", "shingles"), "sid").join(copies, "sid")
    sizes = linked.groupBy("label").agg(F.greatest(F.count("*") / BLOCK_SETS, F.sum("n") * 8 / BLOCK_BYTES).alias("blocks"))
    sizes = sizes.select("label", F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2("blocks")))).cast("int").alias("blocks"))
    placed = linked.join(sizes, "label").withColumn("own", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    sent = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = sent.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "sid", "copies", "shingles")
    dealt = keyed.repartition(int(labels.sparkSession.conf.get("spark.sql.shuffle.partitions")), "label", "i", "j").sortWithinPartitions("label", "i", "j", "own", "sid")

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in groupby(_rows(batches), key=lambda r: r[:3]):
            x: Block = ([], [], [])
            y: Block = ([], [], [])
            for *_, own, sid, n, shingles in rows:
                for side, value in zip(x if own == i else y, (sid, n, np.frombuffer(shingles, U)), strict=True):
                    side.append(value)
            if len(x[0]) + len(y[0]) > 1:
                yield run(x, x if i == j else y)

    return dealt.mapInArrow(over, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in slices(batches, "shingles"):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def links_of(x: Block, y: Block) -> np.ndarray:
    """Which sets of x are linked with which of y; shingles that one set alone has are left out of the products."""
    same = x is y
    sets = x[2] if same else x[2] + y[2]
    sizes = np.array([len(s) for s in sets], np.int64)
    _, which, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of, shared = np.repeat(np.arange(len(sets)), sizes), np.cumsum(count > 1) - 1
    keep = count[which] > 1
    of, which = of[keep], shared[which[keep]]
    at = np.argsort(which, kind="stable")
    of, which = of[at], which[at]
    both = np.zeros((len(x[0]), len(y[0])), np.int64)
    total = int(which[-1]) + 1 if len(which) else 0
    for first in range(0, total, COLUMNS):
        a, b = np.searchsorted(which, (first, first + COLUMNS))
        has = np.zeros((len(sets), min(COLUMNS, total - first)), np.float32)
        has[of[a:b], which[a:b] - first] = 1
        both += (has @ has.T if same else has[: len(x[0])] @ has[len(x[0]) :].T).astype(np.int64)
    n, m = sizes[: len(x[0])], sizes if same else sizes[len(x[0]) :]
    out = 7 * both >= 3 * (n[:, None] + m[None, :])
    if same:
        np.fill_diagonal(out, False)
    return out


def _counts(x: Block, y: Block) -> pa.RecordBatch:
    linked = links_of(x, y)
    sids, n = x[0], linked @ np.array(y[1], np.int64)
    if x is not y:
        sids, n = x[0] + y[0], np.concatenate((n, np.array(x[1], np.int64) @ linked))
    return pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), pa.array(n, pa.int64())], ["sid", "links"])


def _pairs(x: Block, y: Block) -> pa.RecordBatch:
    p, q = np.nonzero(links_of(x, y))
    a, b = np.array(x[0], np.int64)[p], np.array(y[0], np.int64)[q]
    keep = a < b if x is y else slice(None)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep])], ["a", "b"])


def _found(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets, the candidates among these (to be unpersisted), and the components."""
    ready(docs.sparkSession)
    kept = id_and_text(docs, id_col, text_col)
    rows, clashing, counts = document_sets(docs, id_col, text_col)
    keyed = key_rows(kept, counts, clashing)
    sets = candidate_sets(kept, keyed, clashing)
    return rows, sets, set_components(keyed, sets)


def set_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(id, n, sid) of every row, where sid stands for its set of n shingles; and (a, b), a < b, of all linked pairs of distinct sets."""
    rows, sets, labels = _found(docs, id_col, text_col)
    pairs = materialise(compared(labels, sets, labels.select(F.col("node").alias("sid"), F.lit(1).alias("copies")), _pairs, "a long, b long"), "links")
    sets.unpersist()
    return rows, pairs


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (the smallest id reachable by links), set_class (the component, null without shingles),
    n_links (other rows that the row is linked with; copies of a set count each). Links are counted in blocks, never listed."""
    rows, sets, labels = _found(docs, id_col, text_col)
    copies = rows.where("n > 0").groupBy("sid").agg(F.count("*").alias("copies"))
    others = compared(labels, sets, copies, _counts, "sid long, links long").groupBy("sid").agg(F.sum("links").alias("others"))
    counted = materialise(copies.join(others, "sid", "left").select("sid", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("links")).where("links > 0"), "counts")
    sets.unpersist()
    out = _by_component(rows, labels, id_col).join(counted, "sid", "left")
    return out.select(id_col, "n_shingles", "component_id", "set_class", F.coalesce("links", F.lit(0)).alias("n_links"))


def _by_component(rows: DataFrame, labels: DataFrame, id_col: str) -> DataFrame:
    """Per row: id, sid, n_shingles, component_id, set_class."""
    rows = rows.join(labels.withColumnsRenamed({"node": "sid", "label": "found"}), "sid", "left")
    rows = rows.select("id", "sid", "n", F.when(F.col("n") > 0, F.coalesce("found", "sid")).alias("class"))
    least = rows.where("class IS NOT NULL").groupBy("class").agg(F.min("id").alias("least"))
    out = rows.join(least, "class", "left")
    return out.select(F.col("id").alias(id_col), "sid", F.col("n").alias("n_shingles"), F.when(F.col("class").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"), F.col("class").alias("set_class"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """near_duplicates() without n_links."""
    rows, sets, labels = _found(docs, id_col, text_col)
    sets.unpersist()
    return _by_component(rows, labels, id_col).drop("sid")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each component, that with the smallest id. Rows equal in id and text are one document."""
    found = near_components(docs, id_col, text_col)
    keep_col, nth = unused(docs, "__keep"), unused(docs, "__nth")
    keep = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(keep_col)).distinct()
    kept = docs.join(keep, F.col(f"`{id_col}`").eqNullSafe(F.col(keep_col)), "left_semi")
    same = Window.partitionBy(f"`{id_col}`", F.xxhash64(F.col(f"`{text_col}`"))).orderBy(f"`{id_col}`")
    return kept.withColumn(nth, F.row_number().over(same)).where(F.col(nth) == 1).drop(nth)
