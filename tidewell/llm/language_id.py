"""Language identification by prediction by partial matching.

For every language a byte context tree of variable order, up to ORDER, is counted over labelled texts and
frozen. A byte costs its exact code length: in the longest context the share count / (total + distinct),
and where the context has not met the byte the escape distinct / (total + distinct) and then the next
shorter context, down to equal shares of 256. A context that the tree lacks costs nothing. The text has
the language that codes it in the fewest bits.

Trees are sparse: the nodes met most often, at most NODES for each language and ALL_NODES in all. A context's
suffixes are met at least as often, so each node kept has its suffixes in the tree too. As the statistics
are frozen, a byte's cost depends on its context alone; workers remember costs in a table of CACHE_BYTES.
Costs are whole multiples of 1 / UNIT bit, so sums don't depend on how texts lie in batches.

Defined results: `und` with score 0 for null, empty and letterless texts; texts of any length are read
whole; repeated rows are answered each; with no labelled row at all everything is `und`; equal code
lengths go to the language first in the alphabet; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.batches import decoded, id_and_text, rows_where, slices, texts
from tidewell.session import materialise, ready

ORDER = 4
TRAIN_ROWS = 5_000  # labelled rows fitted on for each language, in expectation; all if it has fewer
NODES, ALL_NODES = 1 << 17, 1 << 20
UNIT = 1 << 16
CACHE_BYTES = 16 << 20
BLOCK_BYTES = 8 << 20
UNDETERMINED = "und"
LETTER = regex.compile(r"\p{L}")

#: A node is (order, its context and the byte after it) as one number: the order stands above the bytes.
_ABOVE = 8 * (ORDER + 1)
_BYTES = [(1 << 8 * (order + 1)) - 1 for order in range(ORDER + 1)]


def _runs(raw: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each byte with the ORDER bytes before it as one number, texts after ORDER blanks; and where each text begins and ends."""
    gap = b" " * ORDER
    sizes = np.array([len(x or b"") for x in raw], np.int64)
    ends = np.cumsum(sizes + ORDER) - ORDER
    joined = np.frombuffer(gap + gap.join(x or b"" for x in raw), np.uint8)
    n = len(joined) - ORDER
    codes = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        codes <<= 8
        codes |= joined[k : k + n]
    return codes, ends - sizes, ends


def counted_nodes(raw: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of all orders in these texts, and how often each is met."""
    codes, starts, ends = _runs(raw)
    inside = np.zeros(len(codes) + 1, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    found, n = np.unique(codes[np.cumsum(inside[:-1]) > 0], return_counts=True)
    nodes, counts = [], []
    for order in range(ORDER, -1, -1):
        found, at = np.unique(found & _BYTES[order], return_inverse=True)
        n = np.bincount(at, weights=n, minlength=len(found)).astype(np.int64)
        nodes.append(found | order << _ABOVE)
        counts.append(n)
    return np.concatenate(nodes), np.concatenate(counts)


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted table, and whether the wanted stand there."""
    at = np.minimum(np.searchsorted(table, wanted), max(0, len(table) - 1))
    return at, table[at] == wanted if len(table) else np.zeros(len(wanted), bool)


def _cost(share: np.ndarray) -> np.ndarray:
    return np.rint(-np.log2(share) * UNIT).astype(np.int32)


class Tree:
    """The frozen statistics of one language."""

    def __init__(self, nodes: np.ndarray, counts: np.ndarray):
        by_node = np.argsort(nodes)
        self.nodes, counts = nodes[by_node], counts[by_node]
        context = (self.nodes & _BYTES[ORDER]) >> 8 | self.nodes >> _ABOVE << _ABOVE
        self.contexts, of, distinct = np.unique(context, return_inverse=True, return_counts=True)
        both = np.bincount(of, weights=counts, minlength=len(self.contexts)) + distinct
        self.met, self.escape = _cost(counts / both[of]), _cost(distinct / both)

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """The cost of each last byte after the bytes before it, in units."""
        out, left = np.zeros(len(codes), np.int32), np.arange(len(codes))
        for order in range(ORDER, -1, -1):
            own = codes[left] & _BYTES[order]
            at, here = _find(self.nodes, own | order << _ABOVE)
            out[left[here]] += self.met[at[here]]
            left, own = left[~here], own[~here]
            at, known = _find(self.contexts, own >> 8 | order << _ABOVE)
            out[left[known]] += self.escape[at[known]]
        out[left] += 8 * UNIT
        return out


class Model:
    def __init__(self, languages: list[str], trees: list[Tree]):
        self.languages, self.trees = languages, trees
        self._slots = 1 << max(8, (CACHE_BYTES // (8 + 4 * max(1, len(trees)))).bit_length() - 1)
        self._codes = self._rows = None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_codes": None, "_rows": None}

    def _costs(self, codes: np.ndarray) -> np.ndarray:
        """The costs of codes (rows) in each language (columns)."""
        if self._codes is None:
            self._codes, self._rows = np.full(self._slots, -1, np.int64), np.zeros((self._slots, len(self.trees)), np.int32)
        slot = (codes * np.int64(0x9E3779B97F4A7C15 - (1 << 64))).view(np.uint64) >> np.uint64(65 - self._slots.bit_length())
        slot = slot.astype(np.int64)
        out = self._rows[slot]
        lost = np.flatnonzero(self._codes[slot] != codes)
        if len(lost):
            new, first, back = np.unique(codes[lost], return_index=True, return_inverse=True)
            rows = np.stack([t.costs(new) for t in self.trees], -1)
            out[lost] = rows[back]
            places, one = np.unique(slot[lost[first]], return_index=True)
            self._codes[places], self._rows[places] = new[one], rows[one]
        return out

    def lengths(self, raw: list[bytes | None]) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        codes, starts, ends = _runs(raw)
        out = np.zeros((len(raw), len(self.trees)), np.int64)
        block = max(1 << 10, BLOCK_BYTES // (8 * len(self.trees)))
        for at in range(0, len(codes), block):
            run = np.zeros((min(block, len(codes) - at) + 1, len(self.trees)), np.int64)
            np.cumsum(self._costs(codes[at : at + block]), axis=0, dtype=np.int64, out=run[1:])
            out += run[np.clip(ends - at, 0, len(run) - 1)] - run[np.clip(starts - at, 0, len(run) - 1)]
        return out / UNIT


def fit(docs: DataFrame, lang: Column, text_col: str = "text", id_col: str = "doc_id", train_rows: int = TRAIN_ROWS) -> Model:
    """Counts the trees over rows whose lang is not null: about train_rows of each language, chosen by a hash of id, each text whole."""
    spark = ready(docs.sparkSession)
    known = id_and_text(docs, id_col, text_col, lang=lang.cast("string")).where("lang IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}  # a row a language
    languages = sorted(sizes)
    if not languages:
        return Model([], [])
    cuts = [(name, k, int(min(1.0, train_rows / sizes[name]) * (1 << 20))) for k, name in enumerate(languages)]
    chosen = known.join(F.broadcast(spark.createDataFrame(cuts, "lang string, tree int, cut int")), "lang")  # a row a language
    chosen = chosen.where(F.pmod(F.xxhash64("id", F.lit(8)), F.lit(1 << 20)) < F.col("cut")).select("text", "tree")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            trees, raw = batch.column("tree").to_numpy(), texts(batch)
            for tree in np.unique(trees):
                nodes, n = counted_nodes([raw[k] for k in np.flatnonzero(trees == tree)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), tree, np.int32)), pa.array(nodes), pa.array(n)], ["tree", "node", "n"])

    counted = chosen.mapInArrow(run, "tree int, node long, n long").groupBy("tree", "node").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "language_nodes")
    most = min(NODES, max(1 << 10, ALL_NODES // len(languages)))
    # How often a node must be met, so that at most `most` are: frequencies in steps that grow with them, a few hundred a language.
    step = F.when(F.col("n") < 64, F.col("n")).otherwise(F.floor(F.log2("n") * 16).cast("long") - 32).alias("step")  # 64 is the step 64
    steps: dict[int, list[tuple[int, int]]] = {}
    for r in counted.groupBy("tree", step).count().collect():
        steps.setdefault(r["tree"], []).append((r["step"], r["count"]))
    least = []
    for tree, found in steps.items():
        kept, low = 0, 1 << 20
        for at, n in sorted(found, reverse=True):
            kept += n
            if kept > most:
                break
            low = at
        least.append((tree, low))
    kept = counted.join(F.broadcast(spark.createDataFrame(least, "tree int, low int")), "tree").where(step >= F.col("low")) if least else counted
    rows = kept.select("tree", "node", "n").toArrow()  # at most ALL_NODES rows, or 1,024 a language
    trees, nodes, n = (rows.column(k).to_numpy() for k in ("tree", "node", "n"))
    return Model(languages, [Tree(nodes[trees == k], n[trees == k]) for k in range(len(languages))])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", **more: Column) -> DataFrame:
    """Per row: id, lang_pred, score (the share of the best language's probability among all), and `more`."""
    spark = ready(docs.sparkSession)
    names = list(more)
    held = spark.sparkContext.broadcast(model)  # at most ALL_NODES nodes, or 1,024 a language
    kept = id_and_text(docs, id_col, text_col, lettered=F.coalesce(F.col(f"`{text_col}`").cast("string").rlike(r"\p{L}"), F.lit(False)), **more)
    schema = ", ".join([f"`{id_col}` long", "lang_pred string", "score double", *(f"`{k}` {kept.schema[k].dataType.simpleString()}" for k in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 19):
            found, scores = predicted(held.value, texts(batch), batch.column("lettered").to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, pa.string()), pa.array(scores, pa.float64()), *(batch.column(k) for k in names)], [id_col, "lang_pred", "score", *names])

    return kept.mapInArrow(run, schema)


def predicted(model: Model, raw: list[bytes | None], lettered: np.ndarray) -> tuple[list[str], list[float]]:
    found, scores = [UNDETERMINED] * len(raw), [0.0] * len(raw)
    if model.languages and len(raw):
        bits = model.lengths(raw)
        best = bits.argmin(1)
        shares = 1 / np.exp2(np.maximum(bits.min(1, keepdims=True) - bits, -1000)).sum(1)
        for k in np.flatnonzero(lettered).tolist():
            found[k], scores[k] = model.languages[best[k]], float(shares[k])
    return found, scores


def in_some_language(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """docs without the undetermined texts and those whose best language has a share below `least`."""
    held = ready(docs.sparkSession).sparkContext.broadcast(model)

    def keep(raw: list[bytes | None]) -> np.ndarray:
        lettered = np.array([LETTER.search(decoded(x)) is not None for x in raw], bool)
        return np.array(predicted(held.value, raw, lettered)[1]) >= least

    return rows_where(docs, keep, text_col)
