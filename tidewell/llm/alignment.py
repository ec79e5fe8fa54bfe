"""Alignment of two tokenizers over the same bytes, by a monoid of fragments.

A is a byte-level tokenizer of the tokenizers library, B one of sentencepiece; both see a blank and the
text. Byte offsets where tokens of both end cut the tokens into groups, and the two tokens that end there
are linked. A byte range yields a fragment: an open head (tokens up to its first shared end, to which
tokens of the range before may belong), closed groups, and an open tail. Composing fragments is
associative: the tail of one and the head of the next become a group. So ranges of one text are read in
any tasks and reduced as a tree.

Text is cut where neither tokenizer can reach across (before runs of blanks and line feeds; next to other
white space only at single blanks), distinct cuts are encoded once and remembered. Texts of at most RANGE
bytes are fragments of one task. Longer ones become byte ranges of their own tasks, whose bounds may fall
inside words: a range is read with the rest of the words at its bounds, and owns the tokens that end in it.
A bound inside a run longer than REACH without a place to cut moves to that run's end.

How often an id pair is linked is counted over all documents: blocks of texts (BLOCK bytes, or one range)
count their own pairs first and then ask for the totals of their distinct pairs, so a frequent pair is one
row a block, and no table that grows with the corpus is broadcast (the best count of each B id is: one row
an id of the vocabulary).

Defined results: null and empty texts have no tokens, as have texts whose joined bytes of A or B differ
from the blank and the text; their figures are 0 and groups_sha256 is ''. Repeated rows are answered each,
null ids are kept, extra columns are ignored, an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache, reduce
from itertools import accumulate, chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidewell.llm.batches import decoded, id_and_text, slices, texts
from tidewell.llm.token_counts import byte_letters
from tidewell.llm.units import RARE_SPACE
from tidewell.session import materialise, ready

MARK = "▁"
RANGE, REACH, BLOCK, FAN = 1 << 16, 1 << 12, 1 << 20, 16
CUT = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
STRICT = re.compile(r"(?<=[^\s᠎])(?= [^\s᠎])")
PLAIN = re.compile(r"[ \n][^\s᠎]+\Z")  # a blank or line feed and a word, after which others of this kind can follow
SAFE = re.compile(rb"(?<=[!-~]) (?=[!-~])")


class Fragment(NamedTuple):
    """Ids are decimal and comma-joined. closed is None where no end is shared: then head holds all tokens."""

    head_a: str = ""
    head_b: str = ""
    closed: str | None = None
    tail_a: str = ""
    tail_b: str = ""


def _joined(x: str, y: str, by: str = ",") -> str:
    return x + by + y if x and y else x or y


def compose(x: Fragment, y: Fragment) -> Fragment:
    """Associative, with Fragment() as its neutral element."""
    if x.closed is None:
        return y._replace(head_a=_joined(x.head_a, y.head_a), head_b=_joined(x.head_b, y.head_b))
    a, b = _joined(x.tail_a, y.head_a), _joined(x.tail_b, y.head_b)
    if y.closed is None:
        return x._replace(tail_a=a, tail_b=b)
    return Fragment(x.head_a, x.head_b, _joined(_joined(x.closed, f"{a}|{b}", ";"), y.closed, ";"), y.tail_a, y.tail_b)


def composed(fragments: Iterable[Fragment]) -> Fragment:
    return reduce(compose, fragments, Fragment())


def of_groups(groups: str) -> Fragment:
    """The fragment of tokens that begin after a shared end and end with one."""
    if not groups:
        return Fragment()
    first, _, rest = groups.partition(";")
    return Fragment(*first.split("|"), rest)


def groups_of(fragment: Fragment) -> str:
    """The groups of a whole text, whose end both tokenizers share."""
    return "" if fragment.closed is None else _joined(f"{fragment.head_a}|{fragment.head_b}", fragment.closed, ";")


def fragment_of(a: list[int], a_ends: list[int], b: list[int], b_ends: list[int]) -> tuple[Fragment, list[tuple[int, int]]]:
    """The fragment of tokens in order, and the linked pairs."""
    at = {e: k for k, e in enumerate(b_ends)}
    shared = [(k, at[e]) for k, e in enumerate(a_ends) if e in at]
    if not shared:
        return Fragment(",".join(map(str, a)), ",".join(map(str, b))), []
    parts, i, j = [], 0, 0
    for k, m in [*shared, (len(a) - 1, len(b) - 1)]:
        parts.append((",".join(map(str, a[i : k + 1])), ",".join(map(str, b[j : m + 1]))))
        i, j = k + 1, m + 1
    return Fragment(*parts[0], ";".join(map("|".join, parts[1:-1])), *parts[-1]), [(a[k], b[m]) for k, m in shared]


class Tokens(NamedTuple):
    a: list[int]
    a_ends: list[int]
    b: list[int]
    b_ends: list[int]
    exact: bool  # the joined bytes of both are the cut's


class Known:
    """Cuts by number: their groups, linked pairs (A id << 32 | B id) and numbers of tokens. Cuts that aren't exact have none."""

    def __init__(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.pairs = np.empty(0, np.int64)
        self.first, self.n_a, self.n_b, self.exact = np.zeros(1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, cuts: list[str], groups: list[str], pairs: np.ndarray, n_links: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, exact: np.ndarray) -> None:
        self.number.update(zip(cuts, range(len(self.groups), len(self.groups) + len(cuts)), strict=True))
        self.groups += groups
        self.pairs = np.concatenate((self.pairs, pairs))
        self.first = np.concatenate((self.first, self.first[-1] + np.cumsum(n_links)))
        self.n_a, self.n_b, self.exact = np.concatenate((self.n_a, n_a)), np.concatenate((self.n_b, n_b)), np.concatenate((self.exact, exact))

    def pairs_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of cuts one after another, and how many each has."""
        n = np.diff(self.first)[numbers] if len(numbers) else np.empty(0, np.int64)
        at = np.repeat(self.first[numbers] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return self.pairs[at], n

    def taken(self, other: Known, cuts: list[str]) -> None:
        at = np.array([other.number[c] for c in cuts], np.int64)
        pairs, n = other.pairs_of(at)
        self.add(cuts, [other.groups[k] for k in at.tolist()], pairs, n, other.n_a[at], other.n_b[at], other.exact[at])


class Aligner:
    """Tokens and groups of cuts. At MOST cuts the known ones are set aside, in place of those set aside before."""

    MOST, TOGETHER = 120_000, 500

    def __init__(self, path_a: str, path_b: str):
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        vocab = {i: bytes(letters[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items() if all(c in letters for c in t)}
        self.bytes_a = [vocab.get(k, b"") for k in range(max(vocab) + 1)]
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace(MARK, " ").encode() for k, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        # Ids as text with what follows them: in a group's A part, at its end, in its B part, at its end.
        self.shown = [f"{k}{c}" for n, cs in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for c in cs for k in range(n)]
        self.mark = self.b.piece_to_id(MARK)
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
        self.cut_lines = not crossing and not any("\n" in p for p in pieces)
        self.cut_blanks = not crossing
        self.known, self.aside = Known(), Known()

    def cuts(self, text: str) -> list[str]:
        """Parts of a text that begins with a blank. Each is encoded alone as it is in the text."""
        if self.cut_lines and not RARE_SPACE.search(text):
            return CUT.findall(text)
        return STRICT.split(text) if self.cut_blanks else [text]

    def tokens(self, cut: str) -> Tokens:
        """Tokens of one cut. B puts a blank before what it's given: cuts that begin with one go without it, others lose that first token again."""
        whole, a = cut.encode(), self.a.encode(cut, add_special_tokens=False).ids
        b = [self.mark] if cut == " " else self.b.encode(cut[1:] if cut[0] == " " else cut)
        if cut[0] != " ":
            b = b[1:] if b[:1] == [self.mark] else []
        raw_a, raw_b = [self.bytes_a[k] for k in a], [self.bytes_b[k] for k in b]
        exact = b"".join(raw_a) == whole and b"".join(raw_b) == whole
        return Tokens(a, list(accumulate(map(len, raw_a))), b, list(accumulate(map(len, raw_b))), exact)

    def learn(self, met: set[str]) -> None:
        """All cuts that are met become known."""
        new = met.difference(self.known.number)
        if new and len(self.known.number) + len(new) > self.MOST:
            self.aside, self.known, new = self.known, Known(), met
        again = new & self.aside.number.keys()
        if again:
            self.known.taken(self.aside, list(again))
        words, others = [], []
        for cut in new - again:
            (words if self.cut_blanks and PLAIN.match(cut) and (cut[0] == " " or self.cut_lines) else others).append(cut)
        groups = [words[k : k + self.TOGETHER] for k in range(0, len(words), self.TOGETHER)]
        joined = ["".join(g) for g in groups]
        every_a = self.a.encode_batch_fast(joined, add_special_tokens=False)
        every_b = self.b.encode([t[1:] if t[0] == " " else t for t in joined], num_threads=1)
        found = []
        for own, text, a, b in zip(groups, joined, every_a, every_b, strict=True):
            if text[0] != " ":
                b = b[1:] if b[:1] == [self.mark] else []
            learnt = self._together(own, text.encode(), a.ids, b)
            if learnt is None:
                others += own
            else:
                found.append(learnt)
        alone = [(c, t, *(fragment_of(*t[:4]) if t.exact else (Fragment(), []))) for c, t in zip(others, map(self.tokens, others), strict=True)]
        numbers = (np.array(x, np.int64) for x in ([a << 32 | b for _, _, _, links in alone for a, b in links], [len(x[3]) for x in alone], *([len(t[k]) if t.exact else 0 for _, t, _, _ in alone] for k in (0, 2))))
        found.append((others, [groups_of(x[2]) for x in alone], *numbers, np.array([x[1].exact for x in alone], bool)))
        columns = list(zip(*found, strict=True))
        self.known.add(*(list(chain.from_iterable(x)) for x in columns[:2]), *(np.concatenate(x) for x in columns[2:]))

    def _together(self, own: list[str], text: bytes, a: list[int], b: list[int]) -> tuple | None:
        """What Known takes of cuts, from the tokens of all of them in one text; null if its bytes aren't theirs."""
        if b"".join([self.bytes_a[k] for k in a]) != text or b"".join([self.bytes_b[k] for k in b]) != text:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_ends, b_ends, bounds = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b]), np.cumsum([len(c.encode()) for c in own])
        at_a, at_b = np.flatnonzero(np.isin(a_ends, b_ends, assume_unique=True)), np.flatnonzero(np.isin(b_ends, a_ends, assume_unique=True))
        shared = a_ends[at_a]
        last = np.searchsorted(shared, bounds)
        if last[-1] >= len(shared) or (shared[last] != bounds).any():
            return None  # a cut doesn't end where tokens do
        # A group's A ids, then its B ids: token k of A comes after the B tokens of all groups before its own.
        of_a, of_b = np.searchsorted(shared, a_ends), np.searchsorted(shared, b_ends)
        before_b, before_a = np.concatenate(([0], at_b + 1)), at_a + 1
        place_a, place_b = np.arange(len(a)) + before_b[of_a], np.arange(len(b)) + before_a[of_b]
        ends_a, ends_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        ends_a[at_a], ends_b[at_b] = True, True
        order = np.empty(len(a) + len(b), np.int64)
        order[place_a] = a + ends_a * len(self.bytes_a)
        order[place_b] = b + ends_b * len(self.bytes_b) + 2 * len(self.bytes_a)
        shown = self.shown
        parts = [shown[k] for k in order.tolist()]
        n_a, n_b, n = at_a[last] + 1, at_b[last] + 1, last + 1  # up to each cut's end
        cuts = [0, *(n_a + n_b).tolist()]
        step = lambda x: np.diff(x, prepend=0)
        return own, ["".join(parts[i:j])[:-1] for i, j in zip(cuts, cuts[1:], strict=False)], a[at_a] << 32 | b[at_b], step(n), step(n_a), step(n_b), np.ones(len(own), bool)


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


# A block: whole texts, how often each has which of the block's distinct pairs, and how often the block has them.
BLOCK_ROW = (
    "block string, ids array<long>, n_a array<long>, n_b array<long>, n_links array<long>, sha array<string>, ends array<int>, pairs array<int>, uses array<int>,"
    " distinct_pairs array<long>, times array<long>"
)


def _sha(groups: str) -> str:
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def _block(al: Aligner, name: str, ids: pa.Array, raw: list[bytes | None]) -> pa.RecordBatch:
    own = [al.cuts(" " + t) if t else [] for t in map(decoded, raw)]
    al.learn(set().union(*own))
    known, numbers, sha = al.known, [], []
    get, groups = known.number.__getitem__, known.groups
    for k, cuts in enumerate(own):
        found = list(map(get, cuts))
        if not all(known.exact[found]):
            found = []
        numbers += found
        sha.append(_sha(";".join([groups[n] for n in found])))
        own[k] = len(found)
    words, ends = np.array(numbers, np.int64), np.concatenate(([0], np.cumsum(own, dtype=np.int64)))
    flat, n_links = known.pairs_of(words)
    distinct, of = np.unique(flat, return_inverse=True)
    sums = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[ends])
    links = sums(n_links)
    met, uses = np.unique(np.repeat(np.arange(len(own)), links) * len(distinct) + of, return_counts=True)
    text_of, pair = np.divmod(met, max(1, len(distinct)))
    one = lambda x, t: pa.array([x], pa.list_(t))
    columns = [pa.array([name]), one(ids.to_pylist(), pa.int64()), *(one(x, pa.int64()) for x in (sums(known.n_a[words]), sums(known.n_b[words]), links)), one(sha, pa.string())]
    columns += [one(x.astype(np.int32), pa.int32()) for x in (np.searchsorted(text_of, np.arange(len(own)), "right"), pair, uses)]
    columns += [one(distinct, pa.int64()), one(np.bincount(of, minlength=len(distinct)), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [f.split(" ")[0] for f in BLOCK_ROW.split(", ")])


def short_blocks(rows: DataFrame, path_a: str, path_b: str, most: int) -> DataFrame:
    """Blocks of the whole texts of (id, text, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al, ids, raw, size, made, part = aligner(path_a, path_b), [], [], 0, 0, None
        for batch in slices(batches, most=most):
            part = part or batch.column("part")[0].as_py()
            ids.append(batch.column("id"))
            raw += texts(batch)
            size += batch.column("text").nbytes
            if size >= most:
                yield _block(al, f"{part}-{made}", pa.concat_arrays(ids), raw)
                ids, raw, size, made = [], [], 0, made + 1
        if raw:
            yield _block(al, f"{part}-{made}", pa.concat_arrays(ids), raw)

    return rows.mapInArrow(run, BLOCK_ROW)


def ranges(raw: bytes, size: int = RANGE, reach: int = REACH) -> list[tuple[int, int, int, int]]:
    """(left, from, to, right) of byte ranges: tokens that end after `from`, up to `to`, are told by the bytes from left to right."""
    bounds, at, n = [(0, 0, 0)], size, len(raw)
    while at < n:
        before = [m.start() for m in SAFE.finditer(raw, max(bounds[-1][2], at - reach), min(n, at + 1))]
        after = SAFE.search(raw, at)
        right = after.start() if after else n
        left = before[-1] if before else None
        if left is None or right - left > reach:
            left = at = right  # no place to cut nearby: the range ends where one is
        if at < n:
            bounds.append((left, at, right))
        at = (at // size + 1) * size
    bounds.append((n, n, n))
    return [(x[0], x[1], y[1], y[2]) for x, y in zip(bounds, bounds[1:], strict=False)]


RANGE_ROW = "doc string, id long, at long, lo long, hi long, text binary"


def range_rows(long: DataFrame, size: int) -> DataFrame:
    """Byte ranges of the long texts of (id, text, part), dealt out by text and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        for batch in slices(batches, most=1):
            raw, part = b" " + decoded(texts(batch)[0]).encode(), batch.column("part")[0].as_py()
            doc, id_, n = f"{part}-{n}", batch.column("id")[0].as_py(), n + 1
            for k, (left, lo, hi, right) in enumerate(ranges(raw, size)):
                row = [[doc], [id_], [k], [lo - left], [hi - left], [raw[left:right]]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc", "id", "at", "lo", "hi", "text"])

    return long.mapInArrow(run, RANGE_ROW).repartition("doc", "at")


FRAGMENT = ("head_a", "head_b", "closed", "tail_a", "tail_b")
FACTS = "doc string, id long, at long, exact boolean, n_a long, n_b long, n_links long, head_a string, head_b string, closed string, tail_a string, tail_b string"
FACT_NAMES = [f.split(" ")[0] for f in FACTS.split(", ")]


def _facts(rows: list[tuple]) -> list[pa.Array]:
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}
    return [pa.array(x, kinds[f.split(" ")[1]]) for x, f in zip(zip(*rows, strict=True), FACTS.split(", "), strict=True)]


def in_range(al: Aligner, text: str, lo: int, hi: int) -> tuple[Fragment, np.ndarray, int, int, bool]:
    """The fragment of the tokens that end after byte lo, up to byte hi, with their linked pairs and numbers."""
    cuts = al.cuts(text)
    al.learn(set(cuts))
    known, parts, pairs, inner, n_a, n_b, exact, end = al.known, [], [], [], 0, 0, True, 0

    def closed() -> None:
        if inner:
            parts.append(of_groups(";".join([known.groups[k] for k in inner])))
            pairs.append(known.pairs_of(np.array(inner))[0])
            inner.clear()

    for c in cuts:
        start, end = end, end + len(c.encode())
        k = known.number[c]
        exact &= bool(known.exact[k])
        if not known.exact[k] or end <= lo or start >= hi:
            continue
        if start >= lo and end <= hi:
            inner.append(k)
            n_a, n_b = n_a + int(known.n_a[k]), n_b + int(known.n_b[k])
            continue
        closed()
        t = al.tokens(c)
        own_a = [(k, e) for k, e in zip(t.a, t.a_ends, strict=True) if lo < start + e <= hi]
        own_b = [(k, e) for k, e in zip(t.b, t.b_ends, strict=True) if lo < start + e <= hi]
        fragment, links = fragment_of([k for k, _ in own_a], [e for _, e in own_a], [k for k, _ in own_b], [e for _, e in own_b])
        parts.append(fragment)
        pairs.append(np.array([a << 32 | b for a, b in links], np.int64))
        n_a, n_b = n_a + len(own_a), n_b + len(own_b)
    closed()
    return composed(parts), np.concatenate([np.empty(0, np.int64), *pairs]), n_a, n_b, exact


def range_fragments(found: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per range its facts, and its linked pairs with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        al = aligner(path_a, path_b)
        for batch in slices(batches, most=1 << 20):
            rows, distinct, times = [], [], []
            for r in batch.to_pylist():
                fragment, pairs, n_a, n_b, exact = in_range(al, decoded(r["text"]), r["lo"], r["hi"])
                rows.append((r["doc"], r["id"], r["at"], exact, n_a, n_b, len(pairs), *fragment))
                d, t = np.unique(pairs, return_counts=True)
                distinct.append(d)
                times.append(t.astype(np.int64))
            yield pa.RecordBatch.from_arrays([*_facts(rows), pa.array(distinct, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))], [*FACT_NAMES, "distinct_pairs", "times"])

    return found.mapInArrow(run, f"{FACTS}, distinct_pairs array<long>, times array<long>")


def reduced(fragments: DataFrame, longest: int, fan: int = FAN) -> DataFrame:
    """Fragments of each text composed as a tree of `fan` neighbours a node; `longest` is the largest place."""

    def node(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["at"])
        whole = composed(Fragment(*(r[c] for c in FRAGMENT)) for r in rows)
        sums = [sum(r[c] for r in rows) for c in ("n_a", "n_b", "n_links")]
        return pa.Table.from_arrays(_facts([(rows[0]["doc"], rows[0]["id"], rows[0]["at"] // fan, all(r["exact"] for r in rows), *sums, *whole)]), FACT_NAMES)

    out = fragments.select(*FACT_NAMES)
    while longest > 0:
        out = out.groupBy("doc", (F.col("at") / fan).cast("long").alias("__node")).applyInArrow(lambda _, t: node(t), FACTS)
        longest //= fan
    return out


def whole_facts(roots: DataFrame) -> DataFrame:
    """(doc, id, exact, n_a, n_b, n_links, sha) of long texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sha = [_sha(groups_of(Fragment(*(r[c] for c in FRAGMENT)))) if r["exact"] else "" for r in batch.select(["exact", *FRAGMENT]).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc", "id", "exact", "n_a", "n_b", "n_links")), pa.array(sha, pa.string())], ["doc", "id", "exact", "n_a", "n_b", "n_links", "sha"])

    return roots.mapInArrow(run, "doc string, id long, exact boolean, n_a long, n_b long, n_links long, sha string")


def pair_totals(counted: DataFrame) -> DataFrame:
    """(pair, total, best) of rows with distinct_pairs and times: how often a pair is linked, and whether no pair of its B id is more often."""
    each = counted.select(F.explode(F.arrays_zip("distinct_pairs", "times")).alias("p")).select(F.col("p.distinct_pairs").alias("pair"), F.col("p.times").alias("n"))
    totals = each.groupBy("pair").agg(F.sum("n").alias("total"))
    b_id = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = totals.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("most"))  # a row an id of B's vocabulary
    return totals.withColumn("b_id", b_id).join(F.broadcast(most), "b_id").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def _told(blocks: DataFrame, totals: DataFrame) -> DataFrame:
    """(block, told): totals of the block's distinct pairs; a block has a bounded number of them."""
    asked = blocks.select("block", F.explode("distinct_pairs").alias("pair"))
    return asked.join(totals, "pair").groupBy("block").agg(F.collect_list(F.struct("pair", "total", "best")).alias("told"))


RESULT = "id long, n_a long, n_b long, n_links long, n_best long, count_sum long, sha string"


def _summed(blocks: DataFrame) -> DataFrame:
    """Per text of a block its sums over links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = lambda c: batch.column(c)[k].values.to_numpy(zero_copy_only=False)  # noqa: B023,E731
                distinct, pairs, uses, ends = one("distinct_pairs"), one("pairs"), one("uses"), one("ends")
                total, best = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int64)
                told = batch.column("told")[k].values
                if told is not None and len(told):
                    place = np.searchsorted(distinct, told.field("pair").to_numpy())
                    total[place], best[place] = told.field("total").to_numpy(), told.field("best").to_numpy(zero_copy_only=False)
                sums = [pa.array(np.diff(np.concatenate(([0], np.cumsum(x[pairs] * uses)))[np.concatenate(([0], ends))])) for x in (best, total)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c)[k].values for c in ("ids", "n_a", "n_b", "n_links")), *sums, batch.column("sha")[k].values], [f.split(" ")[0] for f in RESULT.split(", ")])

    return blocks.mapInArrow(run, RESULT)


def aligned(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", longest: int = RANGE, block: int = BLOCK) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their B id), count_sum, groups_sha256."""
    spark = ready(docs.sparkSession)
    rows = id_and_text(docs, id_col, text_col, part=F.spark_partition_id().cast("string"))
    is_long = F.coalesce(F.octet_length("text"), F.lit(0)) > longest
    blocks = materialise(short_blocks(rows.where(~is_long), path_a, path_b, block), "aligned-blocks")
    found = materialise(range_rows(rows.where(is_long), longest), "aligned-ranges")
    last = found.agg(F.max("at")).first()[0]
    counted, long_facts = blocks.select("distinct_pairs", "times"), None
    if last is not None:
        fragments = materialise(range_fragments(found, path_a, path_b), "aligned-fragments")
        facts = materialise(whole_facts(reduced(fragments, max(last, 1))), "aligned-texts")
        sound = fragments.join(facts.where("exact").select("doc"), "doc", "left_semi")
        counted, long_facts = counted.unionByName(sound.select("distinct_pairs", "times")), facts
    totals = materialise(pair_totals(counted), "aligned-totals")
    out = _summed(blocks.join(_told(blocks, totals), "block", "left"))
    if long_facts is not None:
        links = sound.select("doc", F.explode(F.arrays_zip("distinct_pairs", "times")).alias("p")).select("doc", F.col("p.distinct_pairs").alias("pair"), F.col("p.times").alias("n"))
        sums = links.join(totals, "pair").groupBy("doc").agg(F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("total")).alias("count_sum"))
        zero = lambda c: F.when(F.col("exact"), F.coalesce(F.col(c), F.lit(0))).otherwise(0).cast("long").alias(c)
        out = out.unionByName(long_facts.join(sums, "doc", "left").select("id", *map(zero, ("n_a", "n_b", "n_links", "n_best", "count_sum")), "sha"))
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links", "n_best", "count_sum", F.col("sha").alias("groups_sha256"))
