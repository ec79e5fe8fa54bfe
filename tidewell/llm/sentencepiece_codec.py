"""SentencePiece encoding and decoding with the tokenizers library.

The model file's protobuf is parsed here: pieces with scores and types, trainer and normaliser settings.
From them a tokenizers backend is rebuilt: the normaliser (precompiled character map if the model has
one, dummy prefix, blanks as the metaspace marker), the model with byte fallback, and the decoder. For
unigram models the piece scores are the model. For byte-pair models they order the merges: a pair merges
to a piece, the higher score first.

Text is cut before each run of markers, where no piece can reach across (checked against the
vocabulary); distinct cuts are encoded in multithreaded batches and remembered. When a cut is learned its
ids are held against the sentencepiece library, and what they decode to against the cut.

Defined results: null text is empty and has no ids; repeated rows are answered each; whole texts,
whatever their length; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

from tidewell.llm.batches import decoded, id_and_text, slices, texts
from tidewell.llm.units import FIRST
from tidewell.session import ready

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6  # types of pieces
UNIGRAM, BPE = 1, 2
TOGETHER = 500  # cuts in one text of a batch


def proto_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of every field of a protobuf message; submessages and strings stay bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        width = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + width]
        at += width


@dataclass
class ModelFile:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    split_by_space: bool = True
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze: bool = True
    escape: bool = True


def parse(data: bytes) -> ModelFile:
    """The fields used here, with the format's own defaults."""
    out = ModelFile()
    for number, value in proto_fields(data):
        if number == 1:
            piece = dict(proto_fields(value))
            out.pieces.append((piece.get(1, b"").decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(proto_fields(value))
            out.kind, out.byte_fallback, out.split_by_space = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), bool(trainer.get(22, 1))
        elif number == 3:
            norm = dict(proto_fields(value))
            out.charsmap, out.dummy_prefix, out.squeeze, out.escape = norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1)), bool(norm.get(5, 1))
    return out


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Every split of a normal piece into two pieces: by falling score of the whole, then by the parts' ids."""
    ids = {p: k for k, (p, _, t) in enumerate(pieces) if t in (NORMAL, USER)}
    out = []
    for piece, score, kind in pieces:
        if kind == NORMAL:
            out += [(-score, ids[piece[:k]], ids[piece[k:]], piece[:k], piece[k:]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
    return [(a, b) for *_, a, b in sorted(out)]


def backend(model: ModelFile, prefixed: bool = False) -> Tokenizer:
    """prefixed: texts come with their dummy prefix."""
    unknown = next(k for k, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == BPE:
        vocab = {p: k for k, (p, _, _) in enumerate(model.pieces)}
        core = models.BPE(vocab, merges_of(model.pieces), unk_token=model.pieces[unknown][0], fuse_unk=True, byte_fallback=model.byte_fallback)
    else:
        core = models.Unigram([(p, s) for p, s, _ in model.pieces], unknown, model.byte_fallback)
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.squeeze:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    steps += [normalizers.Prepend(MARK if model.escape else " ")] if model.dummy_prefix and not prefixed else []
    steps += [normalizers.Replace(" ", MARK)] if model.escape else []
    out.normalizer = normalizers.Sequence(steps)
    out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else [])])
    return out


class Codec:
    """encode() and decode() of whole texts. Only the cutting is ours; the pieces are the library's.

    Memory is bounded: at MOST cuts the known ones are set aside, in place of those set aside before, and
    taken up again when they're met.
    """

    MOST, LONGEST = 250_000, 64

    def __init__(self, path: str):
        with open(path, "rb") as f:
            data = f.read()
        self.model = parse(data)
        self.theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
        crossing = any(re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in self.model.pieces)
        plain = not self.model.charsmap and not self.model.squeeze and self.model.escape
        self.cut = re.compile(r"[ ▁]+[^ ▁]*|[^ ▁]+") if plain and self.model.split_by_space and not crossing else None
        self.tokenizer = backend(self.model, self.cut is not None)
        self.by_word = backend(self.model, True) if self.cut is not None else None
        if self.by_word:
            self.by_word.pre_tokenizer = pre_tokenizers.Split(MARK, "merged_with_next")
        self.marked = np.array([p.startswith(MARK) for p, _, _ in self.model.pieces])
        self.of_run = {len(p): k for k, (p, _, t) in enumerate(self.model.pieces) if t == NORMAL and not p.strip(MARK)}
        # Ids of cuts by key: a cut of one blank and a word goes without the blank, others begin with FIRST.
        self.known: dict[str, bytes] = {}
        self.aside: dict[str, bytes] = {}
        self.differing: set[str] = set()  # keys where the other library gives other ids
        self.lossy: set[str] = set()  # keys whose ids don't decode to them
        self.raw = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else b" \xe2\x81\x87 " if t == UNKNOWN else p.replace(MARK, " ").encode() for p, _, t in self.model.pieces]

    def keys(self, text: str) -> list[str]:
        if not text:
            return []
        if self.cut is None:
            return [FIRST + text]
        if not self.model.dummy_prefix or text[0] == " " or "  " in text or MARK in text or FIRST in text:
            cuts = self.cut.findall(" " + text if self.model.dummy_prefix else text)
            return [c[1:] if c[0] == " " and c[1:2] not in (" ", MARK, FIRST) else FIRST + c for c in cuts]
        return text.split(" ")

    def _cut_of(self, key: str) -> str:
        return key[1:] if key[:1] == FIRST else " " + key

    def learn(self, keys: list[str]) -> None:
        """Encodes cuts in multithreaded batches, and compares each with the sentencepiece library and with what it decodes to."""
        raw = self.raw
        keys.sort(key=lambda k: not k or k[0] == FIRST)  # words first
        words = sum(1 for k in keys if k and k[0] != FIRST) if self.by_word else 0
        cuts = [self._cut_of(k) for k in keys]
        skip = 1 if self.model.dummy_prefix and self.cut else 0
        for key, cut, got, want in zip(keys, cuts, self.together(cuts[:words]) + self.through_runs(cuts[words:]), self.expected(cuts, skip), strict=True):
            ids = array("I", got).tobytes()
            self.known[key] = ids
            if want is not None and got != want:
                self.differing.add(key)
            if b"".join([raw[k] for k in got]) != cut.encode() if self.cut else self.decode(ids) != cut:
                self.lossy.add(key)

    def together(self, words: list[str]) -> list[list[int]]:
        """Ids of cuts of a blank and a word each, many of them in one text of the batch, which the backend parts at the markers."""
        out = []
        some = [words[k : k + TOGETHER] for k in range(0, len(words), TOGETHER)]
        for own, got in zip(some, self.by_word.encode_batch_fast(["".join(x) for x in some], add_special_tokens=False) if some else (), strict=True):
            ids = got.ids
            cuts = [*np.flatnonzero(self.marked[ids]).tolist(), len(ids)]  # a marker stands first in each, and nowhere else
            out += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] if len(cuts) == len(own) + 1 else self.through_runs(own)
        return out

    def through_runs(self, cuts: list[str]) -> list[list[int]]:
        """Ids from the backend. Pieces of markers alone share one lowest score in byte-pair models, so there
        place decides, not rank: what the word leaves of a run of markers is joined from the left, where place decides."""
        if self.cut is None or self.model.kind != BPE:
            return [x.ids for x in self.tokenizer.encode_batch_fast(cuts, add_special_tokens=False)]
        lead = [len(c) - len(c.lstrip(" ▁")) for c in cuts]
        out = []
        for k, got in zip(lead, self.tokenizer.encode_batch_fast([c[max(0, k - 1) :] for c, k in zip(cuts, lead, strict=True)], add_special_tokens=False), strict=True):
            ids = got.ids
            if k > 1:
                alone = ids[0] == self.of_run.get(1)
                ids = self.run_ids(k if alone else k - 1) + ids[alone:]
            out.append(ids)
        return out

    def run_ids(self, marks: int) -> list[int]:
        """The leftmost pair that makes a piece is joined first: only the last two of an irreducible row can be it."""
        out: list[int] = []
        for _ in range(marks):
            out.append(1)
            while len(out) > 1 and out[-2] + out[-1] in self.of_run:
                out[-2:] = [out[-2] + out[-1]]
        return [self.of_run[n] for n in out]

    def expected(self, cuts: list[str], skip: int) -> list[list[int] | None]:
        """The other library's ids. It adds the prefix blank by itself, so cuts that start with none can't be asked alone."""
        askable = [c[skip:] if not skip or c[0] == " " else None for c in cuts]
        found = iter(self.theirs.encode([c for c in askable if c], num_threads=1))
        return [next(found) if c else None for c in askable]

    def encode(self, many: list[str]) -> tuple[list[bytes], list[bool], list[bool]]:
        """For each text its ids as little-endian 32-bit numbers, whether all its cuts agree with the other library, and whether they decode to it."""
        keys = [self.keys(x) for x in many]
        met = set().union(*keys)
        new = met.difference(self.known)
        if new and len(self.known) + len(new) > self.MOST:
            self.aside, self.known, new = self.known, {}, met
            self.differing &= self.aside.keys()
            self.lossy &= self.aside.keys()
        again = new & self.aside.keys()
        self.known.update((k, self.aside[k]) for k in again)
        if new := list(new - again):
            self.learn(new)
        of_key = self.known.__getitem__
        out = [b"".join(map(of_key, x)) for x in keys]
        agree, restored = ([True] * len(keys) if not odd else [odd.isdisjoint(x) for x in keys] for odd in (self.differing, self.lossy))
        for k in [k for k in new if len(k) > self.LONGEST]:
            del self.known[k]
            self.differing.discard(k)
            self.lossy.discard(k)
        return out, agree, restored

    def decode(self, ids: bytes) -> str:
        """The text of ids; the blank of the dummy prefix goes."""
        raw = self.raw
        text = b"".join([raw[k] for k in array("I", ids)]).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids (array of int), same_ids (as the sentencepiece library)."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in slices(batches, most=1 << 20):
            ids, same, _ = c.encode([decoded(x) for x in texts(batch)])
            n = np.array([len(x) // 4 for x in ids], np.int64)
            flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
            listed = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n), listed, pa.array(same, pa.bool_())], [id_col, "n_tokens", "ids", "same_ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_tokens long, ids array<int>, same_ids boolean")


def encoding_report(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, ids_crc32, ids_sha256, same_ids (as the sentencepiece library), restored (decoding gives the text)."""
    ready(docs.sparkSession)
    names = [id_col, "n_bytes", "n_tokens", "ids_crc32", "ids_sha256", "same_ids", "restored"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model_path)
        for batch in slices(batches, most=1 << 20):
            raw = texts(batch)
            ids, same, restored = c.encode([decoded(x) for x in raw])
            columns = [
                pa.array([len(x or b"") for x in raw], pa.int64()),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array(same, pa.bool_()),
                pa.array(restored, pa.bool_()),
            ]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_bytes long, n_tokens long, ids_crc32 long, ids_sha256 string, same_ids boolean, restored boolean")
