"""Token counts by prefix dynamic programming.

For byte-pair encodings the last token of a prefix's encoding is unique: it is the token t ending
there for which (last token before t, t) survives when both are encoded together. One pass over a
piece so gives the exact count at every prefix; truncation and budget questions are then look-ups.

Defined results: null text is empty and has 0 tokens; repeated rows are answered each; a text of any
length is processed whole; extra columns of the input are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidewell.llm.batches import decoded, id_and_text, slices, texts
from tidewell.llm.units import PIECES, RARE_SPACE, Memo, units
from tidewell.session import ready

CONTRACTIONS = frozenset(("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"))


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class PrefixCounter:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = [x["content"] for x in spec["added_tokens"]]
        vocab = spec["model"]["vocab"]
        self.ids = {raw(t): i for t, i in vocab.items() if t not in set(self.special)}
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merged[vocab[a], vocab[b]] = (rank, vocab[a + b])
        self.single = [self.ids.get(bytes([b]), -1) for b in range(256)]
        self.fits: dict[int, bool] = {}
        self.pattern = regex.compile(PIECES)
        self.parts = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.of_piece = Memo(self._piece_counts)
        self.of_unit = Memo(lambda u: sum(self.of_piece[p][-1] for p in self.pattern.findall(u)))

    def merge(self, piece: bytes) -> list[int]:
        """Plain byte-pair encoding: the lowest rank first, leftmost among equals."""
        ids = [self.single[b] for b in piece]
        while len(ids) > 1:
            found = [(self.merged[p][0], k) for k, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merged]
            if not found:
                break
            k = min(found)[1]
            ids[k : k + 2] = [self.merged[ids[k], ids[k + 1]][1]]
        return ids

    def follows(self, a: int, b: int) -> bool:
        key = a << 20 | b
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 500_000:
                self.fits.clear()
            known = self.fits[key] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
        return known

    def _piece_counts(self, piece: str) -> list[int]:
        """counts[i]: tokens of the first i bytes of the piece, for i from 0 to its length."""
        raw, get, follows = piece.encode("utf-8", "replace"), self.ids.get, self.follows
        n = len(raw)
        counts, last = [0] * (n + 1), [-1] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - self.longest), end):
                token = get(raw[start:end])
                if token is not None and (start == 0 or follows(last[start], token)):
                    last[end], counts[end] = token, counts[start] + 1
                    break
        return counts

    def segments(self, text: str) -> list[tuple[str, bool]]:
        """(part, is a special token); the library's default takes special strings in a text as their token."""
        if self.parts is None or not any(s in text for s in self.special):
            return [(text, False)]
        return [(x, x in self.special) for x in self.parts.split(text) if x]

    def count(self, text: str) -> int:
        of_unit = self.of_unit
        return sum(1 if special else sum([of_unit[u] for u in units(part)]) for part, special in self.segments(text))

    def _unit_table(self, unit: str, most: int | None = None) -> list[int]:
        """Counts at every byte of a unit as if the text ended there. Two kinds of piece depend on what follows:
        contractions (cut short they're a quote and letters) and white space (its last one goes to the next piece).
        Given `most`, the table ends with the last piece in which a count may be within it."""
        out, base, before, pieces = [], 0, 0, self.pattern.findall(unit)
        for k, piece in enumerate(pieces):
            if most is not None and before > most:
                break
            before = base
            counts = self.of_piece[piece]
            inner = counts[1:]
            if piece in CONTRACTIONS and len(piece) > 2:
                inner = [*(self.of_piece["'"][-1] + (self.of_piece[piece[1:i]][-1] if i > 1 else 0) for i in range(1, len(piece))), counts[-1]]
            at = len(out)
            out += [base + c for c in inner]
            if k and pieces[k - 1].isspace() and piece[0].isspace():
                run = pieces[k - 1] + piece[0]
                width = len(piece[0].encode())
                out[at + width - 1] = base - self.of_piece[pieces[k - 1]][-1] + self.of_piece[run][-1]
            base += counts[-1]
        return out

    def prefix_counts(self, text: str) -> np.ndarray:
        """Exact tokens of every prefix: entry i holds the first i bytes, at character ends."""
        parts, base, before = [np.zeros(1, np.int64)], 0, ""
        for part, special in self.segments(text):
            if special:  # cut short, its letters (all ASCII) are ordinary text after the unit before
                whole = base - (self.of_unit[before] if before else 0)
                inner = [whole + self.of_unit[before + part[:k]] for k in range(1, len(part))]
                parts.append(np.array([*inner, base + 1], np.int64))
                base, before = base + 1, ""
                continue
            for unit in units(part):
                parts.append(base + np.array(self._unit_table(unit), np.int64))
                base, before = base + self.of_unit[unit], unit
        return np.concatenate(parts)

    def fit(self, text: str, budget: int) -> int:
        """Bytes of the longest prefix, up to a character's end, whose exact count is within the budget.

        A prefix that ends in a unit has at least one token more than the units before, so only the unit that
        overflows can hold it, or a special token cut short right after that unit."""
        used = taken = 0
        before, over, best = "", False, 0
        for part, special in self.segments(text):
            for unit in [part] if special else units(part):
                if over and not special:
                    return best
                raw = unit.encode("utf-8", "replace")
                count = 1 if special else self.of_unit[unit]
                if over or used + count > budget:
                    if special:
                        whole = used - (self.of_unit[before] if before else 0)
                        table = [whole + self.of_unit[before + part[:k]] for k in range(1, len(part))]
                    else:
                        table = [used + x for x in self._unit_table(unit, budget - used)]
                    ends = (k for k in range(len(table), 0, -1) if table[k - 1] <= budget and (k == len(raw) or raw[k] & 0xC0 != 0x80))
                    inside = next(ends, 0)
                    best = taken + inside if inside or not over else best
                    if special:
                        return best
                    over = True
                else:
                    best = taken + len(raw)
                used, taken, before = used + count, taken + len(raw), "" if special else unit
        return best


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, fit_bytes (bytes of the longest prefix within the limit, up to a character's end; all if not over)."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(tokenizer)
        for batch in slices(batches):
            raw = texts(batch)
            sizes = [len(x or b"") for x in raw]
            whole = [decoded(x) for x in raw]
            counts = [c.count(x) for x in whole]
            fits = [n if k <= limit else c.fit(x, limit) for x, n, k in zip(whole, sizes, counts, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64()), pa.array([k > limit for k in counts], pa.bool_()), pa.array(fits, pa.int64())],
                [id_col, "n_bytes", "n_tokens", "over_limit", "fit_bytes"],
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long")
