"""Byte-pair ids of many distinct words at once, with numpy: each round joins one pair of every word that still has one.

A word is what stands between two blanks. Its pieces (letters, digits, signs, a line feed before them) are
no words of their own here: no pair is joined across their bounds, which gives the same ids. A word holds at
most LONGEST bytes of ASCII or Latin-1's letters and no apostrophe; `fit` tells which words are such.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa

LONGEST = 48
BLOCK = 1 << 14  # words whose state is held at a time
NONE = np.int32(2**31 - 1)
FIRST_BYTE, LEAD = 1, 0xC3  # what begins a word without a blank before it; the first byte of Latin-1's letters
#: Kinds of bytes: 0 never fits, 1 letters, 2 digits, 3 signs, 4 line feed, 5 FIRST_BYTE.
KIND = np.zeros(256, np.uint8)
KIND[33:127] = 3
KIND[48:58] = 2
KIND[65:91] = KIND[97:123] = KIND[128:192] = KIND[LEAD] = 1
KIND[ord("'")] = 0
KIND[10], KIND[FIRST_BYTE] = 4, 5


class Merges:
    """Ranks of pairs in a table of open addressing, and what they are joined to."""

    def __init__(self, tokenizer_json: str, letters: dict[int, str]):
        model = json.loads(tokenizer_json)["model"]
        vocab = model["vocab"]
        pairs = [tuple(x.split(" ")) if isinstance(x, str) else tuple(x) for x in model["merges"]]
        self.plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        self.plain &= all(x in vocab for x in letters.values()) and len(pairs) < NONE >> 6
        self.none = max(vocab.values()) + 1  # stands in no pair
        if not self.plain:
            return
        self.of_byte = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.joined = np.array([vocab[a + b] for a, b in pairs], np.int32)
        keys = np.array([vocab[a] * (self.none + 1) + vocab[b] for a, b in pairs], np.int64)
        keys, ranks = np.unique(keys[::-1], return_index=True)
        ranks = len(pairs) - 1 - ranks  # of a pair named twice the last counts, as it does for the library
        self.bits = max(8, int(4 * len(keys)).bit_length())
        self.keys, self.ranks = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int32)
        at = self._at(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[at] < 0)
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            self.keys[at[put]], self.ranks[at[put]] = keys[put], ranks[put]
            left = np.ones(len(keys), bool)
            left[put] = False
            keys, ranks, at = keys[left], ranks[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of pairs; NONE where they aren't joined."""
        keys = a.astype(np.int64) * (self.none + 1) + b
        at = self._at(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((found != keys) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[at[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[at[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


def fit(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which words data[offsets[k]:offsets[k + 1]] may go to `encode`."""
    bad = KIND[data] == 0
    if len(data) > 1:  # the signs among Latin-1's letters
        bad[1:] |= (data[:-1] == LEAD) & ((data[1:] == 0x97) | (data[1:] == 0xB7))
    before = np.concatenate(([0], np.cumsum(bad)))
    sizes = np.diff(offsets)
    return (before[offsets[1:]] == before[offsets[:-1]]) & (sizes <= LONGEST) & (sizes > 0)


def _block(m: Merges, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, number of ids of each)."""
    n, most = len(starts), int(sizes.max())
    place = np.arange(most)[:, None]
    inside = place < sizes
    raw = np.where(inside, data[np.minimum(starts + place, len(data) - 1)], 0)
    kind = KIND[raw]
    head = raw[0] == FIRST_BYTE
    # Row 0 and the last are never joined; row 1 is the blank, or empty where the word has none before it.
    ids = np.full((most + 3, n), m.none, np.int32)
    ids[2:-1] = np.where(inside, m.of_byte[raw], m.none)
    ids[1] = np.where(head, m.none, m.of_byte[32])
    ids[2, head] = m.none
    wall = np.ones((most + 3, n), bool)  # between a place and the one before
    wall[2] = head | (kind[0] == KIND[10])
    wall[3:-1] = kind[1:] != kind[:-1]
    ids, wall, width = ids.ravel(), wall.ravel(), n
    rows = np.arange((most + 3) * n, dtype=np.int32) // n
    after, before = rows + 1, rows - 1
    best = np.full((most + 3) * n, NONE, np.int32)
    at = np.flatnonzero(~wall & (ids != m.none))
    at = at[ids[at - width] != m.none]
    ranks = m.rank(ids[at - width], ids[at])
    known = ranks != NONE
    best[at[known] - width] = ranks[known] << 6 | rows[at[known] - width]
    table, live = best.reshape(most + 3, n), np.arange(n)
    while True:
        low = table[:-1].min(0) if len(live) == n else np.take(table, live, 1).min(0)
        going = low != NONE
        live, low = live[going], low[going]
        if not len(live):
            break
        one = (low & 63).astype(np.int64) * width + live
        two_row = after[one].astype(np.int64)
        two = two_row * width + live
        next_ = after[two].astype(np.int64) * width + live
        last = before[one].astype(np.int64) * width + live
        new = m.joined[low >> 6]
        ids[one], ids[two] = new, m.none
        after[one], before[next_] = after[two], rows[one]
        best[two] = NONE
        r = m.rank(new, ids[next_])
        best[one] = np.where((r == NONE) | wall[next_], NONE, r << 6 | rows[one])
        r = m.rank(ids[last], new)
        best[last] = np.where((r == NONE) | wall[one], NONE, r << 6 | rows[last])
    out = ids.reshape(most + 3, n).T
    kept = out != m.none
    return out[kept], kept.sum(1)


def encode(m: Merges, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, dtype: np.dtype) -> tuple[pa.Array, np.ndarray]:
    """(ids of words as binary values, where each word's value stands in these). Words of like length are taken together."""
    order = np.argsort(sizes, kind="stable")
    parts = [_block(m, data, starts[k], sizes[k]) for k in (order[a : a + BLOCK] for a in range(0, len(order), BLOCK))]
    ids = np.concatenate([np.empty(0, dtype), *(x.astype(dtype) for x, _ in parts)])
    ends = np.concatenate([np.zeros(1, np.int64), *(x for _, x in parts)]).cumsum() * dtype.itemsize
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return pa.Array.from_buffers(pa.large_binary(), len(order), [None, pa.py_buffer(ends), pa.py_buffer(ids)]), place
