"""Parity sketches of shingle sets, and the keys that their pigeonhole join needs.

In size band j (sizes from 4**j below 4**(j+1), and smaller ones that a partner there can have) a sketch
has 4**(j+1) words; each shingle is XORed into one of them. A shingle that only one set has changes one
word, so the number of differing words is at most the symmetric difference. Of two sets with Jaccard of
at least 3/4, the one of size n differs in at most n // 3 words. So all but n // 3 of its non-empty words
stand in both, and of its first n // 3 + 1 in any order that both follow at least one stands among the
other's as well: those are the set's keys. The order is by how often a word's rarest shingle occurs in
the corpus, so that common passages come last; words that tie with the last key are keys too. Bands below
SMALL have a word for each shingle.

The argument needs more than n // 3 non-empty words. From band SMALL on, at least 48 shingles in
256 words leave as few only if hashes fail; below, words are shingles.
"""

from __future__ import annotations

import numpy as np

from tidewell.llm.textwords import U, mix

WIDTH = 5
SMALL = 3
COUNT_BITS = 22
SKETCH_WORDS = 8  # 64-bit words of the bit sketch that candidates are compared by


def set_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each set, as signed numbers."""
    sizes = np.array([len(s) for s in sets], np.int64)
    every = np.concatenate([*sets, np.zeros(1, U)])  # one more, so that empty sets at the end have a place
    first = np.cumsum(sizes) - sizes
    out = []
    for salt, join in ((U(0), np.add), (U(0x5851F42D4C957F2D), np.bitwise_xor)):
        whole = join.reduceat(mix(every ^ salt), np.append(first, len(every) - 1))[:-1]
        out.append(mix(np.where(sizes > 0, whole, U(0)) + sizes.astype(U)).view(np.int64))
    return out[0], out[1]


def keys(sets: list[np.ndarray], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, the place in `sets` that each belongs to), of non-empty sets in their bands; counts: of shingles by their highest COUNT_BITS bits."""
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.array([(int(n).bit_length() - 1) // 2 for n in sizes], np.int64)
    found = []
    for k in range(0, len(sets), 1 << 15):
        some = np.arange(k, min(k + (1 << 15), len(sets)))
        next_too = some[4 * sizes[some] >= 3 << 2 * (own[some] + 1)]
        for at, band in ((some, own[some]), (next_too, own[next_too] + 1)):
            for part in (band < SMALL, band >= SMALL):
                if part.any():
                    found.append(_band_keys([sets[i] for i in at[part]], sizes[at[part]], band[part], at[part], counts))
    token, at = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, U), np.empty(0, np.int64))
    return token.view(np.int64), at


def _band_keys(sets: list[np.ndarray], sizes: np.ndarray, band: np.ndarray, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sets whose bands are all below SMALL, or none is."""
    shingles, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    weight, salt = counts[shingles >> U(64 - COUNT_BITS)].astype(U), mix(band.astype(U))
    if band[0] < SMALL:
        token = mix(shingles ^ salt[of])
    else:
        word = shingles & ((U(4) << (U(2) * band.astype(U))) - U(1))[of]
        order = np.argsort(of.astype(U) << U(44) | word)
        code = (of.astype(U) << U(44) | word)[order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
        whole, weight, of, word = np.bitwise_xor.reduceat(shingles[order], first), np.minimum.reduceat(weight[order], first), of[order][first], word[order][first]
        token = mix(whole ^ mix(word ^ salt[of]))
    place = of.astype(U) << U(48) | weight << U(32) | token >> U(32)
    order = np.argsort(place)
    place, of, token = place[order], of[order], token[order]
    start = np.searchsorted(of, np.arange(len(sets) + 1))
    last = np.minimum(start[:-1] + sizes // 3, start[1:] - 1)
    keep = place <= place[last][of]
    return token[keep], at[of[keep]]


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """SKETCH_WORDS x 64 bits, each shingle flips one: their Hamming distance is at most the symmetric difference."""
    bits = 64 * SKETCH_WORDS
    odd = np.bincount((mix(shingles ^ U(0x2545F4914F6CDD1D)) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def wide_sketch(shingles: np.ndarray) -> bytes:
    """A bit sketch of two to four bits for each shingle, 256 at least; a power of two, so that halves fold into each other."""
    bits = 2 << max(7, len(shingles).bit_length())
    odd = np.bincount((mix(shingles ^ U(0x2545F4914F6CDD1D)) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def distance(a: bytes, b: bytes) -> int:
    """The Hamming distance of two wide sketches, the longer one folded."""
    x, y = sorted((np.frombuffer(a, U), np.frombuffer(b, U)), key=len)
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 x intersection is at least 75 x union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 4 * both >= 3 * (len(a) + len(b) - both)
