"""Words of many texts at once as 64-bit hashes, with numpy."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Word bytes of `[^\x20\x09-\x0D]+`, and of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing.
NOT_SPACE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LONG_WORD = 512
U = np.uint64
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], U)
_MIX = [U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit numbers."""
    x = x + _MIX[0]
    x = (x ^ (x >> U(30))) * _MIX[1]
    x = (x ^ (x >> U(27))) * _MIX[2]
    return x ^ (x >> U(31))


@dataclass
class Words:
    hashes: np.ndarray  # uint64, of every word in order
    first: np.ndarray  # text k has the words first[k] to first[k + 1]
    starts: np.ndarray  # where words begin and end, in bytes from the start of all texts together
    ends: np.ndarray
    base: np.ndarray  # where text k begins in the same bytes


def words(texts: list[bytes | None], kind: np.ndarray) -> Words:
    """All words of the texts; null has none. Words differ in hash unless 64 bits collide."""
    data = np.frombuffer(b" ".join([b"", *(x or b"" for x in texts), b" " * 8]).translate(LOWER), np.uint8)
    sizes = np.array([len(x or b"") for x in texts], np.int64)
    ends_of = np.cumsum(sizes + 1)  # a text ends before the blank at this offset
    base = ends_of - sizes
    edge = np.diff(kind[data].view(np.int8))
    starts, ends = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    sizes = ends - starts
    eights = np.ndarray(max(0, len(data) - 7), "<u8", data, strides=(1,))
    out = mix(sizes.astype(U))
    at, part = np.arange(len(starts)), 0
    while len(at):
        left = np.minimum(sizes[at] - part, 8)
        out[at] = mix(out[at] ^ (eights[starts[at] + part] & _MASKS[left]))
        part += 8
        at = at[sizes[at] > part]
        if part >= LONG_WORD:
            for k in at.tolist():
                out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
            break
    return Words(out, np.concatenate(([0], np.searchsorted(starts, ends_of))), starts, ends, base)


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of `width` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, U)
    total = np.full(n, U(width))
    for k in range(width):
        total += hashes[k : k + n] * (mix(np.array([k + 1], U))[0] | U(1))
    return mix(total)


def shingle_sets(found: Words, width: int) -> list[np.ndarray]:
    """Per text its sorted distinct shingles; of fewer words the whole sequence is one; of none, none."""
    every, out = windows(found.hashes, width), []
    for a, b in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if b - a >= width:
            own = np.sort(every[a : b - width + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        else:
            out.append(windows(found.hashes[a:b], b - a) if b > a else np.empty(0, U))
    return out
