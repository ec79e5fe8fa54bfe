"""Brightness of baseline JPEG frames: tables, Huffman codes, restart markers, dequantisation, inverse transform.

Reads 8-bit sequential frames of one to four components in one scan, which carry their own tables. Anything
else (progressive or arithmetic coding, missing tables, data cut short) is a ValueError.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np

_RESTART = re.compile(rb"\xff[\xd0-\xd7]")
#: Places of coefficients in the order of the diagonals, whose direction alternates.
_DIAGONALS = np.array(sorted(range(64), key=lambda i: (i // 8 + i % 8, i // 8 if (i // 8 + i % 8) % 2 else -(i // 8))))
_COSINES = np.cos(np.outer(np.arange(8), 2 * np.arange(8) + 1) * np.pi / 16) / 2
_COSINES[0] /= np.sqrt(2)


@lru_cache(maxsize=16)
def _lookup(lengths: bytes, symbols: bytes) -> np.ndarray:
    """For each 16 bits that may follow: the length of the code at their front << 8 | its symbol; 0 if there's none."""
    table, at, used = np.zeros(1 << 16, np.int32), 0, 0
    for length, count in enumerate(lengths, 1):
        for symbol in symbols[used : used + count]:
            width = 1 << 16 - length
            table[at : at + width] = length << 8 | symbol
            at += width
        used += count
    if at > 1 << 16 or used > len(symbols):
        raise ValueError("a Huffman table is broken")
    return table


class _Bits:
    def __init__(self, raw: bytes):
        self.raw, self.at, self.end = raw + b"\xff" * 8, 0, 8 * len(raw)

    def peek(self) -> int:
        k = self.at >> 3
        return int.from_bytes(self.raw[k : k + 3]) >> 8 - (self.at & 7) & 0xFFFF

    def symbol(self, table: np.ndarray) -> int:
        both = int(table[self.peek()])
        self.at += both >> 8
        if not both or self.at > self.end:
            raise ValueError("a frame is cut short")
        return both & 255

    def value(self, size: int) -> int:
        if not size:
            return 0
        bits = self.peek() >> 16 - size
        self.at += size
        if self.at > self.end:
            raise ValueError("a frame is cut short")
        return bits if bits >> size - 1 else bits - (1 << size) + 1


def _block(bits: _Bits, dc: np.ndarray, ac: np.ndarray, before: int) -> tuple[np.ndarray, int]:
    out = np.zeros(64, np.int64)
    out[0] = before + bits.value(bits.symbol(dc) & 15)
    k = 1
    while k < 64:
        both = bits.symbol(ac)
        run, size = both >> 4, both & 15
        if not size and run < 15:
            break
        k += run
        if k > 63:
            raise ValueError("a block is too long")
        out[k] = bits.value(size)
        k += 1
    return out, int(out[0])


def luma(frame: bytes) -> np.ndarray:
    """The first component as pixels (rows, columns) of 8 bits, at its own resolution."""
    if frame[:2] != b"\xff\xd8":
        raise ValueError("not a JPEG frame")
    steps, codes, every, parts, at = {}, {}, 0, [], 2
    while True:
        if at + 4 > len(frame) or frame[at] != 0xFF:
            raise ValueError("a frame is cut short")
        marker, size = frame[at + 1], struct.unpack_from(">H", frame, at + 2)[0]
        if marker == 0xFF:  # a fill byte
            at += 1
            continue
        body, at = frame[at + 4 : at + 2 + size], at + 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                steps[body[0] & 15] = np.frombuffer(body, ">u2" if wide else "u1", 64, 1).astype(np.int64)
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                count = sum(body[1:17])
                codes[body[0]] = _lookup(body[1:17], body[17 : 17 + count])
                body = body[17 + count :]
        elif marker in (0xC0, 0xC1):
            depth, rows, columns, n = struct.unpack_from(">BHHB", body)
            if depth != 8 or not rows or not columns or len(body) < 6 + 3 * n:
                raise ValueError("not 8-bit samples of a known size")
            parts = [(body[6 + 3 * k], body[7 + 3 * k] >> 4, body[7 + 3 * k] & 15, body[8 + 3 * k]) for k in range(n)]
        elif marker == 0xDD:
            every = struct.unpack(">H", body)[0]
        elif marker == 0xDA:
            break
        elif 0xC0 <= marker <= 0xCF:
            raise ValueError("not a baseline frame")
    tables = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
    try:
        scan = [(h, v, codes[tables[name] >> 4], codes[16 | tables[name] & 15]) for name, h, v, _ in parts]
        first_steps = steps[parts[0][3]]
    except (KeyError, IndexError):
        raise ValueError("a table or component is missing") from None
    most_h, most_v = max(h for h, *_ in scan), max(v for _, v, *_ in scan)
    h0, v0 = scan[0][:2]
    if not h0 or not v0:
        raise ValueError("a component without samples")
    if len(scan) == 1:
        scan, h0, v0, most_h, most_v = [(1, 1, *scan[0][2:])], 1, 1, 1, 1
    across, down = -(-columns // (8 * most_h)), -(-rows // (8 * most_v))
    end = frame.rfind(b"\xff\xd9")
    pieces = [_Bits(p.replace(b"\xff\x00", b"\xff")) for p in _RESTART.split(frame[at : end if end >= at else len(frame)])]
    blocks = np.zeros((down * v0, across * h0, 64), np.int64)
    bits, before = pieces[0], [0] * len(scan)
    for unit in range(across * down):
        if every and unit and unit % every == 0:
            if unit // every >= len(pieces):
                raise ValueError("a frame is cut short")
            bits, before = pieces[unit // every], [0] * len(scan)
        for c, (h, v, dc, ac) in enumerate(scan):
            for k in range(h * v):
                found, before[c] = _block(bits, dc, ac, before[c])
                if c == 0:
                    blocks[unit // across * v0 + k // h, unit % across * h0 + k % h] = found
    natural = np.zeros_like(blocks)
    natural[..., _DIAGONALS] = blocks * first_steps
    pixels = _COSINES.T @ natural.reshape(*blocks.shape[:2], 8, 8) @ _COSINES + 128
    whole = np.clip(np.rint(pixels), 0, 255).astype(np.uint8).transpose(0, 2, 1, 3).reshape(8 * blocks.shape[0], -1)
    return whole[: -(-rows * v0 // most_v), : -(-columns * h0 // most_h)]
