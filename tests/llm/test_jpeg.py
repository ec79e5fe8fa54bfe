"""Frames of another writer: coefficients written bit by bit, and decoded by the plain cosine sums."""

import random
import struct
from math import cos, pi, sqrt

import numpy as np
import pytest

from tidewell.llm import media
from tidewell.llm.jpeg import luma


def diagonal_places():
    """The walk over a block, step by step."""
    y = x = 0
    out = []
    for _ in range(64):
        out.append((y, x))
        if (y + x) % 2 == 0:
            y, x = (y, x + 1) if y == 0 and x < 7 else (y + 1, x) if x == 7 else (y - 1, x + 1)
        else:
            y, x = (y + 1, x) if x == 0 and y < 7 else (y, x + 1) if y == 7 else (y + 1, x - 1)
    return out


def segment(marker, body):
    return bytes([0xFF, marker]) + struct.pack(">H", len(body) + 2) + body


def bits_of(value):
    size = abs(value).bit_length()
    return size, format(value if value > 0 else value + (1 << size) - 1, f"0{size}b") if size else ""


def written(rows, columns, sampling, steps, every, rng):
    """A frame of random coefficients, and the pixels of its first component."""
    symbols = bytes(range(251))  # every code has 8 bits; all ones stays free
    tall, wide = max(v for _, v in sampling), max(h for h, _ in sampling)
    if len(sampling) == 1:
        tall = wide = 1
        sampling_in_scan = [(1, 1)]
    else:
        sampling_in_scan = sampling
    across, down = -(-columns // (8 * wide)), -(-rows // (8 * tall))
    h0, v0 = sampling_in_scan[0]
    grid, scans, bits, before = {}, [], "", [0] * len(sampling)

    def close():
        body = bits + "1" * (-len(bits) % 8)
        return bytes(int(body[k : k + 8], 2) for k in range(0, len(body), 8)).replace(b"\xff", b"\xff\x00")

    for unit in range(across * down):
        if every and unit and unit % every == 0:
            scans.append(close())
            bits, before = "", [0] * len(sampling)
        for c, (h, v) in enumerate(sampling_in_scan):
            for k in range(h * v):
                block = [rng.randint(-60, 60)] + [rng.choice([0] * 12 + [-3, 1, 7]) if rng.random() < 0.6 else 0 for _ in range(63)]
                if rng.random() < 0.3:
                    block[20:] = [0] * 43 + [2]  # runs longer than 15
                    block = block[:64]
                size, extra = bits_of(block[0] - before[c])
                bits += format(size, "08b") + extra
                before[c] = block[0]
                last, run = max([j for j in range(1, 64) if block[j]], default=0), 0
                for j in range(1, last + 1):
                    if not block[j]:
                        run += 1
                        continue
                    while run > 15:
                        bits += format(0xF0, "08b")
                        run -= 16
                    size, extra = bits_of(block[j])
                    bits += format(run << 4 | size, "08b") + extra
                    run = 0
                if last < 63:
                    bits += format(0, "08b")
                if c == 0:
                    grid[unit // across * v0 + k // h, unit % across * h0 + k % h] = block
    scans.append(close())
    code = bytes([0] * 7 + [len(symbols)] + [0] * 8) + symbols
    head = b"\xff\xd8" + segment(0xE0, b"other") + segment(0xDB, b"\0" + bytes(steps)) + segment(0xC4, b"\0" + code + b"\x10" + code)
    head += segment(0xC0, struct.pack(">BHHB", 8, rows, columns, len(sampling)) + b"".join(bytes([k + 1, h << 4 | v, 0]) for k, (h, v) in enumerate(sampling)))
    head += (segment(0xDD, struct.pack(">H", every)) if every else b"") + segment(0xDA, bytes([len(sampling)]) + b"".join(bytes([k + 1, 0]) for k in range(len(sampling))) + bytes([0, 63, 0]))
    data = scans[0] + b"".join(bytes([0xFF, 0xD0 + k % 8]) + s for k, s in enumerate(scans[1:]))
    places = diagonal_places()
    pixels = np.zeros((-(-rows * v0 // tall), -(-columns * h0 // wide)), int)
    scale = lambda u: 1 / sqrt(2) if u == 0 else 1
    for y in range(pixels.shape[0]):
        for x in range(pixels.shape[1]):
            block, total = grid[y // 8, x // 8], 128.0
            for k, (v, u) in enumerate(places):
                if block[k]:
                    total += scale(u) * scale(v) / 4 * block[k] * steps[k] * cos((2 * (x % 8) + 1) * u * pi / 16) * cos((2 * (y % 8) + 1) * v * pi / 16)
            pixels[y, x] = min(255, max(0, round(total)))
    return head + data + b"\xff\xd9", pixels


@pytest.mark.parametrize("rows,columns,sampling,every", [(8, 8, [(1, 1)], 0), (21, 35, [(2, 2)], 3), (20, 40, [(2, 2), (1, 1), (1, 1)], 0), (33, 17, [(2, 1), (1, 1), (1, 1)], 1)])
def test_frames_of_another_writer(rows, columns, sampling, every):
    rng = random.Random(rows)
    frame, pixels = written(rows, columns, sampling, [rng.randint(1, 9) for _ in range(64)], every, rng)
    assert np.abs(luma(frame).astype(int) - pixels).max() <= 1  # sums that end in a half
    with pytest.raises(ValueError):
        luma(frame[: len(frame) * 2 // 3])
    with pytest.raises(ValueError):
        luma(frame.replace(b"\xff\xc0", b"\xff\xc2", 1))


def test_own_frames_are_plain_baseline_frames():
    samples = np.random.default_rng(2).integers(0, 256, media.PER_FRAME).astype(np.uint8)
    assert (luma(media.encode_frames(samples)[0])[::8, ::8].ravel() == samples).all()


@pytest.mark.parametrize("index", ["list", "file", None])
def test_files_of_another_writer(spark, index):
    rng = random.Random(8)
    frames = [written(16, 24, [(1, 1)], [1] * 64, 0, rng) for _ in range(3)]
    chunk = media._chunk
    body, at = b"movi", []
    for frame, _ in frames:
        body += chunk(b"01wb", b"sound")
        at.append((len(body), len(frame)))
        body += chunk(b"00dc", frame)
    strh = b"vidsMJPG" + struct.pack("<IHHIIII", 0, 0, 0, 0, 2, 20, 0)
    hdrl = chunk(b"LIST", b"hdrl" + chunk(b"LIST", b"strl" + chunk(b"strh", strh)))
    base = 12 + len(hdrl) + 8 if index == "file" else 0
    idx = chunk(b"idx1", b"".join(struct.pack("<4sIII", b"00dc", 16, base + a, n) for a, n in at)) if index else b""
    file = chunk(b"RIFF", b"AVI " + hdrl + chunk(b"LIST", body) + idx)
    avi = media.read_avi(file)
    assert avi.payload is None and avi.rate == 10 and avi.frames.shape == (3, 16 * 24)
    assert np.abs(avi.frames.reshape(3, 16, 24).astype(int) - np.stack([p for _, p in frames])).max() <= 1
    row = media.media_features(spark.createDataFrame([(1, 0, bytearray(file))], "doc_id long, n_bytes long, media binary")).first()
    assert row.error is None and row.payload_sha256 is None and row.feature.startswith("frames=3;") and row.clip_starts[0] == 0


def brute_shots(frames, window, spread, least):
    hist = [[sum(v >> 4 == b for v in f) / len(f) for b in range(16)] for f in frames]
    d = [sum(abs(a - b) for a, b in zip(p, q, strict=True)) / 2 for p, q in zip(hist, hist[1:], strict=False)]
    cuts = [0]
    for k, x in enumerate(d):
        near = [d[j] for j in range(max(0, k - window), min(len(d), k + window + 1)) if j != k] or [0.0]
        mean = sum(near) / len(near)
        deviation = sqrt(max(0, sum(v * v for v in near) / len(near) - mean * mean))
        if x > max(least, mean + spread * deviation) + 1e-12:
            cuts.append(k + 1)
    return cuts


def test_shots_against_plain_code():
    rng = np.random.default_rng(4)
    for _ in range(20):
        levels = rng.integers(0, 256, 6)
        frames = np.concatenate([np.clip(rng.normal(level, 12, (int(rng.integers(1, 12)), 64)), 0, 255) for level in levels]).astype(np.uint8)
        assert media.shots(frames)[0] == brute_shots(frames.tolist(), media.WINDOW, media.SPREAD, media.LEAST)
