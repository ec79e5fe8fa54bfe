"""Media columns: AVI files of motion JPEG.

Bytes become 8-bit grey samples, one flat 8 x 8 block each, in baseline JPEG frames of SIDE x SIDE
blocks: the DC step is 8, so a flat block of value v has the coefficient v - 128 and decodes to v
exactly. The Huffman table gives difference category k a code of 9 - k bits (the all-ones code stays
free, as JPEG asks), so that code and extra bits always make 9, and the end-of-block code is one
bit: every block takes ten bits, which numpy packs and unpacks at once. Frames of other writers go through
`jpeg.luma`, which reads any baseline JPEG frame that carries its own tables.

Shots: histograms of 16 bins of consecutive frames differ by d; a cut stands where d passes the mean of
the differences in a window around it by `spread` deviations and `least`. Clips are the runs between.

Defined results: null is empty; an empty payload is one frame; a media value that isn't such an AVI
gives null fields and its error; a file of another writer has features and clips and no payload; frames of
several sizes in one file are an error; repeated rows are answered each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidewell.llm.batches import id_and_text, slices, texts
from tidewell.llm.jpeg import luma
from tidewell.session import ready

SIDE, FPS, ALIGN = 32, 25, 64
PER_FRAME = SIDE * SIDE
BINS, WINDOW, SPREAD, LEAST = 16, 8, 3.0, 0.25


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _jpeg_head() -> bytes:
    steps = bytes([0]) + bytes([8] + [1] * 63)
    frame = struct.pack(">BHHBBBB", 8, SIDE * 8, SIDE * 8, 1, 1, 0x11, 0)
    # A code of each length from 1 to 9, for the categories 8 down to 0; one code of one bit for the end of block.
    dc = bytes([0x00]) + bytes([1] * 9 + [0] * 7) + bytes(range(8, -1, -1))
    ac = bytes([0x10]) + bytes([1] + [0] * 15) + bytes([0])
    scan = bytes([1, 1, 0x00, 0, 63, 0])
    return b"\xff\xd8" + _segment(0xDB, steps) + _segment(0xC0, frame) + _segment(0xC4, dc) + _segment(0xC4, ac) + _segment(0xDA, scan)


def _fields() -> tuple[np.ndarray, np.ndarray]:
    """ten[d + 255]: the ten bits of a block whose DC differs by d; of_nine: and back."""
    ten, of_nine = np.zeros(511, np.uint64), np.zeros(512, np.int64)
    for d in range(-255, 256):
        k = abs(d).bit_length()
        code = (1 << 9 - k) - 2  # 8 - k ones and a zero
        nine = code << k | (d if d > 0 else d + (1 << k) - 1)
        ten[d + 255], of_nine[nine] = nine << 1, d
    return ten, of_nine


HEAD, (TEN, OF_NINE) = _jpeg_head(), _fields()


def encode_frames(samples: np.ndarray) -> list[bytes]:
    """JPEG files of samples, whose number is a multiple of PER_FRAME."""
    dc = samples.reshape(-1, PER_FRAME).astype(np.int64) - 128
    bits = TEN[np.diff(dc, axis=1, prepend=0) + 255].reshape(len(dc), -1, 4)
    forty = bits[..., 0] << 30 | bits[..., 1] << 20 | bits[..., 2] << 10 | bits[..., 3]
    packed = (forty[..., None] >> np.array([32, 24, 16, 8, 0], np.uint64)).astype(np.uint8)
    return [HEAD + f.tobytes().replace(b"\xff", b"\xff\x00") + b"\xff\xd9" for f in packed.reshape(len(dc), -1)]


def decode_frames(frames: list[bytes]) -> np.ndarray:
    """The samples of frames, a row each."""
    bodies = []
    for f in frames:
        if not (f.startswith(HEAD) and f.endswith(b"\xff\xd9")):
            raise ValueError("not a frame of this profile")
        bodies.append(f[len(HEAD) : -2].replace(b"\xff\x00", b"\xff"))
    packed = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint64)
    if len(packed) != len(frames) * PER_FRAME * 10 // 8:
        raise ValueError("a frame is cut short")
    five = packed.reshape(-1, 5)
    forty = five[:, 0] << 32 | five[:, 1] << 24 | five[:, 2] << 16 | five[:, 3] << 8 | five[:, 4]
    nine = (forty[:, None] >> np.array([31, 21, 11, 1], np.uint64)) & np.uint64(511)
    return (np.cumsum(OF_NINE[nine].reshape(len(frames), PER_FRAME), axis=1) + 128).astype(np.uint8)


def _chunk(kind: bytes, body: bytes) -> bytes:
    return kind + struct.pack("<I", len(body)) + body + b"\0" * (len(body) & 1)


def write_avi(payload: bytes) -> bytes:
    """An AVI 1.0 file that holds the payload; its length stands in the codec data chunk `strd`."""
    count = max(1, -(-len(payload) // PER_FRAME))
    frames = encode_frames(np.frombuffer(payload.ljust(count * PER_FRAME, b"\0"), np.uint8))
    px = SIDE * 8
    avih = struct.pack("<14I", 1_000_000 // FPS, 0, 0, 0x10, count, 0, 1, max(map(len, frames)), px, px, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, count, max(map(len, frames)), 0xFFFFFFFF, 0, 0, 0, px, px)
    strf = struct.pack("<IiiHH4sIiiII", 40, px, px, 1, 8, b"MJPG", px * px, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf) + _chunk(b"strd", struct.pack("<Q", len(payload))))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    body, index, at = [], [], 4
    for f in frames:
        body.append(_chunk(b"00dc", f))
        index.append(struct.pack("<4sIII", b"00dc", 0x10, at, len(f)))
        at += len(body[-1])
    return _chunk(b"RIFF", b"AVI " + hdrl + _chunk(b"LIST", b"movi" + b"".join(body)) + _chunk(b"idx1", b"".join(index)))


def _chunks(data: memoryview, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    while at + 8 <= end:
        kind, size = bytes(data[at : at + 4]), struct.unpack_from("<I", data, at + 4)[0]
        if at + 8 + size > end:
            raise ValueError("a chunk is cut short")
        yield kind, at + 8, at + 8 + size
        at += 8 + size + (size & 1)


@dataclass
class Avi:
    payload: bytes | None  # None in files of other writers
    frames: np.ndarray  # samples (pixels in files of other writers), a row a frame
    rate: float


def read_avi(media: bytes) -> Avi:
    """Follows the index of a file to its frames and decodes them. ValueError if it isn't such a file."""
    data = memoryview(media)
    if len(data) < 12 or data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise ValueError("not an AVI file")
    size, rate, movi, index = None, float(FPS), None, []
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    if end > len(data):
        raise ValueError("a file is cut short")
    todo = [(12, end)]
    while todo:
        for kind, a, b in _chunks(data, *todo.pop()):
            if kind == b"LIST" and data[a : a + 4] == b"movi":
                movi = (a, b)
            elif kind == b"LIST":
                todo.append((a + 4, b))
            elif kind == b"strh" and data[a : a + 4] == b"vids":
                scale, ticks = struct.unpack_from("<II", data, a + 20)
                rate = ticks / max(1, scale) or float(FPS)
            elif kind == b"strd":
                size = struct.unpack_from("<Q", data, a)[0]
            elif kind == b"idx1":
                index = [struct.unpack_from("<4sIII", data, k) for k in range(a, b - 15, 16)]
    if movi is None:
        raise ValueError("no frames")
    found = [bytes(data[a:b]) for a, b in (_indexed(data, movi[0], index) if index else _walked(data, movi[0] + 4, movi[1]))]
    if not found:
        raise ValueError("no frames")
    if size is not None and all(f.startswith(HEAD) for f in found):
        frames = decode_frames(found)
        return Avi(frames.tobytes()[:size], frames, rate)
    pixels = [luma(f) for f in found]
    if len({x.shape for x in pixels}) > 1:
        raise ValueError("frames of several sizes")
    return Avi(None, np.stack([x.ravel() for x in pixels]), rate)


def _indexed(data: memoryview, movi: int, index: list[tuple[bytes, int, int, int]]) -> Iterator[tuple[int, int]]:
    """Where the frames of an index lie; writers count from the list `movi` or from the file's begin."""
    for kind, _, at, size in index:
        if kind[2:] not in (b"dc", b"db"):
            continue
        place = next((k for k in (movi + at, at) if data[k : k + 4] == kind and k + 8 + size <= len(data)), None)
        if place is None:
            raise ValueError("the index points to no frame")
        yield place + 8, place + 8 + size


def _walked(data: memoryview, at: int, end: int) -> Iterator[tuple[int, int]]:
    """Where the frames lie in a list without an index."""
    for kind, a, b in _chunks(data, at, end):
        if kind == b"LIST":
            yield from _walked(data, a + 4, b)
        elif kind[2:] in (b"dc", b"db"):
            yield a, b


def shots(frames: np.ndarray, window: int = WINDOW, spread: float = SPREAD, least: float = LEAST) -> tuple[list[int], np.ndarray]:
    """First frames of the shots, and the histogram differences (0 to 1) of neighbours."""
    n = len(frames)
    bins = (frames >> 4).astype(np.int64) + BINS * np.arange(n)[:, None]
    hist = np.bincount(bins.ravel(), minlength=n * BINS).reshape(n, BINS) / frames.shape[1]
    d = np.abs(np.diff(hist, axis=0)).sum(1) / 2
    if not len(d):
        return [0], d
    k = np.arange(len(d))
    a, b = np.maximum(0, k - window), np.minimum(len(d), k + window + 1)
    s1, s2 = np.concatenate(([0], np.cumsum(d))), np.concatenate(([0], np.cumsum(d * d)))
    m = np.maximum(1, b - a - 1)  # the neighbours without the frame itself
    mean = (s1[b] - s1[a] - d) / m
    deviation = np.sqrt(np.maximum(0, (s2[b] - s2[a] - d * d) / m - mean * mean))
    return [0, *(np.flatnonzero(d > np.maximum(least, mean + spread * deviation)) + 1).tolist()], d


def payload_of(text: bytes | None) -> bytes:
    """The text with zero bytes up to a positive multiple of ALIGN."""
    text = text or b""
    return text.ljust(max(1, -(-len(text) // ALIGN)) * ALIGN, b"\0")


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes (of the text), media (an AVI file with the padded text)."""
    ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=1 << 20):
            raw = texts(batch)
            media = [write_avi(payload_of(x)) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([len(x or b"") for x in raw], pa.int64()), pa.array(media, pa.binary())], [id_col, "n_bytes", "media"])

    return id_and_text(docs, id_col, text_col).mapInArrow(run, f"`{id_col}` long, n_bytes long, media binary")


def _over_media(media: DataFrame, run, schema: str, id_col: str) -> DataFrame:
    ready(media.sparkSession)
    return media.selectExpr(f"CAST(`{id_col}` AS LONG) AS id", "n_bytes", "media").mapInArrow(run, schema)


def media_features(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Reads media back. Per row: id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, clip_starts (seconds), error."""
    names = [id_col, "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "clip_starts", "error"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.float64()), pa.string()]

    def row(data: bytes | None) -> tuple:
        if data is None:
            return (None,) * 7 + ("no media",)
        try:
            avi = read_avi(data)
        except (ValueError, struct.error) as e:
            return (None, None, None, len(data), hashlib.sha256(data).hexdigest(), None, None, str(e))
        first, d = shots(avi.frames)
        feature = f"frames={len(avi.frames)};shots={len(first)};mean={avi.frames.mean():.4f};most={d.max() if len(d) else 0:.4f}"
        own = (None,) * 3 if avi.payload is None else (len(avi.payload), hashlib.sha256(avi.payload).hexdigest(), zlib.crc32(avi.payload[-ALIGN:]))
        return *own, len(data), hashlib.sha256(data).hexdigest(), feature, [k / avi.rate for k in first], None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 1 << 20):
            found = [row(x) for x in texts(batch, "media")]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_bytes"), *(pa.array([r[k] for r in found], kinds[k + 2]) for k in range(8))], names)

    return _over_media(media, run, f"`{id_col}` long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clip_starts array<double>, error string", id_col)


def clips(media: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """A row for each shot: id, clip (from 0), first_frame, frames, start_s, end_s, jump (the difference at its cut). Unreadable media have none."""
    names = [id_col, "clip", "first_frame", "frames", "start_s", "end_s", "jump"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "media", 1 << 20):
            rows = []
            for key, data in zip(batch.column("id").to_pylist(), texts(batch, "media"), strict=True):
                try:
                    avi = read_avi(data or b"")
                except (ValueError, struct.error):
                    continue
                first, d = shots(avi.frames)
                for k, (a, b) in enumerate(zip(first, [*first[1:], len(avi.frames)], strict=True)):
                    rows.append((key, k, a, b - a, a / avi.rate, b / avi.rate, float(d[a - 1]) if a else 0.0))
            columns = zip(*rows, strict=True) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 4 + [pa.float64()] * 3, strict=True)], names)

    return _over_media(media, run, f"`{id_col}` long, clip long, first_frame long, frames long, start_s double, end_s double, jump double", id_col)
