"""Media columns: motion-JPEG in AVI, read back into frames, shots and timed clip rows.

``encode_media`` stores bytes as 24 x 24 grey frames, each a lossless JPEG (SOF3, predictor 1;
the first row of a frame is predicted from 128 and from the left, the first sample of other
rows from above), coded with the usual DC luminance Huffman table.  ``decode_media`` parses the RIFF chunks, finds the frames through the
``idx1`` index, reads each frame's own header (size and Huffman table, whatever it is), decodes the frames and detects shots.

Codes differ in length, so a frame is decoded symbol after symbol; but all frames of an Arrow batch
that have equal headers are decoded together, a symbol of each at a time, by lookup of the next 16 bits.

A shot begins where the histogram difference of neighbouring frames exceeds the mean plus
``SHARPNESS`` standard deviations of its neighbourhood, and ``FLOOR`` at least.

Null and empty texts are stored as one frame of padding; repeated rows give repeated rows, equal texts equal values; an empty table gives
none.  Only the key and the text are read, so other columns' names don't matter.  Both operators are projections over
Arrow batches: no shuffle; long texts are coded in blocks of ``BLOCK`` frames.
"""

from __future__ import annotations

import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import pieces

SIDE = 24
UNIT = SIDE * SIDE
# The usual DC luminance Huffman table, how many codes have 1 to 16 bits; its values are 0 to 11 in order.
CODE_COUNTS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
FPS = 25
BLOCK = 4096
BINS = 16
WINDOW, SHARPNESS, FLOOR = 12, 3.0, 0.25
YIELD_BYTES = 8 << 20
CLIPS = "array<struct<clip:int,first_frame:int,n_frames:int,start_s:double,end_s:double,luma:double>>"


def _header() -> bytes:
    """All of a frame before its coded samples."""
    table = bytes([0, *CODE_COUNTS, *range(sum(CODE_COUNTS))])
    return b"".join(
        (
            b"\xff\xd8",
            b"\xff\xc4" + struct.pack(">H", 2 + len(table)) + table,
            b"\xff\xc3" + struct.pack(">HBHHB3B", 11, 8, SIDE, SIDE, 1, 1, 0x11, 0),
            b"\xff\xda" + struct.pack(">HB2B3B", 8, 1, 1, 0, 1, 0, 0),
        )
    )


HEADER = _header()


def huffman_codes(counts: tuple[int, ...]) -> list[tuple[int, int]]:
    """(code, bits) of each value in order, from the numbers of codes of 1 to 16 bits."""
    out, code = [], 0
    for bits, n in enumerate(counts, 1):
        for _ in range(n):
            out.append((code, bits))
            code += 1
        code <<= 1
    return out


def _difference_codes() -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each difference from -255 to 255: its category's code, then as many extra bits."""
    codes, out = huffman_codes(CODE_COUNTS), []
    for d in range(-255, 256):
        s = abs(d).bit_length()
        code, bits = codes[s]
        out.append(((code << s) | (d if d >= 0 else d + (1 << s) - 1), bits + s))
    return np.array([c for c, _ in out], np.int64), np.array([n for _, n in out], np.int64)


CODES, LENGTHS = _difference_codes()


def pad_payload(data: bytes) -> bytes:
    """``data`` and bytes 255 up to a positive multiple of a frame."""
    return data + b"\xff" * ((-len(data)) % UNIT if data else UNIT)


def _encode_block(samples: np.ndarray) -> list[bytes]:
    """The frames (n, 24, 24) as JPEG files."""
    x = samples.astype(np.int16)
    d = np.empty_like(x)
    d[:, :, 1:] = x[:, :, 1:] - x[:, :, :-1]
    d[:, 1:, 0] = x[:, 1:, 0] - x[:, :-1, 0]
    d[:, 0, 0] = x[:, 0, 0] - 128
    d = d.reshape(len(x), -1).astype(np.int64) + 255
    bits = LENGTHS[d]
    ends = np.cumsum(bits, axis=1)
    sizes = (ends[:, -1] + 7) // 8
    first = np.concatenate([[0], np.cumsum(sizes)])
    at = (ends - bits + first[:-1, None] * 8).ravel()
    word = CODES[d].ravel() << (24 - bits.ravel() - (at & 7))
    raw = np.zeros(first[-1] + 3)
    for k in range(3):
        raw += np.bincount((at >> 3) + k, weights=(word >> (16 - 8 * k)) & 255, minlength=len(raw))
    raw = raw.astype(np.uint8)
    spare = sizes * 8 - ends[:, -1]
    raw[first[1:] - 1] |= ((1 << spare) - 1).astype(np.uint8)
    coded = raw.tobytes()
    return [b"".join((HEADER, coded[i:j].replace(b"\xff", b"\xff\x00"), b"\xff\xd9")) for i, j in zip(first.tolist(), first[1:].tolist())]


def _chunk(name: bytes, body: bytes) -> bytes:
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def encode_avi(payload: bytes) -> bytes:
    """``payload``, a positive multiple of a frame, as an AVI file."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, SIDE, SIDE)
    frames = [f for i in range(0, len(samples), BLOCK) for f in _encode_block(samples[i : i + BLOCK])]
    largest = max(map(len, frames))
    avih = struct.pack("<14I", 1_000_000 // FPS, largest * FPS, 0, 0x10, len(frames), 0, 1, largest, SIDE, SIDE, 0, 0, 0, 0)
    strh = b"vidsMJPG" + struct.pack("<IHHIIIIIIII4H", 0, 0, 0, 0, 1, FPS, 0, len(frames), largest, 0, 0, 0, 0, SIDE, SIDE)
    strf = struct.pack("<IiiHH4sIiiII", 40, SIDE, SIDE, 1, 8, b"MJPG", UNIT, 0, 0, 0, 0)
    strl = _chunk(b"LIST", b"strl" + _chunk(b"strh", strh) + _chunk(b"strf", strf))
    hdrl = _chunk(b"LIST", b"hdrl" + _chunk(b"avih", avih) + strl)
    sizes = np.fromiter(map(len, frames), np.int64, len(frames))
    index = np.empty((len(frames), 4), "<u4")
    index[:, 0], index[:, 1], index[:, 3] = int.from_bytes(b"00dc", "little"), 0x10, sizes
    index[:, 2] = 4 + np.concatenate([[0], np.cumsum(8 + sizes + sizes % 2)[:-1]])
    movi = _chunk(b"LIST", b"movi" + b"".join(_chunk(b"00dc", f) for f in frames))
    return _chunk(b"RIFF", b"AVI " + hdrl + movi + _chunk(b"idx1", index.tobytes()))


def riff_chunks(data: bytes, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(name or list type, body start, body end) of the chunks between two offsets; of a list, the body begins after its type."""
    while start + 8 <= end:
        name, size = data[start : start + 4], struct.unpack_from("<I", data, start + 4)[0]
        body, stop = start + 8, start + 8 + size
        if stop > end:
            raise ValueError("a RIFF chunk runs over its parent")
        yield (data[body : body + 4], body + 4, stop) if name in (b"LIST", b"RIFF") else (name, body, stop)
        start = stop + size % 2


@functools.lru_cache(maxsize=64)
def _decoder(header: bytes) -> tuple[int, int, np.ndarray, np.ndarray]:
    """Height and width, and for each next 16 bits the code's length (0 if there is none) and category, from a frame's markers."""
    at, shape, codes = 2, None, {}
    while at < len(header):
        marker, size = struct.unpack_from(">HH", header, at)
        body = header[at + 4 : at + 2 + size]
        if marker == 0xFFC4:
            while body:
                n = sum(body[1:17])
                codes[body[0]] = list(zip(body[17 : 17 + n], huffman_codes(tuple(body[1:17]))))
                body = body[17 + n :]
        elif marker == 0xFFC3:
            if body[0] != 8 or body[5] != 1:
                raise ValueError("a frame isn't of one component of 8 bits")
            shape = struct.unpack(">HH", body[1:5])
        elif marker == 0xFFDA:
            chosen, predictor = body[2] >> 4, body[3]
            if predictor != 1 or chosen not in codes:
                raise ValueError("a frame's predictor isn't 1, or its Huffman table is missing")
        at += 2 + size
    if shape is None or not codes:
        raise ValueError("a frame lacks SOF3 or its Huffman table")
    length, category = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    for value, (code, bits) in codes[chosen]:
        own = slice(code << (16 - bits), (code + 1) << (16 - bits))
        length[own], category[own] = bits, value
    return (*shape, length, category)


def split_frame(frame: bytes) -> tuple[bytes, bytes]:
    """(header up to the scan, coded bits without stuffing) of a frame."""
    scan = frame.index(b"\xff\xda")
    begin = scan + 2 + struct.unpack_from(">H", frame, scan + 2)[0]
    return frame[:begin], frame[begin : frame.rindex(b"\xff\xd9")].replace(b"\xff\x00", b"\xff")


def decode_frames(frames: list[bytes]) -> list[np.ndarray]:
    """The samples of each frame, (height, width)."""
    out: list = [None] * len(frames)
    by_header: dict[bytes, list[tuple[int, bytes]]] = {}
    for k, frame in enumerate(frames):
        header, bits = split_frame(frame)
        by_header.setdefault(header, []).append((k, bits))
    for header, own in by_header.items():
        for i in range(0, len(own), BLOCK):
            part = own[i : i + BLOCK]
            for (k, _), samples in zip(part, _decode_block(header, [bits for _, bits in part])):
                out[k] = samples
    return out


def _decode_block(header: bytes, coded: list[bytes]) -> np.ndarray:
    """Frames of one header, a symbol of each at a time."""
    height, width, length, category = _decoder(header)
    sizes = np.fromiter(map(len, coded), np.int64, len(coded))
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"".join(coded) + b"\xff" * 8, np.uint8).astype(np.int64)
    words = (raw[:-4] << 32) | (raw[1:-3] << 24) | (raw[2:-2] << 16) | (raw[3:-1] << 8) | raw[4:]
    at, stop = (ends - sizes) * 8, ends * 8
    d = np.empty((height * width, len(coded)), np.int64)
    for k in range(height * width):
        next_ = (words[at >> 3] >> (24 - (at & 7))) & 0xFFFF
        bits, s = length[next_], category[next_]
        at = at + bits
        extra = (words[at >> 3] >> (40 - s - (at & 7))) & ((1 << s) - 1)
        d[k] = np.where((s > 0) & (extra < (1 << s >> 1)), extra - (1 << s) + 1, extra)
        at = np.minimum(at + s, stop)
        if not bits.all():
            raise ValueError("a frame has bits that are no code")
    d = d.T.reshape(-1, height, width)
    d[:, :, 0] = 128 + np.cumsum(d[:, :, 0], axis=1)
    return (np.cumsum(d, axis=2) & 255).astype(np.uint8)


def frames_of(data: bytes) -> list[bytes]:
    """The frames of an AVI file, by its index."""
    (_, start, end), *_ = riff_chunks(data, 0, len(data))
    parts = {name: (a, b) for name, a, b in riff_chunks(data, start, end)}
    movi = parts[b"movi"][0] - 4
    index = np.frombuffer(data, "<u4", offset=parts[b"idx1"][0], count=(parts[b"idx1"][1] - parts[b"idx1"][0]) // 4).reshape(-1, 4)
    return [data[movi + off + 8 : movi + off + 8 + n] for _, _, off, n in index.tolist()]


def decode_avi(data: bytes) -> np.ndarray:
    """All samples of an AVI file, (frames, height, width)."""
    return np.stack(decode_frames(frames_of(data)))


def find_shots(frames: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First frames of the shots, and each frame's histogram."""
    n = len(frames)
    hist = np.empty((n, BINS), np.int64)
    for i in range(0, n, BLOCK):
        part = frames[i : i + BLOCK].reshape(len(frames[i : i + BLOCK]), -1)
        key = (part >> 4).astype(np.int64) + np.arange(len(part))[:, None] * BINS
        hist[i : i + BLOCK] = np.bincount(key.ravel(), minlength=len(part) * BINS).reshape(-1, BINS)
    if n < 2:
        return np.zeros(1, np.int64), hist
    diff = np.abs(np.diff(hist, axis=0)).sum(axis=1) / (2.0 * frames[0].size)
    total, square = (np.concatenate([[0.0], np.cumsum(v)]) for v in (diff, diff * diff))
    lo, hi = np.maximum(np.arange(n - 1) - WINDOW, 0), np.minimum(np.arange(n - 1) + WINDOW + 1, n - 1)
    mean = (total[hi] - total[lo]) / (hi - lo)
    spread = np.sqrt(np.maximum((square[hi] - square[lo]) / (hi - lo) - mean * mean, 0))
    cuts = np.flatnonzero(diff > np.maximum(mean + SHARPNESS * spread, FLOOR)) + 1
    return np.concatenate([[0], cuts]), hist


def encode_media(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes and media: the whole text, stored as an AVI file."""
    kind = df.schema[key].dataType.simpleString()

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts, 1):
            sizes, files, held, begun = [], [], 0, 0
            for i, t in enumerate(part.column(1)):
                data = (t.as_py() or "").encode("utf-8")
                sizes.append(len(data))
                files.append(encode_avi(pad_payload(data)))
                held += len(files[-1])
                if held > YIELD_BYTES or i + 1 == part.num_rows:
                    keys = part.column(0).slice(begun, len(files))
                    yield pa.RecordBatch.from_arrays([keys, pa.array(sizes, pa.int64()), pa.array(files, pa.binary())], [key, "n_bytes", "media"])
                    sizes, files, held, begun = [], [], 0, i + 1

    return df.select(key, text).mapInArrow(encode, f"`{key}` {kind}, n_bytes long, media binary")


def _features(media: bytes, frames: np.ndarray) -> dict:
    payload = frames.tobytes()
    shots, hist = find_shots(frames)
    clips = [
        {"clip": i, "first_frame": a, "n_frames": b - a, "start_s": a / FPS, "end_s": b / FPS, "luma": round(float(frames[a:b].mean()), 3)}
        for i, (a, b) in enumerate(zip(shots.tolist(), [*shots[1:].tolist(), len(frames)]))
    ]
    return {
        "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-32:]),
        "media_bytes": len(media), "media_sha256": hashlib.sha256(media).hexdigest(),
        "feature": f"{len(frames)}f:{len(shots)}s:{zlib.crc32(hist.astype('<i8').tobytes()):08x}", "clips": clips,
    }


def decode_media(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_bytes, digests of the samples read back and of the stored file, its clips and a feature digest."""
    kind = df.schema[key].dataType.simpleString()
    clip = pa.struct([("clip", pa.int32()), ("first_frame", pa.int32()), ("n_frames", pa.int32()), ("start_s", pa.float64()), ("end_s", pa.float64()), ("luma", pa.float64())])
    fields = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "feature": pa.string(), "clips": pa.list_(clip)}

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in pieces(parts, 2):
            files = part.column(2).to_pylist()
            listed = [frames_of(m) for m in files]
            ends, samples = np.cumsum([len(f) for f in listed]).tolist(), decode_frames([f for own in listed for f in own])
            found = [_features(m, np.stack(samples[a:b])) for m, a, b in zip(files, [0, *ends], ends)]
            columns = [pa.array([f[name] for f in found], kind) for name, kind in fields.items()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], [key, "n_bytes", *fields])

    return df.select(key, "n_bytes", "media").mapInArrow(
        decode,
        f"`{key}` {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, clips {CLIPS}",
    )


def clip_rows(df: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row for each timed clip of ``decode_media``'s output; every file has one at least.  A null key gives clips with a null key, repeated
    rows repeated clips, an empty table none; other columns are left out."""
    return df.select(key, F.explode("clips").alias("c")).select(key, "c.*")
