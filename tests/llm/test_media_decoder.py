"""Frames with other Huffman tables, sizes and headers than the encoder's; the feature by brute force."""

import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.test_tables import slow_jpeg
from tidelog.llm import media


def plain_frame(samples, counts, values):
    """A lossless JPEG frame, bit by bit, with a Huffman table of one's own."""
    height, width = samples.shape
    codes = dict(zip(values, media.huffman_codes(counts)))
    bits = ""
    for y in range(height):
        for x in range(width):
            before = samples[y, x - 1] if x else samples[y - 1, 0] if y else 128
            d = int(samples[y, x]) - int(before)
            s = abs(d).bit_length()
            code, n = codes[s]
            bits += f"{code:0{n}b}" + (f"{d if d >= 0 else d + (1 << s) - 1:0{s}b}" if s else "")
    bits += "1" * (-len(bits) % 8)
    coded = bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)).replace(b"\xff", b"\xff\x00")
    table = bytes([0, *counts, *values])
    shape = struct.pack(">HBHHB3B", 11, 8, height, width, 1, 1, 0x11, 0)
    return b"\xff\xd8\xff\xc4" + struct.pack(">H", 2 + len(table)) + table + b"\xff\xc3" + shape + b"\xff\xda" + struct.pack(">HB2B3B", 8, 1, 1, 0, 1, 0, 0) + coded + b"\xff\xd9"


TABLES = [
    ((0, 0, 0, 9) + (0,) * 12, tuple(range(9))),
    ((1, 1, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0, 1), (5, 4, 6, 3, 7, 2, 8, 1, 0)),
    ((0, 1, 5, 1, 1, 1, 1, 1, 1) + (0,) * 7, tuple(range(12))),
]


@pytest.mark.parametrize("counts,values", TABLES)
def test_any_huffman_table(counts, values):
    rng = np.random.default_rng(3)
    for shape in ((24, 24), (3, 7), (1, 1)):
        samples = rng.integers(0, 256, shape).astype(np.uint8)
        frame = plain_frame(samples, counts, values)
        assert (slow_jpeg(frame) == samples).all()
        assert (media.decode_frames([frame])[0] == samples).all()


def test_frames_of_different_headers_in_one_batch():
    rng = random.Random(5)
    frames, want = [], []
    for _ in range(30):
        counts, values = rng.choice(TABLES)
        samples = np.array([[rng.randrange(256) for _ in range(5)] for _ in range(rng.choice((2, 4)))], np.uint8)
        frames.append(plain_frame(samples, counts, values))
        want.append(samples)
    assert all((a == b).all() for a, b in zip(media.decode_frames(frames), want))


def test_broken_frames_are_refused():
    frame = media._encode_block(np.zeros((1, 24, 24), np.uint8) + np.arange(24, dtype=np.uint8))[0]
    with pytest.raises(ValueError):
        media.decode_frames([frame[:-40] + frame[-2:]])
    with pytest.raises(ValueError):
        media.decode_frames([frame.replace(b"\xff\xc3", b"\xff\xc0")])


def test_features_by_brute_force(docs):
    """Frames, shots and the histogram digest of every document, frame by frame."""
    found = {r.doc_id: r.feature for r in media.decode_media(media.encode_media(docs)).collect()}
    for r in docs.collect():
        data = media.pad_payload((r.text or "").encode())
        frames = [data[i : i + 576] for i in range(0, len(data), 576)]
        hists = [[Counter(b >> 4 for b in f)[k] for k in range(media.BINS)] for f in frames]
        diff = [sum(abs(a - b) for a, b in zip(x, y)) / 1152 for x, y in zip(hists, hists[1:])]
        shots = 1
        for i, d in enumerate(diff):
            near = diff[max(0, i - media.WINDOW) : i + media.WINDOW + 1]
            mean = sum(near) / len(near)
            spread = (max(0.0, sum(v * v for v in near) / len(near) - mean * mean)) ** 0.5
            shots += d > max(mean + media.SHARPNESS * spread, media.FLOOR)
        digest = zlib.crc32(b"".join(struct.pack("<q", n) for h in hists for n in h))
        assert found[r.doc_id] == f"{len(frames)}f:{shots}s:{digest:08x}"
