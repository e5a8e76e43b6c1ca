"""Texts as sequences of stretches, each of which is worked on once.

A stretch begins at a blank that follows a character which surely isn't white space, so it holds its blanks and the word behind them.  The tokenizers
used here never join what lies on both sides of such a place: a text's ids are those of its stretches, one after the other.  Words come again and
again, so most of the work is looking stretches up; a text without blanks is one stretch.

For tokenizers that also never join a letter and a mark, ``apart`` names marks at which words end as well, so that a word is one stretch whatever follows it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

BLANKS = b" \t\n\x0b\x0c\r"
# Last bytes of the characters of more than one byte that Unicode counts as white space; after these nothing is cut.
UNSURE = {*range(0x80, 0x8B), 0x85, 0x9F, 0xA0, 0xA8, 0xA9, 0xAF}
FIRM = np.array([0x20 < b != 0x7F and b not in UNSURE for b in range(256)])
LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
#: First byte of U+00C0 to U+00FF, and second bytes of those two of them that aren't letters.
LATIN, SIGNS = 0xC3, (0x97, 0xB7)
#: A memo of more stretches, or of more bytes of them, begins anew with the next batch.
MOST, MOST_BYTES = 3 << 17, 24 << 20


class Memo(dict):
    """Numbers of distinct stretches, in the order they come; ``fresh`` are those not worked on yet."""

    def __init__(self, most: int = MOST, most_bytes: int = MOST_BYTES) -> None:
        super().__init__()
        self.most, self.most_bytes = most, most_bytes
        self.fresh: list[bytes] = []
        self.bytes = 0

    def __missing__(self, stretch: bytes) -> int:
        self[stretch] = number = len(self)
        self.fresh.append(stretch)
        self.bytes += len(stretch)
        return number

    @property
    def full(self) -> bool:
        return len(self) > self.most or self.bytes > self.most_bytes

    def numbers(self, texts: pa.Array, starts_at: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the stretches of all texts, how many each text has); ``starts_at`` says of every byte value whether a stretch may begin there,
        ``apart`` (``marks_apart``) which are letters and which are marks that a stretch doesn't hold together with them.

        Null and empty texts have none.  Equal stretches of a batch are found by Arrow, so only distinct ones are looked up here.
        """
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = texts.buffers()[2] if offsets[-1] > offsets[0] else None
        if data is None:
            return np.empty(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        at = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]]
        begun = np.zeros(len(at) + 1, dtype=bool)
        begun[1:-1] = starts_at[at[1:]] & FIRM[at[:-1]]
        if apart is not None:
            kind = apart[at]
            first = np.flatnonzero(at == LATIN)
            first = first[~np.isin(at[first + 1], SIGNS)]
            kind[first] = kind[first + 1] = LETTER
            begun[1:-1] |= kind[1:] + kind[:-1] == LETTER + MARK
            begun[first[first + 2 < len(at)] + 2] |= starts_at[at[first[first + 2 < len(at)] + 2]]  # these letters aren't white space
        begun[offsets - offsets[0]] = True
        bounds = np.flatnonzero(begun) + offsets[0]
        cells = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype("<i8").tobytes()), data]).dictionary_encode()
        own = np.fromiter(map(self.__getitem__, slices(cells.dictionary)), dtype=np.int64, count=len(cells.dictionary))
        places = np.searchsorted(bounds, offsets)
        return own[cells.indices.to_numpy()], places[1:] - places[:-1]


def slices(cells: pa.Array) -> Iterator[bytes]:
    """The values of a large binary array without nulls."""
    ends = np.frombuffer(cells.buffers()[1], dtype=np.int64)[cells.offset : cells.offset + len(cells) + 1]
    data = cells.buffers()[2].slice(int(ends[0]), int(ends[-1] - ends[0])).to_pybytes()
    ends = (ends - ends[0]).tolist()
    return map(data.__getitem__, map(slice, ends, ends[1:]))


def begins(blanks: bytes) -> np.ndarray:
    """Of every byte value, whether it is one of ``blanks``."""
    out = np.zeros(256, dtype=bool)
    out[list(blanks)] = True
    return out


LETTER, MARK = 1, 2


def marks_apart(but: bytes) -> np.ndarray:
    """Of every byte value, whether it is a letter or a mark; neither are those of ``but``, digits, and whatever isn't ASCII."""
    out = np.zeros(256, dtype=np.uint8)
    out[[b for b in range(0x21, 0x7F) if b not in b"0123456789" and b not in but]] = MARK
    out[list(LETTERS)] = LETTER
    return out


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(values, lengths) of several lists."""
    lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(lengths.sum())), lengths


class Pool:
    """Arrays of several stretches behind each other, from which sequences of stretches are put together."""

    def __init__(self) -> None:
        self.parts: list[np.ndarray] = [np.empty(0, dtype=np.int64)]
        self.sizes: list[np.ndarray] = [np.empty(0, dtype=np.int64)]

    def add(self, values: np.ndarray, lengths: np.ndarray) -> None:
        self.parts.append(values)
        self.sizes.append(lengths)

    def settle(self) -> None:
        self.parts, self.sizes = [np.concatenate(self.parts)], [np.concatenate(self.sizes)]
        self.offsets = np.cumsum(self.sizes[0]) - self.sizes[0]

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, lengths) of the stretches numbered ``which``."""
        lengths = self.sizes[0][which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.parts[0][np.repeat(self.offsets[which] - (ends - lengths), lengths) + np.arange(total)], lengths

