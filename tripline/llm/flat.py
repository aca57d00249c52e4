"""Texts of an Arrow batch as one array of bytes, cut into words with numpy.

All word and byte kernels of this subpackage work on this form: the UTF-8 bytes of many texts laid end to end, the
offset at which each text begins, and the byte ranges of the words. A null text has no bytes. No word crosses a text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

# Bytes a kernel works on at a time; a longer text is worked on alone and whole.
PIECE_BYTES = 2 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Words between blanks: [^\x20\x09-\x0D]+
SPACED = ~_BLANK
#: Words of a-z, 0-9 and everything beyond ASCII: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_C1, _C2, _C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly; different values stay different."""
    x = (x ^ (x >> np.uint64(30))) * _C2
    x ^= x >> np.uint64(27)
    x *= _C3
    x ^= x >> np.uint64(31)
    return x


def combined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit name of an ordered pair of 64-bit names."""
    return mixed(left * _C1 + (right ^ (right >> np.uint64(29))) * _C3 + _C2)


@dataclass(frozen=True)
class Flat:
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @cached_property
    def lowered(self) -> Flat:
        return Flat(_LOWER[self.data], self.offsets)

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.diff(self.offsets)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The text that each byte position lies in."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    @cached_property
    def padded(self) -> np.ndarray:
        """The bytes, and eight zeros."""
        return np.concatenate([self.data, np.zeros(8, np.uint8)])

    @cached_property
    def eights(self) -> np.ndarray:
        """At each byte the next eight bytes as one number; beyond the end are zeros."""
        return np.ndarray((len(self.data) + 1,), "<u8", self.padded, strides=(1,))


@dataclass(frozen=True)
class Words:
    flat: Flat
    starts: np.ndarray
    ends: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)

    @cached_property
    def offsets(self) -> np.ndarray:
        """The first word of each text, and the number of all words."""
        return np.searchsorted(self.starts, self.flat.offsets)

    @cached_property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    @cached_property
    def text(self) -> np.ndarray:
        """The text that each word is in."""
        return np.repeat(np.arange(len(self.flat)), self.counts)

    @cached_property
    def names(self) -> np.ndarray:
        """A 64-bit fingerprint of the bytes of each word."""
        length = self.ends - self.starts
        eights = self.flat.eights
        masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
        out = mixed((eights[self.starts] & masks[np.minimum(length, 8)]) + length.astype(np.uint64) * _C1)
        rest, done = np.flatnonzero(length > 8), 8
        while len(rest):
            chunk = eights[self.starts[rest] + done] & masks[np.minimum(length[rest] - done, 8)]
            out[rest] = combined(out[rest], chunk)
            done += 8
            rest = rest[length[rest] > done]
        return out

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all runs of n words inside one text, and the word each begins at."""
        names = self.names
        if len(names) < n:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        out = names[: len(names) - n + 1].copy()
        for k in range(1, n):
            out = combined(out, names[k : len(names) - n + 1 + k])
        last = np.repeat(self.offsets[1:], self.counts)[: len(out)]
        inside = np.flatnonzero(np.arange(len(out)) + n <= last)
        return out[inside], inside


def range_names(flat: Flat, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of byte ranges."""
    out = mixed((ends - starts).astype(np.uint64))
    masks = np.array([(1 << 8 * k) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
    at, todo = starts.copy(), np.arange(len(starts))
    while len(todo):
        left = ends[todo] - at[todo]
        out[todo] = combined(out[todo], flat.eights[at[todo]] & masks[np.minimum(left, 8)])
        at[todo] += 8
        todo = todo[left > 8]
    return out


def words_of(flat: Flat, letters: np.ndarray = SPACED) -> Words:
    """The maximal runs of bytes that are letters, inside one text each."""
    n = len(flat.data)
    inside = letters[flat.data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    begins = flat.offsets[:-1][flat.lengths > 0]
    first[begins] = inside[begins]
    ends = flat.offsets[1:][flat.lengths > 0] - 1
    last[ends] = inside[ends]
    assert len(first) == n
    return Words(flat, np.flatnonzero(first), np.flatnonzero(last) + 1)


def flattened(texts: pa.Array) -> Flat:
    """The texts laid end to end, without copying them."""
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_string(texts.type) else b"")
    offsets = _offsets(texts)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return Flat(data[offsets[0] : offsets[-1]], offsets - offsets[0])


def _offsets(texts: pa.Array) -> np.ndarray:
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    if not len(texts):
        return np.zeros(1, np.int64)
    raw = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    return raw[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def pieces(batch: pa.RecordBatch, column: str = "text", size: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text, one text at least."""
    offsets = _offsets(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to
