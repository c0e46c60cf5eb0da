"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes of a class; a byte class is a table of 256 booleans. Words and
word sequences are compared by 64-bit hashes: polynomial over randomised byte values, then
mixed. Work proceeds in slices of about SLICE bytes, so memory does not grow with the
number of rows in a batch, only with the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
U = np.uint64
WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Everything but white space.
SPACED = ~WHITE
#: Digits, lower-case letters and all beyond ASCII; upper-case letters count as lower.
ALNUM = np.array([0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


BASE = 0x9E3779B97F4A7C15
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * U(0xD1342543DE82EF95))
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse modulo 2**64, for i below n."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE + 1)
        for key, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[key] = np.cumprod(table)
    return _powers["up"], _powers["down"]


@dataclass
class Words:
    """Words of a slice. Those of text d are first[d] up to first[d + 1]."""

    rows: range
    first: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    #: All bytes of the slice, and where each text begins in them.
    data: np.ndarray
    offsets: np.ndarray

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def _hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans, in blocks that are cut between spans."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        begin = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + SLICE, "right")))
        block = data[begin:ends[j - 1]]
        up, down = powers(len(block) + 1)
        sums = np.zeros(len(block) + 1, np.uint64)
        np.cumsum(BYTES[block] * up[:len(block)], out=sums[1:])
        s, e = starts[i:j] - begin, ends[i:j] - begin
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def slices(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of consecutive texts of about SLICE bytes. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE, "right")) - 1)
        j = min(j, len(column))
        yield range(i, j), data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def words(column: pa.Array, kind: np.ndarray, lower: bool = True) -> Iterator[Words]:
    """The words of every text of the column, slice by slice."""
    for rows, data, offsets in slices(column):
        inside = np.zeros(len(data) + 1, bool)
        inside[:-1] = kind[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.zeros(len(data) + 1, bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut))
        ends = np.flatnonzero(before & (~inside | cut))
        folded = LOWER[data] if lower else data
        yield Words(rows, np.searchsorted(starts, offsets), starts, ends,
                    _hash_spans(folded, starts, ends), folded, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words of one text."""
    total = np.full(max(len(hashes) - n + 1, 0), n, np.uint64)
    for i in range(n if len(total) else 0):
        total = mix(total * U(BASE) + hashes[i:i + len(total)])
    return total


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Distinct n-word shingles of one text, sorted; a shorter text is one shingle."""
    return np.unique(grams(hashes, min(n, len(hashes)))) if len(hashes) else hashes[:0]
