"""Texts as numpy arrays: slices of Arrow batches, words, shingles, character n-grams.

Everything here works on one slice of a batch, a megabyte or a single longer
text, so memory does not depend on the table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_U = np.uint64
_rng = np.random.default_rng(20240611)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_PLACES = _rng.integers(1, 2**63, 8, dtype=np.uint64) * _U(2) + _U(1)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes of text, or one row."""
    n = batch.num_rows
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column's texts, null read as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """Powers of the base and of its inverse, grown to the longest slice seen."""

    size = 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 2 * SLICE_BYTES)
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.multiply.accumulate(np.full(self.size, b, dtype=np.uint64)) for b in (_BASE, _BASE_INVERSE)
                )
        return self.up, self.down


_powers = _Powers()


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts: bytes (A-Z lowered), starts, ends, 64-bit hashes, first word per text.

    A word is a longest run of bytes other than space and 0x09-0x0D. The last
    array has one entry more than there are texts.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    data = _LOWER[data]
    if not len(data):
        none = np.empty(0, np.int64)
        return data, none, none, np.empty(0, np.uint64), np.zeros(n + 1, np.int64)
    inside = ~_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    up, down = _powers.upto(len(data))
    with np.errstate(over="ignore"):
        sums = np.cumsum(_BYTE[data] * up[: len(data)])
        sums = np.concatenate([np.zeros(1, np.uint64), sums])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return data, starts, ends, hashes, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, firsts: np.ndarray, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words.

    A text with fewer words has its whole sequence as the only one; without
    words the set is empty.
    """
    n = len(hashes)
    with np.errstate(over="ignore"):
        whole = np.zeros(max(0, n - width + 1), np.uint64)
        for k in range(width):
            whole += hashes[k : k + len(whole)] * _PLACES[k]
        whole = mix(whole)
        found = []
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist(), strict=True):
            if b - a >= width:
                s = np.sort(whole[a : b - width + 1])
                found.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif b > a:
                short = (hashes[a:b] * _PLACES[: b - a]).sum(dtype=np.uint64) + _U(b - a)
                found.append(mix(np.array([short], dtype=np.uint64)))
            else:
                found.append(np.empty(0, np.uint64))
    return found


def codepoints(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the first position of each text."""
    ends = np.cumsum([0, *map(len, texts)])
    flat = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(flat, dtype=np.uint32), ends


def grams(points: np.ndarray, n: int) -> np.ndarray:
    """64-bit hash of the ``n`` code points from each position on."""
    length = max(0, len(points) - n + 1)
    with np.errstate(over="ignore"):
        h = np.full(length, n, np.uint64)
        for k in range(n):
            h += points[k : length + k].astype(np.uint64) * _PLACES[k]
        return mix(h)
