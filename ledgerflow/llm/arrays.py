"""Array helpers for text inside Arrow batches: byte views, words, 64-bit hashes.

Equality of words and shingles is decided on 64-bit hashes: the sum of a random odd factor of each byte times random odd
factors of its place, with a final mix. Factors of different places are independent of each other (powers of one base would
cancel for texts that exchange letters along a regular pattern), so the chance that any two of 10^7 different words of a
task meet is below 10^-4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 4 << 20
#: For operators that hash every byte of a slice at once: some 40 bytes of arrays for each of them.
HASHED_BYTES = 1 << 20
_RNG = np.random.default_rng(20240607)
_STEP = 1 << 16

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _factors(n: int) -> np.ndarray:
    return _RNG.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _factors(256)
_NEAR, _FAR = _factors(_STEP), _factors(_STEP)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``limit`` bytes of text, or one row."""
    if batch.num_rows == 0:
        return
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows in one array, and the rows' offsets in it; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of true bytes; a run never crosses a row."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = np.zeros(len(member), bool)
    before[1:] = member[:-1]
    before[offsets[:-1][offsets[:-1] < len(member)]] = False
    after = np.zeros(len(member), bool)
    after[:-1] = member[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    return np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1


def row_of(places: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The row that each byte place lies in."""
    return np.searchsorted(offsets, places, "right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    first = np.cumsum(size) - size
    within = np.arange(int(size.sum()), dtype=np.int64)
    place = within - np.repeat(first, size)
    value = _BYTE[data[place + np.repeat(starts, size)]]
    longest = int(size.max())
    value *= _NEAR[place if longest <= _STEP else place % _STEP]
    if longest > _STEP:
        value *= _FAR[(place // _STEP) % _STEP]
    return mix(np.add.reduceat(value, first) + size.astype(np.uint64))


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each span, one span after another."""
    total = int(sizes.sum())
    first = np.cumsum(sizes) - sizes
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, sizes)
