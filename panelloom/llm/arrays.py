"""Numpy kernels over the byte buffers of Arrow string columns.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D, so UTF-8 text needs no decoding.
Hashes are 64-bit polynomials over random byte values, modulo 2**64, with a final mixing step;
a span's hash does not depend on where in the buffer it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
U64 = np.uint64

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASES = {"bytes": 0x9E3779B97F4A7C15, "words": 0xD6E8FEB86659FD93}
_powers: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base, and of its inverse modulo 2**64."""
    kept = _powers.get(kind)
    if kept is None or len(kept[0]) <= n:
        base = _BASES[kind]
        size = max(n + 1, 1 << 16)
        with np.errstate(over="ignore"):
            kept = tuple(
                np.multiply.accumulate(np.concatenate([[U64(1)], np.full(size, U64(b), np.uint64)]))
                for b in (base, pow(base, -1, 1 << 64))
            )
        if n <= 4 * CHUNK_BYTES:  # one very long text must not stay in memory
            _powers[kind] = kept
    return kept


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> U64(33))) * U64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> U64(33))


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)


class Texts(NamedTuple):
    """Some rows of a text column: ``data[offsets[i]:offsets[i + 1]]`` is row ``first + i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def texts(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """The column in runs of rows of about ``limit`` bytes; NULL is empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_large_binary(column.type) else "")
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, body = column.buffers()
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1)
        yield Texts(row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


class Words(NamedTuple):
    """Word ``j`` is ``data[starts[j]:ends[j]]``; row ``i`` has words ``first[i]`` to ``first[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def words(part: Texts) -> Words:
    inside = ~SPACE[part.data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = np.flatnonzero(part.offsets[1:] > part.offsets[:-1])
    head, tail = part.offsets[:-1][filled], part.offsets[1:][filled] - 1
    begins[head] = inside[head]
    stops[tail] = inside[tail]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, part.offsets))


class Spans:
    """Hashes of any spans of a buffer."""

    def __init__(self, data: np.ndarray):
        up, self._down = powers("bytes", len(data))
        self._total = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=self._total[1:])

    def hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._total[ends] - self._total[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``."""
    return Spans(data).hash(starts, ends)


class Rolling:
    """Hash of any run of words, from the words' hashes."""

    def __init__(self, hashes: np.ndarray):
        up, self._down = powers("words", len(hashes))
        self._total = np.zeros(len(hashes) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(hashes * up[: len(hashes)], out=self._total[1:])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self._total[ends] - self._total[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each start on, for all starts that have ``k`` words."""
        n = len(self._total) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        with np.errstate(over="ignore"):
            return mix((self._total[k:] - self._total[:-k]) * self._down[:n] + U64(k))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of the runs ``start .. start + length - 1``, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


class Memo:
    """Ids of byte strings met before, by the strings' hashes; forgets everything once it holds ``limit`` strings."""

    def __init__(self, limit: int):
        self._limit = limit
        self.clear()

    def clear(self) -> None:
        self._keys, self._rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._place, self._size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids, self._used = np.zeros(1 << 12, np.int32), 0

    def __len__(self) -> int:
        return len(self._keys)

    def missing(self, hashes: np.ndarray) -> np.ndarray:
        """Which hashes are not known yet; call before ``add`` and ``find`` for the same strings."""
        if len(self._keys) > self._limit:
            self.clear()
        if not len(self._keys):
            return np.ones(len(hashes), bool)
        at = np.minimum(np.searchsorted(self._keys, hashes), len(self._keys) - 1)
        return self._keys[at] != hashes

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        """``ids`` holds the strings' ids one after the other; the hashes ascend."""
        while self._used + len(ids) > len(self._ids):
            self._ids = np.append(self._ids, np.zeros_like(self._ids))
        self._ids[self._used : self._used + len(ids)] = ids
        rows = np.arange(len(self._size), len(self._size) + len(hashes))
        self._place = np.append(self._place, self._used + np.cumsum(sizes) - sizes)
        self._size = np.append(self._size, sizes)
        self._used += len(ids)
        at = np.searchsorted(self._keys, hashes)
        self._keys, self._rows = np.insert(self._keys, at, hashes), np.insert(self._rows, at, rows)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and size of each string's ids in :attr:`ids`."""
        rows = self._rows[np.searchsorted(self._keys, hashes)] if len(hashes) else np.zeros(0, np.int64)
        return self._place[rows], self._size[rows]

    @property
    def ids(self) -> np.ndarray:
        return self._ids


def cut(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    body = data.tobytes()
    return [body[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
