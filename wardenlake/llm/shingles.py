"""Words, shingles and signatures of Arrow text columns, computed with NumPy over whole buffers.

Everything works on the bytes of a batch at once; texts of any length are cut into slices at separators, so the
memory of a task depends on the slice, not on the longest text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of one slice.
SLICE = 1 << 20

U64 = np.uint64
_rng = np.random.default_rng(20260101)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_STEP = U64(0xD6E8FEB86659FD93)
_STEPS = np.arange(1, 65, dtype=np.uint64) * _STEP

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixer of 64-bit values."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and the offsets of its rows; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data, offsets


def _slice_words(data: np.ndarray, firsts: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, start positions and lengths of the words of a slice. ``firsts``: positions at which a row begins."""
    body = ~separator[data]
    begin = body.copy()
    begin[1:] &= ~body[:-1]
    firsts = firsts[firsts < len(data)]
    begin[firsts] |= body[firsts]
    at = np.flatnonzero(body)
    if not len(at):
        return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
    head = np.flatnonzero(begin[at])
    starts = at[head]
    length = np.diff(np.append(head, len(at)))
    place = np.arange(len(at)) - np.repeat(head, length)
    power = np.full(int(length.max()), _BASE, U64)
    power[0] = U64(1)
    power = np.cumprod(power, dtype=U64)
    value = _BYTE[_FOLD[data[at]]] * power[place]
    return mix(np.add.reduceat(value, head) + length.astype(U64) * _STEP), starts, length


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of every row, A-Z lower-cased, and the first word of each row
    (one entry more than rows)."""
    data, offsets = buffers(column)
    hashes, starts, _ = located_words(data, offsets)
    return hashes, np.searchsorted(starts, offsets, "left")


def located_words(
    data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes (A-Z lower-cased), start positions and lengths of the words of all rows. ``separator``: a flag for each of the
    256 bytes, set for those that end a word."""
    out, place, sizes = [], [], []
    pos, end = (int(offsets[0]), int(offsets[-1])) if len(offsets) else (0, 0)
    while pos < end:
        stop = min(end, pos + SLICE)
        if stop < end:  # end the slice behind a separator or a row, so that no word is cut
            row_end = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            gaps = np.flatnonzero(separator[data[pos:stop]])
            stop = max(row_end, pos + int(gaps[-1]) + 1 if len(gaps) else 0)
            if stop <= pos:  # one word longer than a slice
                far = int(offsets[np.searchsorted(offsets, pos, "right")])
                gaps = np.flatnonzero(separator[data[pos:far]])
                stop = pos + int(gaps[0]) + 1 if len(gaps) else far
        lo, hi = np.searchsorted(offsets, [pos, stop], "left")
        hashes, starts, lengths = _slice_words(data[pos:stop], offsets[lo:hi] - pos, separator)
        out.append(hashes)
        place.append(starts + pos)
        sizes.append(lengths)
        pos = stop
    if not out:
        return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out), np.concatenate(place), np.concatenate(sizes)


def shingle_rows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of ``width`` words of every row and the first shingle of each row; a row with fewer words has
    its whole sequence as its only shingle, a row without words has none."""
    n = np.diff(first)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(count)])
    total = int(begin[-1])
    if not total:
        return np.empty(0, U64), begin
    at = np.arange(total) - np.repeat(begin[:-1], count) + np.repeat(first[:-1], count)
    size = np.repeat(np.minimum(n, width), count)
    value = np.zeros(total, U64)
    for i in range(width):
        inside = size > i
        if inside.all():
            value = mix(value + hashes[at + i] + _STEPS[i])
        else:
            where = np.flatnonzero(inside)
            value[where] = mix(value[where] + hashes[at[where] + i] + _STEPS[i])
    return value, begin


def distinct_rows(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row."""
    sets = [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else np.empty(0, U64)), np.concatenate([[0], np.cumsum(sizes)])


@dataclass(frozen=True)
class Bands:
    """Banding of a signature: ``bands`` keys of ``rows`` values each.

    ``both``: keep the minimum and the maximum under every permutation, so that half the permutations give as
    many values. A key takes its values from ``rows`` different permutations, minima in the first half of
    the keys and maxima in the second, so the values inside a key stay independent.
    """

    bands: int
    rows: int
    both: bool

    @property
    def permutations(self) -> int:
        return self.bands * self.rows // (2 if self.both else 1)

    def miss(self, similarity: float) -> float:
        """Probability that a pair of this similarity shares no key."""
        return (1 - similarity**self.rows) ** self.bands

    def keys(self, values: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Keys (rows x bands, int64) of the rows that have values; the others get zeros."""
        some = np.flatnonzero(np.diff(begin))
        out = np.zeros((len(begin) - 1, self.bands), np.int64)
        if not len(some):
            return out
        draw = np.random.default_rng(7)
        turn = draw.integers(0, 2**63, self.permutations, dtype=np.uint64)
        factor = draw.integers(0, 2**63, self.permutations, dtype=np.uint64) * U64(2) + U64(1)
        weight = draw.integers(0, 2**63, self.permutations, dtype=np.uint64) * U64(2) + U64(1)
        heads = begin[:-1][some]
        low = np.zeros((self.permutations // self.rows, len(some)), U64)
        high = np.zeros_like(low)
        for p in range(self.permutations):
            order = (values ^ turn[p]) * factor[p]
            low[p // self.rows] += mix(np.minimum.reduceat(order, heads)) * weight[p]
            if self.both:
                high[p // self.rows] += mix(np.maximum.reduceat(order, heads)) * weight[p]
        joined = np.concatenate([low, high]) if self.both else low
        salt = np.arange(1, self.bands + 1, dtype=np.uint64)[:, None] * _BASE
        out[some] = mix(joined ^ salt).T.view(np.int64)
        return out


def set_digests(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of every row's set of distinct values (0 for an empty set)."""
    some = np.flatnonzero(np.diff(begin))
    one, two = np.zeros(len(begin) - 1, U64), np.zeros(len(begin) - 1, U64)
    if len(some):
        heads = begin[:-1][some]
        one[some] = np.add.reduceat(mix(values + _STEP), heads)
        two[some] = np.add.reduceat(mix(values ^ _BASE), heads)
    return one.view(np.int64), two.view(np.int64)


def list_column(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """List column of 64-bit values."""
    return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values.view(np.int64)))
