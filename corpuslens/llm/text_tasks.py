"""Texts of a batch as flat arrays, used inside tasks. Nothing here knows Spark."""

import numpy as np
import pyarrow as pa
import xxhash

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only
GAP = np.zeros(256, bool)
GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def flat(column):
    """``(bytes, offsets)`` of a column of strings; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_string()) for c in column.chunks]) if (
            column.num_chunks
        ) else pa.array([], pa.large_string())
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or bounds[-1] == bounds[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def slices(offsets, most_bytes):
    """Ranges of documents with about ``most_bytes`` of text each, at least one document."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most_bytes, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def words(data, offsets, gaps=GAP):
    """``(starts, ends, document)`` of the runs without white space, or without the bytes marked
    in ``gaps``; none crosses a text."""
    gap = gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:]
    starts = np.flatnonzero(~gap & (before | edge[:-1]))
    ends = np.flatnonzero(~gap & (after | edge[1:])) + 1
    document = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, document


def distinct(data, starts, ends):
    """``(index of each word, distinct words as Arrow strings)``."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    inside = np.zeros(len(data) + 1, np.int8)
    inside[starts] = 1
    inside[ends] -= 1
    kept = data[np.cumsum(inside[:-1], dtype=np.int8) > 0] if len(data) else data
    values = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(kept))
    ).dictionary_encode()
    return values.indices.to_numpy(zero_copy_only=False), values.dictionary


def hashed(dictionary):
    """A 64-bit hash for each distinct word."""
    hash_of = xxhash.xxh3_64_intdigest
    return np.fromiter((hash_of(w) for w in dictionary.to_pylist()), np.uint64, len(dictionary))


def mixed(h):
    """Finish a 64-bit hash (the finaliser of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Ragged:
    """Arrays of different lengths in one, which may grow."""

    def __init__(self):
        self.values, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, values, bounds):
        self.bounds = np.concatenate([self.bounds, bounds[1:] + len(self.values)])
        self.values = np.concatenate([self.values, values])

    def rows(self, index):
        """The rows with these numbers, one after the other, and their bounds."""
        lengths = (self.bounds[1:] - self.bounds[:-1])[index]
        bounds = np.zeros(len(index) + 1, np.int64)
        np.cumsum(lengths, out=bounds[1:])
        place = np.arange(bounds[-1]) + np.repeat(self.bounds[:-1][index] - bounds[:-1], lengths)
        return self.values[place], bounds


def planes(values):
    """Unsigned numbers as bytes, all lowest bytes first: small numbers compress well."""
    values = np.ascontiguousarray(values)
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data, dtype):
    size = np.dtype(dtype).itemsize
    rows = np.frombuffer(data, np.uint8).reshape(size, -1)
    return np.ascontiguousarray(rows.T).view(dtype).reshape(-1)
