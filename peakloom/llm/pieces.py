"""Recurring pieces of texts, found by hash in whole batches."""

from __future__ import annotations

import numpy as np

_ODD = np.random.default_rng(7).integers(0, 1 << 63, (2, 256), np.int64).astype(np.uint64) | np.uint64(1)
_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(a piece for each distinct content, the content of each piece, two 64-bit hashes of each content) of
    non-empty pieces of bytes. Both hashes must agree; where they do not, pieces are compared whole."""
    size = ends - starts
    total = int(size.sum())
    first = np.cumsum(size) - size
    offset = np.arange(total) - np.repeat(first, size)
    octets = data if total == len(data) else data[offset + np.repeat(starts, size)]
    codes = []
    for table, step in zip(_ODD, _STEP):
        power = np.cumprod(np.full(int(size.max(initial=1)), step, np.uint64))
        codes.append(mix(np.add.reduceat(table[octets] * power[offset], first)))
    _, one, which = np.unique(codes[0], return_index=True, return_inverse=True)
    if not np.array_equal(codes[1][one][which], codes[1]):
        raw, found = data.tobytes(), {}
        which = np.array([found.setdefault(raw[a:b], len(found)) for a, b in zip(starts.tolist(), ends.tolist())])
        one = np.unique(which, return_index=True)[1]
    return one, which, codes[0][one], codes[1][one]


class Store:
    """Items of pieces seen before, by their hashes: sorted arrays, emptied when `limit` is passed."""

    def __init__(self, limit: int, item: str = "<u4"):
        self.limit, self.item = limit, item
        self.clear()

    def clear(self) -> None:
        self.codes, self.checks = np.empty((2, 0), np.uint64)
        self.begin = self.length = np.empty(0, np.int64)
        self.flat = np.empty(0, self.item)

    def find(self, codes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(known, place) of each piece."""
        if not len(self.codes):
            return np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return (self.codes[at] == codes) & (self.checks[at] == checks), at

    def add(self, codes: np.ndarray, checks: np.ndarray, flat: np.ndarray, length: np.ndarray) -> None:
        """New pieces in ascending order of `codes`, their items one after another."""
        if len(self.codes) > self.limit:
            self.clear()
        at = np.searchsorted(self.codes, codes)
        begin = np.cumsum(length) - length + len(self.flat)
        for name, new in (("codes", codes), ("checks", checks), ("begin", begin), ("length", length)):
            setattr(self, name, np.insert(getattr(self, name), at, new))
        self.flat = np.concatenate([self.flat, flat])


def lay_out(flat: np.ndarray, begin: np.ndarray, length: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the items of all pieces one after another, n + 1 offsets) from where each content's items are."""
    sizes = length[which]
    ends = np.cumsum(sizes)
    place = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(begin[which] - (ends - sizes), sizes)
    return flat[place], np.concatenate([[0], ends])


def texts_of(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes one after another, n + 1 offsets) of an Arrow string column without nulls."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def slices(column, size: int):
    """(first row, rows) of runs of rows with about `size` bytes of text."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    start = 0
    while start < len(column):
        stop = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield start, stop - start
        start = stop
