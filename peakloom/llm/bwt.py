"""Classes of equal substrings from a Burrows-Wheeler transform, by threshold-bounded interval expansion.

The interval of a string holds the suffixes that begin with it. Starting from the empty string, intervals
are extended backwards by one symbol, breadth first, so the right ends of the intervals of length n mark
the places where the common prefix of neighbouring suffixes is n - 1: common prefixes appear by increasing
value. An end seen before was found by a shorter string and is not expanded again, so every row is an end
once. Expansion stops at the minimum length; rows that are still joined share a prefix of that length.
"""

from __future__ import annotations

import numpy as np


def _order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffix order by the first `depth` symbols at least: by 8 symbols, then by the ranks of two or, where
    they fit into one number, three such stretches at a time."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + n]
    length = 8
    while True:
        order = np.argsort(key)
        if length >= depth:
            return order
        ordered = key[order]
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(np.concatenate([[True], ordered[1:] != ordered[:-1]]), dtype=np.uint64)
        bits = max(int(n - 1).bit_length(), 1) + 1
        times = 3 if 3 * bits <= 64 else 2
        key = np.zeros(n, np.uint64)
        for k in range(times):
            key <<= np.uint64(bits)
            if k * length < n:
                key[:n - k * length] |= rank[k * length:]
        length *= times


def _rows(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of the intervals, and for each the index of its interval."""
    sizes = high - low
    owner = np.repeat(np.arange(len(low), dtype=low.dtype), sizes)
    ends = np.cumsum(sizes, dtype=low.dtype)
    return np.arange(len(owner), dtype=low.dtype) + (low - ends + sizes)[owner], owner


def equal_classes(text: np.ndarray, left: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, class ends): suffixes between two ends share their first `length` symbols.

    `text` holds symbols from 1 up with 0 as separator, `left` the symbols from each place up to its
    separator. No class reaches over a separator: shorter suffixes stand alone.
    """
    n = len(text)
    order = _order(text, length)
    last = text[order - 1]
    by_symbol = np.argsort(last, kind="stable")
    kind = np.int32 if n < 1 << 31 else np.int64
    step = np.empty(n, kind)  # backward extension of a single row
    step[by_symbol] = np.arange(n, dtype=kind)
    same = last[by_symbol[1:]] == last[by_symbol[:-1]]
    following, previous = np.full(n, n, kind), np.full(n, -1, kind)
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    end = np.zeros(n + 1, bool)
    end[[0, n]] = True
    low, high = np.array([0], kind), np.array([n], kind)
    for _ in range(length):
        rows, owner = _rows(low, high)
        real = last[rows] != 0
        rows, owner = rows[real], owner[real]
        # the first and last row with a symbol bound the interval extended by it
        low = np.sort(step[rows[previous[rows] < low[owner]]])
        high = np.sort(step[rows[following[rows] >= high[owner]]]) + 1
        new = ~end[high]
        low, high = low[new], high[new]
        end[high] = True
        if not len(low):
            break
    short = np.flatnonzero(left[order] < length)
    end[short] = end[short + 1] = True
    return order, np.flatnonzero(end[:n])


def smallest_owner(contents: list[bytes], owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `length` bytes in each text: the smallest owner of a text that holds it.

    Returns the windows' values one text after another, and where each text's windows begin.
    """
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    ends = np.cumsum(sizes + 1)
    joined = np.frombuffer(b"\0".join(contents) + b"\0", np.uint8)
    used = np.zeros(256, bool)
    used[joined] = True
    used[0] |= True
    place = ends - 1
    code = np.cumsum(used).astype(np.uint8)  # UTF-8 leaves byte values free, so 0 stays for separators
    text = code[joined]
    text[place] = 0
    which = np.repeat(np.arange(len(contents)), sizes + 1)
    left = place[which] - np.arange(len(text))
    order, starts = equal_classes(text, left, length)
    low = np.minimum.reduceat(owner[which][order], starts)
    value = np.empty(len(text), np.int64)
    value[order] = np.repeat(low, np.diff(np.append(starts, len(text))))
    begins = np.concatenate([[0], np.cumsum(np.maximum(sizes - length + 1, 0))])
    return value[left >= length], begins
