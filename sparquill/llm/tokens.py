"""Words and their hashes for whole Arrow columns of texts, with numpy and without a Python object per word.

Words are runs of bytes other than the six ASCII white-space bytes, which is the same for UTF-8 as for code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time; a single longer text or word takes what it needs.
SEGMENT = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)
GAP = np.zeros(256, bool)
GAP[[9, 10, 11, 12, 13, 32]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_powers: dict[str, np.ndarray] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SEGMENT)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 2 * SEGMENT:
            _powers[name] = have
    return have[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    column = pa.array(column.fill_null(""), pa.large_string()) if not pa.types.is_large_string(column.type) else column.fill_null("")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None and raw[2].size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of at most ``SEGMENT`` bytes, or of one row."""
    data, offsets = buffers(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SEGMENT, side="right")) - 1)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the maximal runs without a byte of ``gap``; no run crosses a row."""
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + SEGMENT, side="right")))
        a, b = int(starts[lo]), int(ends[hi - 1])
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * _power("base", BASE, b - a), out=total[1:])
        s, e = starts[lo:hi] - a, ends[lo:hi] - a
        raw = (total[e] - total[s]) * _power("inverse", BASE_INVERSE, b - a + 1)[s]
        out[lo:hi] = mixed(raw ^ ((e - s).astype(np.uint64) * STEP))
        lo = hi
    return out


def windows(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``n`` words that stay in one row, and the index of their first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = len(h) - n + 1
    out = np.zeros(m, np.uint64)
    for k in range(n):
        out = out * STEP + h[k : k + m]
    first = np.flatnonzero(row[:m] == row[n - 1 :])
    return mixed(out[first]), first


def repeats(key: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key within its row: whether it comes again anywhere in the row, and whether it came before."""
    key = mixed(key ^ (row.astype(np.uint64) * BASE))
    order = np.argsort(key, kind="stable")  # the first in the text is the first of its run
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    if len(k) > 1:
        same[1:-1] = k[1:] == k[:-1]
    again, before = np.empty(len(k), bool), np.empty(len(k), bool)
    again[order] = same[:-1] | same[1:]
    before[order] = same[:-1]
    return again, before


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set in each row's stretch."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
