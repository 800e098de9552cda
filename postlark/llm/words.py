"""Words of whole Arrow batches: where they lie, and 64-bit hashes of words and word windows.

Everything works on the UTF-8 bytes of many texts at once. A word is a longest run of bytes other
than space, tab, line feed, vertical tab, form feed and carriage return.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

# Texts are taken together until they have this many bytes, so that work arrays stay small. A
# longer text is taken alone and whole.
CHUNK_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C55
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those for the usual chunk are kept."""
    if n <= CHUNK_BYTES:
        if 0 not in _cache:
            _cache[0] = (_powers(_BASE, CHUNK_BYTES), _powers(pow(_BASE, -1, 1 << 64), CHUNK_BYTES))
        return _cache[0]
    return _powers(_BASE, n), _powers(pow(_BASE, -1, 1 << 64), n)


def chunks(texts: pa.Array, size: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of rows as (first row, bytes, offsets); a null text is empty."""
    if pa.types.is_large_string(texts.type) is False:
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[
        texts.offset : texts.offset + len(texts) + 1
    ]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        own = offsets[first : last + 1]
        yield first, data[own[0] : own[-1]], own - own[0]
        first = last


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of every word."""
    inside = ~SPACE[buf]
    edge = np.zeros(len(buf) + 1, dtype=bool)
    edge[offsets] = True
    before = np.ones(len(buf), dtype=bool)
    before[1:] = ~inside[:-1]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    after = np.ones(len(buf), dtype=bool)
    after[:-1] = ~inside[1:]
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    return np.searchsorted(offsets, starts, side="right") - 1, starts, ends


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    powers, inverse = _power_tables(len(buf))
    sums = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[buf] * powers[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def window_hashes(hashes: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word, and hash, of every window of ``k`` words of one row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + hashes[j : j + n]
    at = np.flatnonzero(rows[:n] == rows[k - 1 :])
    return at, mix(total[at])


def with_row(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Hashes that differ between rows, to group within rows by one value."""
    return mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1)))


def row_sums(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set bytes of each row."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]
