"""Suffix arrays by induced sorting, and common prefixes of neighbours, for one shard of text.

Suffixes are classified as smaller (S) or larger (L) than the next one. The leftmost of each run of
S are the leftmost-smaller (LMS) suffixes. Substrings from one LMS suffix to the next are named by
their order, and names are ranked again in pairs, then fours and so on, until their suffixes are in
order for a given depth. The order of all other suffixes is induced from them: from small to large
characters for L, back for S. Each step takes all suffixes of a character at once.

The common prefix of a suffix with its predecessor in the array is computed in text order, where it
is at most one shorter than that of the suffix before: only where the characters before differ is it
measured, and elsewhere it follows.
"""

from __future__ import annotations

import numpy as np

# Symbols of a leftmost-smaller substring that go into one number.
_PACKED = 6


def types(text: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the next one. The last character must be the smallest."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    out = np.empty(n, dtype=bool)
    out[-1] = True
    # A run of equal characters has the type of its last one.
    rising = text[change] < text[change + 1]
    which = np.searchsorted(change, np.arange(n - 1))
    known = which < len(change)
    out[: n - 1][known] = rising[which[known]]
    out[: n - 1][~known] = False
    return out


def leftmost_smaller(
    text: np.ndarray, smaller: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """The LMS positions in the order of their suffixes, as far as ``depth`` characters tell.

    The second array has those that this leaves in no order among each other.
    """
    starts = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    symbols = np.zeros(len(text) + _PACKED, dtype=np.int64)
    # Of equal characters the larger suffix is the S one; 0 is beyond the substring.
    symbols[: len(text)] = text.astype(np.int64) * 2 + smaller + 1
    ends = np.append(starts[1:], len(text) - 1)
    # A long substring is several places, each of a few symbols.
    parts = np.maximum(-(-(ends - starts) // _PACKED), 1)
    first = np.concatenate([[0], np.cumsum(parts)])
    places = np.repeat(starts, parts) + _PACKED * (
        np.arange(first[-1]) - np.repeat(first[:-1], parts)
    )
    stop = np.repeat(ends, parts)
    key = np.zeros(len(places), dtype=np.int64)
    for k in range(_PACKED):
        key = (key << 10) | np.where(places + k <= stop, symbols[places + k], 0)
    rank = np.unique(key, return_inverse=True)[1] + 1
    after = np.arange(1, len(places) + 1)
    rank = np.append(rank, 0)
    after = np.append(np.minimum(after, len(places)), len(places))
    reach = 2
    while reach < depth and rank.max() < len(places):
        pair = rank * (len(places) + 1) + rank[after]
        rank = np.append(np.unique(pair[:-1], return_inverse=True)[1] + 1, 0)
        after = after[after]
        reach *= 2
    own = rank[first[:-1]]
    tied = np.bincount(own, minlength=2)[own] > 1
    return starts[np.argsort(own, kind="stable")], starts[tied]


def _dealt(entries: list[np.ndarray], text: np.ndarray, c: int, up: bool, into: list) -> None:
    """Put the predecessors of a character's suffixes, in order, to their own characters."""
    before = np.concatenate(entries) - 1
    before = before[before >= 0]
    chars = text[before]
    chosen = chars > c if up else chars < c
    before, chars = before[chosen], chars[chosen]
    order = np.argsort(chars, kind="stable")
    before, chars = before[order], chars[order]
    cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
    if len(before):
        for own in np.split(before, cuts):
            into[text[own[0]]].append(own)


def _with_equal(entries: list[np.ndarray], text: np.ndarray, c: int) -> list[np.ndarray]:
    """Entries, then their predecessors with the same character, then theirs, and so on."""
    out = [np.concatenate(entries)] if entries else []
    while out and len(out[-1]):
        before = out[-1] - 1
        before = before[before >= 0]
        out.append(before[text[before] == c])
    return out


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """All suffixes in order, as far as ``depth`` characters tell, and the LMS ones left tied.

    ``text`` holds small integers, and ends with a 0 that is smaller than most of what stands
    before it; other zeros may separate parts of it, but no two stand together.
    """
    size = int(text.max()) + 1
    smaller = types(text)
    chosen, tied = leftmost_smaller(text, smaller, depth)
    if not len(chosen) or chosen[0] != len(text) - 1:
        chosen = np.concatenate([[len(text) - 1], chosen[chosen != len(text) - 1]])
    small: list[list[np.ndarray]] = [[] for _ in range(size)]
    by_char = chosen[np.argsort(text[chosen], kind="stable")]
    for own in np.split(by_char, np.flatnonzero(np.diff(text[by_char])) + 1):
        small[text[own[0]]].append(own)
    large: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size):
        large[c] = _with_equal(large[c], text, c)
        if entries := large[c] + small[c]:
            _dealt(entries, text, c, True, large)
    tiny: list[list[np.ndarray]] = [[] for _ in range(size)]
    for c in range(size - 1, -1, -1):
        tiny[c] = _with_equal(tiny[c], text, c)
        if entries := tiny[c] + ([np.concatenate(large[c])[::-1]] if large[c] else []):
            _dealt(entries, text, c, False, tiny)
    tiny[0].append(np.array([len(text) - 1]))
    out = []
    for c in range(size):
        out += large[c]
        if tiny[c]:
            out.append(np.concatenate(tiny[c])[::-1])
    return np.concatenate(out), tied


def common_prefixes(
    text: np.ndarray, array: np.ndarray, tied: np.ndarray, most: int
) -> np.ndarray:
    """For each text position, the length it shares with its predecessor in the suffix array.

    Lengths are exact up to ``most``, counted from the last measured position before it. The order
    of a tied suffix need not agree with that of the suffix before it, so it is measured itself.
    """
    n = len(text)
    previous = np.full(n, -1, dtype=np.int64)
    previous[array[1:]] = array[:-1]
    here = np.arange(n)
    measured = (previous <= 0) | (here == 0)
    rest = ~measured
    measured[rest] = text[here[rest] - 1] != text[previous[rest] - 1]
    # After a separator it is measured again.
    measured[1:] |= text[:-1] == 0
    measured[tied] = True
    padded = np.zeros(n + most + 8, dtype=np.uint64)
    padded[:n] = text
    words = np.zeros(n + most + 8, dtype=np.uint64)
    for k in range(7):
        words[: n + most] |= padded[k : k + n + most] << np.uint64(9 * k)
    places = np.flatnonzero(measured & (previous >= 0))
    shared = np.zeros(n, dtype=np.int64)
    active = places
    for step in range(0, most, 7):
        if not len(active):
            break
        differ = words[active + step] ^ words[previous[active] + step]
        low = differ & (~differ + np.uint64(1))
        bits = np.where(differ == 0, 63, np.log2(np.maximum(low, 1).astype(np.float64)))
        shared[active] += (bits // 9).astype(np.int64)
        active = active[differ == 0]
    last = np.maximum.accumulate(np.where(measured, here, 0))
    return np.maximum(shared[last] - (here - last), 0)
