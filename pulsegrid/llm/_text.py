"""Vectorised word and hash arithmetic on the UTF-8 bytes of one text.

Words are maximal runs of bytes other than space and U+0009 to U+000D; since the
separators are ASCII, this equals the same rule on code points.
"""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(0x5EED).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the hash base modulo 2**64."""
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:n]


def slice_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each slice of an array of symbol hashes, from running sums."""
    n = len(symbols)
    global _inverses
    if len(_inverses) < n:
        steps = np.full(max(n, 2 * len(_inverses)), pow(int(_BASE), -1, 1 << 64), np.uint64)
        steps[0] = 1
        _inverses = np.multiply.accumulate(steps)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * powers(n), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _inverses[starts] + (ends - starts).astype(np.uint64))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def to_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words."""
    inside = np.empty(len(data) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the disjoint, ascending byte spans (none empty)."""
    if not len(starts):
        return np.empty(0, np.uint64)
    lengths = ends - starts
    at = np.arange(int(lengths.sum()), dtype=np.int64)
    first = np.cumsum(lengths) - lengths
    inner = at - np.repeat(first, lengths)
    value = _BYTE[data[inner + np.repeat(starts, lengths)]] * powers(int(lengths.max()))[inner]
    return mix(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def windows_hash(symbols: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of each run of ``width`` consecutive symbol hashes."""
    n = len(symbols) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * _BASE + symbols[k : k + n]
    return mix(out)


def shingles(data: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text.

    With fewer words than ``width`` the whole sequence is the only shingle;
    without words there is none.
    """
    words = span_hashes(data, *word_spans(data))
    if not len(words):
        return words
    k = min(width, len(words))
    return np.unique(windows_hash(words, k) ^ np.uint64(k))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by doubling."""
    n = len(values) - width + 1
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have : width - have + n])
