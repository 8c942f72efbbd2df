"""Words, lines and hashes of them, for all texts of an Arrow batch at once."""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {_BASE: np.ones(1, np.uint64), _BASE_INVERSE: np.ones(1, np.uint64)}


def _power_table(base: int, n: int) -> np.ndarray:
    if len(_powers[base]) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        _powers[base] = np.cumprod(table, dtype=np.uint64)
    return _powers[base][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z, all other bytes as they are."""
    return np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data).astype(np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each maximal run of other than white-space bytes; no run spans two texts."""
    solid = ~WHITE[data]
    before = np.r_[False, solid[:-1]]
    before[offsets[:-1][offsets[:-1] < len(data)]] = False
    after = np.r_[solid[1:], False] if len(data) else solid
    ends = offsets[1:][offsets[1:] > 0] - 1
    after[ends] = False
    return np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span, by differences of one running polynomial."""
    # In place: a very long text stands alone, and each array here is eight times its size.
    running = np.zeros(len(data) + 1, np.uint64)
    terms = running[1:]
    terms[:] = data
    terms += np.uint64(1)
    terms *= _power_table(_BASE, len(data))
    np.cumsum(terms, out=terms)
    value = (running[ends] - running[begins]) * _power_table(_BASE_INVERSE, len(data) + 1)[begins]
    return mixed(value + (ends - begins).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` hashes; empty if there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[i : i + n]
    return mixed(total)


def owners(counts: np.ndarray) -> np.ndarray:
    """For each item its text's index, items of a text standing together."""
    return np.repeat(np.arange(len(counts)), counts)


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the flags of each text."""
    return np.diff(np.r_[0, np.cumsum(flags, dtype=np.int64)][offsets])
