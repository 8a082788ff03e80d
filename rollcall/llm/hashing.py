"""Words of a run of bytes and their 64-bit hashes, computed for whole batches at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Items whose running sums are in memory at once.
_BLOCK = 1 << 18
_powers: dict[str, np.ndarray] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 14)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _powers[name] = np.cumprod(values, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, end and row of every maximal run, within a row, of bytes for which inside[byte] holds."""
    member = inside[data]
    before = np.zeros(len(data), bool)
    before[1:] = member[:-1]
    firsts = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[firsts] = False
    after = np.zeros(len(data), bool)
    after[:-1] = member[1:]
    after[offsets[1:][offsets[:-1] < offsets[1:]] - 1] = False
    starts = np.flatnonzero(member & ~before)
    ends = np.flatnonzero(member & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:end] for each range; starts and ends ascend, and ranges may overlap."""
    out = np.zeros(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(starts, base + _BLOCK)))
        last = int(ends[at:stop].max())
        up, down = _powers_to(last - base + 1)
        sums = np.zeros(last - base + 1, np.uint64)
        np.cumsum((data[base:last].astype(np.uint64) + np.uint64(1)) * up[: last - base], out=sums[1:])
        s, e = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = stop
    return out


def window_hashes(items: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of length items (hashes themselves); entry i starts at item i."""
    n = len(items) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for at in range(0, n, _BLOCK):
        part = items[at : min(at + _BLOCK, n) + length - 1]
        up, down = _powers_to(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[at : at + _BLOCK] = mix((sums[length:] - sums[:-length]) * down[: len(part) - length + 1])
    return out


def spread_hashes(items: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of items[start:start + length] for ranges in any order; the items are few enough to be summed at once."""
    up, down = _powers_to(len(items) + 1)
    sums = np.zeros(len(items) + 1, np.uint64)
    np.cumsum((items.astype(np.uint64) + np.uint64(1)) * up[: len(items)], out=sums[1:])
    return mix((sums[starts + lengths] - sums[starts]) * down[starts] + lengths.astype(np.uint64))
