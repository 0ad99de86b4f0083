"""Static binary fuse filters (3-wise, 8-bit fingerprints) over 64-bit digests, in numpy.

Built after the published construction: three slots per key in consecutive segments; keys
are peeled from slots that hold one key only, and fingerprints are assigned in reverse.
A key of the set always passes; another one passes with probability 1/256.
"""

from __future__ import annotations

import math

import numpy as np

_U = np.uint64


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + _U(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> _U(shift))) * _U(factor)
    return h ^ (h >> _U(33))


def _layout(n: int) -> tuple[int, int]:
    """(segment length, segments a key can start in) for n keys."""
    length = min(1 << 18, 1 << int(math.log(max(n, 2)) / math.log(3.33) + 2.25))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(max(n, 2)))
    return length, max(1, -(-round(n * factor) // length) - 2)


def _slots(h: np.ndarray, length: int, segments: int) -> np.ndarray:
    first = ((h >> _U(32)) * _U(segments * length)) >> _U(32)
    mask = _U(length - 1)
    second = (first + _U(length)) ^ ((h >> _U(18)) & mask)
    third = (first + _U(2 * length)) ^ (h & mask)
    return np.stack([first, second, third]).astype(np.int64)


def _fingerprint(h: np.ndarray) -> np.ndarray:
    return (h ^ (h >> _U(32))).astype(np.uint8)


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, table) over distinct keys."""
    keys = np.unique(keys.astype(np.uint64, copy=False))
    length, segments = _layout(len(keys))
    size = (segments + 2) * length
    for seed in range(1, 1000):
        h = _mix(keys, seed)
        slots = _slots(h, length, segments)
        count = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the key numbers in a slot
        for s in slots:
            np.bitwise_xor.at(held, s, np.arange(len(keys)))
        waves, left = [], len(keys)
        ready = np.flatnonzero(count == 1)
        while len(ready):
            key, at = np.unique(held[ready], return_index=True)
            slot = ready[at]
            waves.append((key, slot))
            left -= len(key)
            touched = slots[:, key]
            np.subtract.at(count, touched.ravel(), 1)
            for s in touched:
                np.bitwise_xor.at(held, s, key)
            touched = np.unique(touched.ravel())
            ready = touched[count[touched] == 1]
        if left:
            continue
        table, prints = np.zeros(size, np.uint8), _fingerprint(h)
        for key, slot in reversed(waves):
            a, b, c = slots[:, key]
            table[slot] = 0
            table[slot] = prints[key] ^ table[a] ^ table[b] ^ table[c]
        return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed lets the filter be built")


def contains(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    h = _mix(keys.astype(np.uint64, copy=False), seed)
    t = np.frombuffer(table, np.uint8)
    a, b, c = _slots(h, length, segments)
    return (t[a] ^ t[b] ^ t[c]) == _fingerprint(h)
