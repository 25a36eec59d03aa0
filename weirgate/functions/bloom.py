"""Bloom filters over 64-bit key hashes, as byte strings that travel in a binary column.

``bits_for`` sizes a filter by the number of its keys, ``made`` builds one and ``may_hold`` looks many hashes up at once. All of
them work on arrays inside tasks. A filter says "no" for certain and "yes" for all its keys and about one other key in a hundred.
"""

from __future__ import annotations

import numpy as np

PROBES, BITS_PER_KEY = 6, 10


def bits_for(keys: int) -> int:
    return max(64, (max(keys, 1) * BITS_PER_KEY + 63) // 64 * 64)


def _places(hashes: np.ndarray, bits: int):
    """Two halves of a mixed hash give all probes."""
    mixed = hashes.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    step = (mixed * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    for probe in range(PROBES):
        place = mixed + np.uint64(probe) * step
        place ^= place >> np.uint64(29)
        yield (place % np.uint64(bits)).astype(np.int64)


def made(hashes: np.ndarray, bits: int | None = None) -> bytes:
    """A filter of these hashes."""
    bits = bits or bits_for(len(hashes))
    held = np.zeros(bits, np.uint8)
    for place in _places(hashes, bits):
        held[place] = 1
    return np.packbits(held, bitorder="little").tobytes()


def may_hold(filter_: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which hashes the filter may hold."""
    held = np.frombuffer(filter_, np.uint8)
    out = np.ones(len(hashes), bool)
    for place in _places(hashes, len(held) * 8):
        out &= (held[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return out
