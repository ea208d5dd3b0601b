"""64-bit hashes of the words of many texts, computed on whole byte buffers.

A word's hash is the sum of a random 64-bit value for each byte times a power
of an odd base, modulo 2**64, passed through a mixing step. It depends on the
bytes alone, so every executor computes the same one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240131))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BYTE_LOWER = _BYTE[_LOWER]
SEGMENT = 2_000_000      # bytes hashed at once; bounds the working arrays


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on all input bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _segments(buf: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of the buffer at white space, each about SEGMENT bytes."""
    lo = 0
    while lo < len(buf):
        hi = min(len(buf), lo + SEGMENT)
        while hi < len(buf) and not _IS_WHITE[buf[hi]]:
            ahead = np.flatnonzero(_IS_WHITE[buf[hi:hi + SEGMENT]])
            hi = hi + int(ahead[0]) if len(ahead) else min(len(buf), hi + SEGMENT)
        yield lo, hi
        lo = hi


def word_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all words, in order, A-Z lower-cased; offsets: the words of
    text i are hashes[offsets[i]:offsets[i + 1]]). Null counts as empty."""
    data = [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]
    ends = np.cumsum([len(d) + 1 for d in data], dtype=np.int64)
    buf = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8)
    hashes, firsts = [], []
    for lo, hi in _segments(buf):
        part = buf[lo:hi]
        solid = ~_IS_WHITE[part]
        edge = np.diff(np.concatenate(([False], solid, [False])).astype(np.int8))
        starts = np.flatnonzero(edge == 1)
        if not len(starts):
            continue
        lengths = np.flatnonzero(edge == -1) - starts
        at = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        place = np.arange(int(lengths.sum())) - np.repeat(at, lengths)
        powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, dtype=np.uint64))
        hashes.append(mix(np.add.reduceat(_BYTE_LOWER[part[solid]] * powers[place], at)))
        firsts.append(starts + lo)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(data) + 1, np.int64)
    where = np.concatenate(firsts)
    return np.concatenate(hashes), np.concatenate(([0], np.searchsorted(where, ends))).astype(np.int64)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word windows (Karp-Rabin: a polynomial over the words)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for j in range(n):
        out = out * _BASE + hashes[j:len(hashes) - n + 1 + j]
    return mix(out)
