"""Hashes of byte ranges and words for whole batches of text at once."""

from __future__ import annotations

import numpy as np

_random = np.random.default_rng(29)
BYTE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
STEP = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: list[tuple[np.ndarray, np.ndarray]] = []


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on; ``size`` is a power of two."""
    x, k = BYTE[data], 1
    while k < size:
        x = x[:-k] * np.uint64(pow(int(STEP), k, 1 << 64)) + x[k:]
        k *= 2
    return mixed(x)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64; kept for the next batches, which may be a little longer."""
    if not _powers or len(_powers[0][0]) <= n:
        inverse = np.uint64(pow(int(STEP), -1, 1 << 64))
        size = max(n + 1, 1 << 20) + (1 << 16)
        _powers[:] = [tuple(np.cumprod(np.full(size, x, dtype=np.uint64)) for x in (STEP, inverse))]
    return _powers[0]


def digests(data: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """A hash of the bytes from each ``lo`` up to ``hi``; equal for equal bytes."""
    up, down = _power_tables(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.take(BYTE, data, out=total[1:], mode="clip")  # of bytes none is clipped; the default mode copies
    total[1:] *= up[: len(data)]
    np.cumsum(total, out=total)
    return mixed((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, number of the text and number of the line within it of every word; A-Z count as a-z.

    Words are runs of bytes other than blank and 0x09 - 0x0D; 0x0A ends a line.
    """
    data = _LOWER.take(np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8), mode="clip")
    inside = ~_SPACE.take(data, mode="clip")
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate((np.zeros(1, dtype=np.int64), edge))
    lo, hi = edge[::2], edge[1::2]  # the text ends with a line end, so every word ends
    sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1
    ends = np.cumsum(sizes)
    breaks = np.flatnonzero(data == 10)
    # Words lie close, ends of texts and lines far apart: these are looked up among the words.
    text = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(lo, ends), prepend=0))
    line = np.repeat(np.arange(len(breaks)), np.diff(np.searchsorted(lo, breaks), prepend=0))
    line -= np.searchsorted(breaks, ends - sizes)[text]
    return digests(data, lo, hi), text, line
