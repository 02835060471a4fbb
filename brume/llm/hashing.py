"""Rolling hashes of byte ranges, for whole batches of texts at once."""

from __future__ import annotations

import functools

import numpy as np

_BASE = np.uint64(0x1E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) >> np.uint64(4)


PRIME = np.uint64((1 << 61) - 1)
_LEAST, _MOST = (1 << 20) + (1 << 16), 1 << 22
_held: list[tuple[np.ndarray, np.ndarray]] = []


def _reduced(x: np.ndarray) -> np.ndarray:
    """x modulo the prime, up to one prime too much."""
    return (x & PRIME) + (x >> np.uint64(61))


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    middle = a1 * b0
    middle += a0 * b1
    a1 *= b1
    a1 <<= np.uint64(1)
    a0 *= b0
    a0 = _reduced(a0)
    a0 += a1
    a0 += middle >> np.uint64(30)
    middle &= np.uint64((1 << 30) - 1)
    middle <<= half
    a0 += middle
    out = _reduced(a0)
    out -= PRIME * (out >= PRIME)
    return out


_PART = 1 << 13  # values at a time: what is between then stays in the processor's cache


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of values of at most the prime; `b` may be a single one."""
    out = np.empty(len(a), np.uint64)
    for i in range(0, len(a), _PART):
        out[i : i + _PART] = _times(a[i : i + _PART], b if b.ndim == 0 else b[i : i + _PART])
    return out


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    done, step = 1, base % int(PRIME)
    while done < n:  # what is there, times the power that lies that far on
        more = min(done, n - done)
        out[done : done + more] = times(out[:more], np.uint64(step))
        step = step * step % int(PRIME)
        done += more
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; a table is kept unless it is very long."""
    if not _held or len(_held[0][0]) < n:
        size = max(n, _LEAST)
        up, down = _power_table(int(_BASE), size), _power_table(pow(int(_BASE), -1, int(PRIME)), size)
        if size > _MOST:
            return up, down
        _held[:] = [(up, down)]
    return _held[0]


class ByteHashes:
    """Hashes of any byte ranges of `data`, by a polynomial modulo the prime 2^61 - 1: equal bytes give equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        terms = times(_byte_values()[data], up[: len(data)])
        self.sums = np.zeros(len(data) + 1, np.uint64)
        low = np.cumsum(terms & np.uint64(0xFFFFFFFF))
        terms >>= np.uint64(32)
        high = np.cumsum(terms)
        high = times(high, np.uint64(1 << 32))
        high += _reduced(low)
        high = _reduced(high)
        self.sums[1:] = high - PRIME * (high >= PRIME)

    def _between(self, low: np.ndarray, high: np.ndarray, down: np.ndarray) -> np.ndarray:
        raw = high + PRIME
        raw -= low
        return times(_reduced(raw), down)

    def ranges(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return mix(self._between(self.sums[starts], self.sums[stops], self.down[starts]) ^ ((stops - starts).astype(np.uint64) << np.uint64(32)))

    def windows(self, length: int) -> np.ndarray:
        """Hashes of all windows of one length, without the length that `ranges` mixes in."""
        n = len(self.sums) - length
        return mix(self._between(self.sums[:n], self.sums[length:], self.down[:n])) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window, by minima from the left and the right of blocks of that width."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - width + 1], left[width - 1 : n])
