"""Vectorised word and word-run hashes for use inside Arrow tasks.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D of the UTF-8
text.  Hashes are 64-bit: positional sums modulo 2^64 over random byte values,
finished with a bit mixer, so that any run's hash comes from two prefix sums.
Two different runs agree with probability about 2^-64; callers that compare
many runs combine two independent hashes.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_CHUNK = 1 << 20


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up, self.down = np.ones(1, _U), np.ones(1, _U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (_geometric(x, size) for x in (self.base, self.inverse))
        return self.up[:n], self.down[:n]


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, _U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = tuple(_Powers(b) for b in _BASES)


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser; different seeds give independent values."""
    x = x ^ _U((seed * 0xA24BAED4963EE407 + 0x9FB21C651E98DF25) % 2**64)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte starts and ends of the words of a text."""
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[raw], [True]))))
    return edge[::2], edge[1::2]


def _run_hash(values: np.ndarray, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
    up, down = _POWERS[which].upto(len(values) + 1)
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * up[:-1], out=total[1:])
    return (total[end] - total[start]) * down[start] + (end - start).astype(_U)


def words(text: str | None, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, byte start and byte end of each word; ``lower`` folds A-Z first.

    Long texts go through in pieces cut at white space, so memory stays
    proportional to the number of words."""
    raw = np.frombuffer((text or "").encode(errors="surrogatepass"), np.uint8)
    start, end = spans(raw)
    if lower:
        raw = _LOWER[raw]
    if len(raw) <= _CHUNK or len(start) < 2:
        return mix(_run_hash(_BYTE[raw], start, end, 0)), start, end
    parts, at = [], 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + _CHUNK, side="right")))
        base = start[at]
        parts.append(mix(_run_hash(_BYTE[raw[base : end[to - 1]]], start[at:to] - base, end[at:to] - base, 0)))
        at = to
    return np.concatenate(parts), start, end


def windows(word_hash: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (none for shorter texts)."""
    n = len(word_hash) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    at = np.arange(n)
    return mix(_run_hash(word_hash, at, at + size, which), size + 1000 * which)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased text's ``size``-word shingles.

    A text with fewer words has its whole sequence as the one shingle; a text
    without words has none."""
    h, _, _ = words(text, lower=True)
    if not len(h):
        return h
    return np.unique(windows(h, min(size, len(h))))
