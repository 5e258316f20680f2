"""Words and word sequences as 64-bit hashes, many texts at a time, with numpy.

A text is UTF-8 bytes; words are runs of bytes other than 0x20 and 0x09-0x0D.
A word's hash sums random odd multipliers per byte value and place; a sequence
hash does the same over the words. ``seed`` gives independent families.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_U = np.uint64
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every input bit over all 64."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd numbers."""
    shift = seed * 0x9E3779B97F4A7C15 % 2**64
    at = np.arange(1, n + 1, dtype=np.uint64) + _U(shift)
    return mix(at * _U(0x9E3779B97F4A7C15)) | _U(1)


@lru_cache(maxsize=8)
def _tables(size: int, seed: int):
    return stream(256, 2 * seed + 1), stream(size, 2 * seed + 2)


def word_hashes(texts: list[bytes], seeds=(0,)):
    """``(hashes per seed, first)``: word hashes of all texts in a row; text ``i`` has
    words ``first[i]:first[i + 1]``."""
    joined = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(joined, dtype=np.uint8)
    inside = ~SPACE[buf]
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[::2], edge[1::2]
    lens = ends - starts
    offsets = np.cumsum([0, *[len(t) + 1 for t in texts]])
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return [np.empty(0, np.uint64) for _ in seeds], first
    chars = buf[inside]
    at = np.cumsum(lens) - lens
    place = np.arange(len(chars)) - np.repeat(at, lens)
    size = 64
    while size < lens.max():
        size *= 4
    out = []
    for seed in seeds:
        value, factor = _tables(size, seed)
        h = np.add.reduceat(value[chars] * factor[place], at)
        out.append(mix(h + lens.astype(np.uint64) * _U(0xD6E8FEB86659FD93)))
    return out, first


def batches(texts: list[bytes], limit: int = 512 << 10):
    """Index ranges of ``texts`` of about ``limit`` bytes each; a long text stands alone."""
    lo = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def rolling(h: np.ndarray, first: np.ndarray, k: int, seed: int = 0):
    """``(hashes, starts)`` of every run of ``k`` words that lies in one text."""
    n = len(h)
    if n < k:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    factor = stream(k, 1000 + seed)
    total = np.zeros(n - k + 1, np.uint64)
    for j in range(k):
        total += h[j : n - k + 1 + j] * factor[j]
    counts = np.diff(first)
    left = np.repeat(first[1:], counts)[: n - k + 1] - np.arange(n - k + 1)
    starts = np.flatnonzero(left >= k)
    return mix(total[starts]), starts


def whole(h: np.ndarray, seed: int = 0) -> int:
    """Hash of a whole sequence of word hashes, its length included."""
    with np.errstate(over="ignore"):
        total = (h * stream(len(h), 2000 + seed)).sum(dtype=np.uint64) + _U(len(h))
    return int(mix(np.array([total], np.uint64))[0])
