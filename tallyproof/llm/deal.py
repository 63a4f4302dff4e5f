"""Numbers that Spark's hash partitioning spreads evenly: one for each partition."""

from __future__ import annotations

import numpy as np

_M = np.uint32


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return x << _M(by) | x >> _M(32 - by)


def partition(numbers: np.ndarray, n: int) -> np.ndarray:
    """The partition, of n, of rows dealt by a long column (Murmur3 with Spark's seed)."""
    numbers = numbers.astype(np.uint64)
    h = np.full(len(numbers), 42, np.uint32)
    with np.errstate(over="ignore"):
        for half in (numbers.astype(np.uint32), (numbers >> np.uint64(32)).astype(np.uint32)):
            h = _turned(h ^ _turned(half * _M(0xCC9E2D51), 15) * _M(0x1B873593), 13) * _M(5) + _M(0xE6546B64)
        h ^= _M(8)
        h = (h ^ h >> _M(16)) * _M(0x85EBCA6B)
        h = (h ^ h >> _M(13)) * _M(0xC2B2AE35)
        h ^= h >> _M(16)
    return h.view(np.int32).astype(np.int64) % n


def labels(n: int) -> np.ndarray:
    """The least number that goes to each of n partitions; dealt by them, as many buckets never meet in one."""
    upto = 32 * n + 1000
    while True:
        numbers = np.arange(upto)
        found, first = np.unique(partition(numbers, n), return_index=True)
        if len(found) == n:
            return numbers[first]
        upto *= 2
