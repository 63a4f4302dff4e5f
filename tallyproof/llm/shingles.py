"""Distinct word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

import hashlib

import numpy as np

U = np.uint64
GOLD = U(0x9E3779B97F4A7C15)
_BASE = 0x5DEECE66D2B4A139  # odd, so powers have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + GOLD
        x = (x ^ x >> U(30)) * U(0xBF58476D1CE4E5B9)
        x = (x ^ x >> U(27)) * U(0x94D049BB133111EB)
        return x ^ x >> U(31)


_BYTE = mixed(np.arange(256, dtype=np.uint64))
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z, other letters as they are
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS = (np.ones(1, np.uint64), np.ones(1, np.uint64))
#: Longer words are hashed by a keyed digest: sums of powers modulo 2**64 can be made to collide on long ones.
LONG_WORD = 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers, or more, of the base and of its inverse; kept for the largest size asked for."""
    global _POWERS
    if len(_POWERS[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        with np.errstate(over="ignore"):
            _POWERS = tuple(np.cumprod(np.concatenate([[U(1)], np.full(size - 1, U(b), np.uint64)])) for b in (_BASE, _INVERSE))
    return _POWERS


def forget() -> None:
    """Let the powers go."""
    global _POWERS
    _POWERS = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and how many words lie before each text (one entry more than texts)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([b"", *raw, b""]), np.uint8)
    at = np.cumsum([1, *(len(r) + 1 for r in raw)])
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.concatenate([[U(0)], np.cumsum(_BYTE[data] * up[: len(data)])])
        h = mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    for i in np.flatnonzero(end - start > LONG_WORD).tolist():
        word = _LOWER[data[start[i] : end[i]]].tobytes()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=b"long word").digest(), "little")
    return h, np.searchsorted(start, at)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of ``words`` words; a shorter text is one shingle, one without words none."""
    h, upto = word_hashes(texts)
    out = []
    with np.errstate(over="ignore"):
        factor = [U((_BASE * (2 * i + 1)) & 0xFFFFFFFFFFFFFFFF | 1) for i in range(words)]
        n = len(h) - words + 1
        joint = np.zeros(max(n, 0), np.uint64)
        for i in range(words):
            joint += mixed(h[i : i + n] * factor[i] + U(i)) if n > 0 else joint
        joint = mixed(joint)
        for a, b in zip(upto[:-1].tolist(), upto[1:].tolist()):
            if b - a >= words:
                out.append(np.unique(joint[a : b - words + 1]))
            elif b > a:
                part = sum((mixed(h[a + i : a + i + 1] * factor[i] + U(i)) for i in range(b - a)), np.zeros(1, np.uint64))
                out.append(mixed(part + U(b - a) * GOLD))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def fingerprints(sets: list[np.ndarray], salt: int) -> np.ndarray:
    """A signed 64-bit digest of each set, whatever its order."""
    size = np.array([len(s) for s in sets], np.int64)
    total = np.zeros(len(sets), np.uint64)
    some = np.flatnonzero(size)
    with np.errstate(over="ignore"):
        if len(some):
            total[some] = np.add.reduceat(mixed(np.concatenate(sets) ^ U(salt)), (np.cumsum(size) - size)[some])
        return mixed(total + size.astype(np.uint64) * GOLD).view(np.int64)
