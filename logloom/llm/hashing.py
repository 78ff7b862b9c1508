"""Vectorised hashes of words and byte strings, for use inside Arrow tasks.

All figures are taken modulo 2**64. A byte string b0..bn has the polynomial
hash sum(b[i] * P**i); as P is odd, prefix sums give the hash of every
substring by one subtraction and one multiplication with a power of 1/P, and a
final mixing step spreads the bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Odd multipliers, any odd values would do.
P = 0x9E3779B97F4A7C15 | 1
P_INVERSE = pow(P, -1, 1 << 64)
#: Texts are hashed together in chunks of about this many bytes.
CHUNK = 1 << 20
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1)."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        p = np.full(max(n, 2 * CHUNK), base, dtype=np.uint64)
        p[0] = 1
        have = np.cumprod(p, dtype=np.uint64)
        if len(have) <= 4 * CHUNK:  # a longer table is not kept
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial: one more entry than ``data`` has bytes."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(P, len(data)), out=out[1:])
    return out


def substrings(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hashes of data[start:end]; the length takes part."""
    inv = powers(P_INVERSE, len(sums))
    return mix((sums[end] - sums[start]) * inv[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def chunks(texts: list, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes (one text at least)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def runs(is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], is_word.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def words(texts: list[bytes], is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and for each text the index
    of its first word (one more entry than texts). ``is_word`` has 256 flags;
    byte 0 must not be a word byte here."""
    data = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    start, end = runs(is_word[data])
    bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
    return substrings(prefix(data), start, end), np.searchsorted(start, bounds)


def flags(spaces: bytes) -> np.ndarray:
    out = np.ones(256, dtype=bool)
    out[list(spaces)] = False
    return out


#: Words as the contracts have them: runs of anything but white space.
NOT_SPACE = flags(b" \t\n\x0b\f\r")


def windows(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``n`` words that stay inside a text, and the
    index of the first window of each text. A text with one to n-1 words has
    one window, of all its words."""
    count = np.diff(first)
    per = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    at = np.concatenate(([0], np.cumsum(per)))
    text = np.repeat(np.arange(len(count)), per)
    start = first[:-1][text] + (np.arange(at[-1]) - at[:-1][text])
    length = np.minimum(count, n)[text]
    out = np.zeros(len(start), dtype=np.uint64)
    for k in range(n):
        has = length > k
        out[has] = mix(out[has] * np.uint64(P) + hashes[start[has] + k] + np.uint64(k + 1))
    return out, at
