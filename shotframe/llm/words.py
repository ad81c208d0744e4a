"""Words of UTF-8 buffers and 64-bit hashes of words and word shingles, in numpy.

A word's hash is a polynomial over random 64-bit values of its bytes, modulo
2**64; prefix sums give it for all words of a buffer at once, without a
Python object per word.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
BYTE_VALUE = _RNG.integers(1, 2**64 - 1, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RNG.integers(1, 2**63, dtype=np.uint64)) * 2 + 1
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_SHINGLE = _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: White space between words: space and 0x09 to 0x0D.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: All ASCII but letters and digits.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[128:] = False
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    NOT_ALNUM[_low:_high] = False

#: All ASCII but letters.
NOT_LETTER = NOT_ALNUM.copy()
NOT_LETTER[48:58] = True

_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads each input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n, kept per process."""
    if len(_powers.get("up", ())) < n + 1:
        size = max(n + 1, 1 << 20)
        for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A hash of each span of a buffer; ``values`` are the random numbers of the bytes 0 to 255."""
    up, down = _power_table(len(buf))
    sums = np.empty(len(buf) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(values[buf] * up[:len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray, lower: bool = True) -> tuple[np.ndarray, ...]:
    """Words of each text of a buffer, A-Z lower-cased unless ``lower`` is false.

    Returns ``(hashes, first, starts, ends)``: one hash per word; the words of
    text i are ``first[i]:first[i + 1]``; byte positions of each word.
    """
    n = len(buf)
    if n == 0:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64), none, none
    inside = ~separators[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    hashes = span_hashes(buf, starts, ends, BYTE_VALUE[_LOWER] if lower else BYTE_VALUE)
    return hashes, np.searchsorted(starts, offsets), starts, ends


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int = 5):
    """Sorted distinct shingle hashes of each text, in turn.

    A text with fewer than ``size`` words has its whole sequence as the one
    shingle; a text without words has none.
    """
    n = len(hashes)
    whole = np.zeros(0, np.uint64)
    if n >= size:
        whole = hashes[: n - size + 1] * _SHINGLE[0]
        for k in range(1, size):
            whole = whole + hashes[k: n - size + 1 + k] * _SHINGLE[k]
        whole = mix(whole)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= size:
            yield np.unique(whole[a: b - size + 1])
        elif b > a:
            x = np.uint64(b - a) + (hashes[a:b] * _SHINGLE[size: size + b - a]).sum(dtype=np.uint64)
            yield mix(np.array([x], dtype=np.uint64))
        else:
            yield hashes[:0]
