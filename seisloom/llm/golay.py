"""The perfect binary Golay code (23, 12, 7), vectorised over arrays of words."""

from __future__ import annotations

from itertools import combinations

import numpy as np

GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _rest(v: int) -> int:
    for i in range(22, 10, -1):
        if v >> i & 1:
            v ^= GENERATOR << (i - 11)
    return v


_HIGH = np.array([_rest(d << 11) for d in range(4096)], dtype=np.int64)
#: the error of weight 3 or less that has a syndrome
_LEADER = np.zeros(2048, dtype=np.int64)
for _n in (1, 2, 3):
    for _bits in combinations(range(23), _n):
        _e = sum(1 << b for b in _bits)
        _LEADER[_rest(_e)] = _e


def syndrome(v: np.ndarray) -> np.ndarray:
    return _HIGH[v >> 11] ^ (v & 2047)


def decode(v: np.ndarray) -> np.ndarray:
    """Index (12 data bits) of the codeword nearest to each 23-bit word."""
    return (v ^ _LEADER[syndrome(v)]) >> 11


def near_indices(v: np.ndarray, bits: int = 23) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the words within one flip of the low ``bits`` bits of each word,
    as (n, 6) and a mask of those that count. Two words that differ in two of
    these bits at most have the word between them in common, hence an index."""
    flips = np.concatenate([[0], 1 << np.arange(bits)]).astype(np.int64)
    near = v[:, None] ^ flips[None, :]
    s = syndrome(v)[:, None] ^ syndrome(flips)[None, :]
    found = np.sort((near ^ _LEADER[s]) >> 11, axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    order = np.argsort(~new, axis=1, kind="stable")[:, :6]
    return np.take_along_axis(found, order, 1), np.take_along_axis(new, order, 1)
