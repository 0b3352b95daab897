"""The perfect binary Golay code of length 23: every 23-bit word is within 3 bits of exactly one of 4,096 codewords."""

from __future__ import annotations

from functools import cache

import numpy as np

LENGTH, DATA, GENERATOR = 23, 12, 0b101011100011


def _remainder(words: np.ndarray) -> np.ndarray:
    r = words.copy()
    for bit in range(LENGTH - 1, LENGTH - DATA, -1):
        r ^= np.where((r >> bit) & 1, GENERATOR << (bit - (LENGTH - DATA)), 0)
    return np.where((r >> (LENGTH - DATA)) & 1, r ^ GENERATOR, r)


@cache
def leaders() -> np.ndarray:
    """The error of at most 3 bits that goes with each of the 2,048 remainders."""
    bits = [1 << k for k in range(LENGTH)]
    errors = [0, *bits]
    errors += [a | b for k, a in enumerate(bits) for b in bits[k + 1 :]]
    errors += [a | b | c for k, a in enumerate(bits) for m, b in enumerate(bits[k + 1 :], k + 1) for c in bits[m + 1 :]]
    errors = np.array(errors, dtype=np.int64)
    out = np.full(1 << (LENGTH - DATA), -1, np.int64)
    out[_remainder(errors)] = errors
    assert len(errors) == len(out) and (out >= 0).all()
    return out


def decode(words: np.ndarray) -> np.ndarray:
    """Index (0 to 4095) of the codeword nearest to each 23-bit word: the data bits of the corrected word."""
    words = words.astype(np.int64)
    return (words ^ leaders()[_remainder(words)]) >> (LENGTH - DATA)


def near(words: np.ndarray, bits: int = LENGTH) -> np.ndarray:
    """The indices to which each word or a word one of its low bits away decodes: (n, bits + 1), repeats as -1.
    Two words two bits apart or less always have one in common: that of a word between them."""
    flips = np.array([0, *(1 << k for k in range(bits))], dtype=np.int64)
    got = decode((words.astype(np.int64)[:, None] ^ flips).ravel()).reshape(len(words), bits + 1)
    got.sort(axis=1)
    got[:, 1:][got[:, 1:] == got[:, :-1]] = -1
    return got
