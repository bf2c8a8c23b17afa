"""The binary Golay code [23, 12], as lookup tables over arrays of 23-bit words."""

from functools import cache
from itertools import combinations

import numpy as np

LENGTH, CHECKS = 23, 11
# Fixed value: generator polynomial x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101


def _remainder(word: int) -> int:
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> bit & 1:
            word ^= GENERATOR << (bit - CHECKS)
    return word


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainder of the upper 12 bits; error of each syndrome; nearby codewords of each syndrome."""
    upper = np.array([_remainder(high << CHECKS) for high in range(1 << 12)], np.int64)
    single = [_remainder(1 << bit) for bit in range(LENGTH)]
    error = np.zeros(1 << CHECKS, np.int64)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            syndrome = 0
            for bit in bits:
                syndrome ^= single[bit]
            error[syndrome] = sum(1 << bit for bit in bits)
    near = np.zeros((1 << CHECKS, 6), np.int64)
    for syndrome in range(1 << CHECKS):
        own = int(error[syndrome]) >> CHECKS
        flipped = {((1 << b) ^ int(error[syndrome ^ single[b]])) >> CHECKS for b in range(LENGTH)}
        masks = [own, *sorted(flipped - {own})]
        near[syndrome] = masks + [own] * (6 - len(masks))
    return upper, error, near


def nearby_codewords(words: np.ndarray) -> np.ndarray:
    """Six 12-bit indices of codewords for each word: first the one it decodes to, then those that
    a single flipped bit makes it decode to (the first again where there are fewer).

    The code is perfect: every word decodes. Words that differ in two bits or
    fewer have an index in common, by the word between them.
    """
    upper, _, near = _tables()
    words = words.astype(np.int64)
    syndrome = upper[words >> CHECKS] ^ (words & ((1 << CHECKS) - 1))
    return (words >> CHECKS)[:, None] ^ near[syndrome]
