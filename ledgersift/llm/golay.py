"""Keys from the binary Golay code: words that differ in at most two bits share one.

The (23, 12) Golay code is perfect: each 23-bit word is within three bits of exactly one
codeword. The keys of a word are the numbers of the codewords nearest to it and to its 23
one-bit neighbours: one key, or six. Two words two bits apart have a neighbour in common,
and so a key.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np

LENGTH, CHECK_BITS = 23, 11
GENERATOR = 0b110001110101  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1


def _remainder(word: int) -> int:
    for shift in range(LENGTH - 1, CHECK_BITS - 1, -1):
        if word >> shift & 1:
            word ^= GENERATOR << (shift - CHECK_BITS)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainder of each single bit, and the error pattern of each remainder."""
    single = np.array([_remainder(1 << i) for i in range(LENGTH)], dtype=np.uint32)
    pattern = np.zeros(1 << CHECK_BITS, dtype=np.uint32)
    for weight in (1, 2, 3):
        for bits in combinations(range(LENGTH), weight):
            rest = 0
            for b in bits:
                rest ^= int(single[b])
            pattern[rest] = sum(1 << b for b in bits)
    return single, pattern


SINGLE_REST, ERROR_PATTERN = _tables()


def codeword_numbers(words: np.ndarray) -> np.ndarray:
    """For each word, a row of 24 codeword numbers, sorted; they repeat where keys coincide."""
    single, pattern = SINGLE_REST, ERROR_PATTERN
    words = words.astype(np.uint32)
    rest = np.zeros(words.shape, dtype=np.uint32)
    for i in range(LENGTH):
        rest ^= np.where(words >> i & 1, single[i], 0).astype(np.uint32)
    flips = np.concatenate([[0], np.uint32(1) << np.arange(LENGTH, dtype=np.uint32)]).astype(np.uint32)
    flip_rest = np.concatenate([[0], single]).astype(np.uint32)
    near = words[:, None] ^ flips
    return np.sort((near ^ pattern[rest[:, None] ^ flip_rest]) >> CHECK_BITS, axis=1)


def segment_keys(segments: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys of fingerprints cut into segments of at most 22 bits.

    A key says: segment i exactly, and one codeword number of the next segment. If so few
    bits differ that some segment has no error and its successor at most two, a key is shared.
    """
    count = segments.shape[1]
    rows, keys = [], []
    for i in range(count):
        numbers = codeword_numbers(segments[:, (i + 1) % count])
        new = np.ones(numbers.shape, dtype=bool)
        new[:, 1:] = numbers[:, 1:] != numbers[:, :-1]
        row, at = np.nonzero(new)
        key = (np.int64(i) << 34) | (segments[row, i].astype(np.int64) << 12) | numbers[row, at].astype(np.int64)
        rows.append(row)
        keys.append(key)
    return np.concatenate(rows), np.concatenate(keys)
