"""Word hashes and rolling hashes over them, for whole batches of texts, in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Odd multipliers of rolling and mixing hashes (fixed values).
ROLL_A, ROLL_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
MIX_A, MIX_B = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


def word_hashes(texts: list[bytes | None], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of all words, number of words of each text); texts in UTF-8.

    Splitting bytes at white space splits at the space and U+0009 to U+000D only, and
    lower case of bytes changes A to Z only. Hashing a word costs less than looking it up
    in a bounded cache that rare words keep turning over.
    """
    from xxhash import xxh3_64_intdigest

    arrays, counts = [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = (text.lower() if lower else text).split() if text else ()
        counts[i] = len(words)
        if words:
            arrays.append(np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)))
    return np.concatenate(arrays) if arrays else np.zeros(0, np.uint64), counts


def utf8(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit values."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX_A)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX_B)
    return values ^ (values >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of ``width`` neighbours, by the place of its first."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, power = np.zeros(n, np.uint64), 1
    for j in range(width):
        out += hashes[j:j + n] * np.uint64(power)
        power = power * base % (1 << 64)
    return mixed(out)


def places(counts: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of runs 0 to n - 1 over joined texts: the text in which each begins, and whether it ends in it."""
    owner = np.repeat(np.arange(len(counts)), counts)[:n]
    ends = np.cumsum(counts)
    return owner, np.arange(n) + width <= ends[owner] if n else np.zeros(0, bool)


def stretches(chosen: np.ndarray, *same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, length) of runs of neighbouring places among ``chosen`` (ascending) with equal values in ``same``."""
    if not len(chosen):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    new = np.diff(chosen) != 1
    for values in same:
        new |= values[chosen[1:]] != values[chosen[:-1]]
    first = np.flatnonzero(np.concatenate([[True], new]))
    return chosen[first], np.diff(np.concatenate([first, [len(chosen)]]))
