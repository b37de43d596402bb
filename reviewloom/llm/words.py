"""Words and word shingles as 64-bit hashes, computed over the bytes of many texts at once.

A word is a maximal run of bytes other than ASCII white space (0x20, 0x09-0x0D). The hash of a word is a
polynomial over its bytes modulo 2**64, read from a running sum, and then mixed; it does not depend on
the place, the batch or the machine.
"""

from __future__ import annotations

import functools

import numpy as np

WORD_BASE = 0x9E3779B97F4A7C15
SHINGLE_BASE = 0xD6E8FEB86659FD93
WORDS_IN_SHINGLE = 5


def mix(x: np.ndarray) -> np.ndarray:
    """The public splitmix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, WORD_BASE, np.uint64)
    down = np.full(size, pow(WORD_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    return _powers(max(1 << 16, 1 << max(0, size - 1).bit_length()))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case; other bytes stay."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def not_space(data: np.ndarray) -> np.ndarray:
    return ~((data == 32) | ((data >= 9) & (data <= 13)))


def letters_only(data: np.ndarray) -> np.ndarray:
    """ASCII letters and digits and all bytes beyond ASCII: punctuation ends a word as white space does."""
    return ((data >= 48) & (data <= 57)) | ((data >= 65) & (data <= 90)) | ((data >= 97) & (data <= 122)) | (data >= 128)


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and where each text's words begin in that list.

    ``inside`` marks the bytes that belong to words; by default all but white space.
    """
    inside = not_space(data) if inside is None else inside
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and where each text's words begin in that list."""
    starts, ends, at = word_spans(data, offsets, inside)
    up, down = power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts]), at


def prefix_hashes(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lengths: tuple[int, ...]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each length, the hash of that many first bytes of every word (the whole word, if shorter)."""
    starts, ends, at = word_spans(data, offsets, inside)
    up, down = power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=total[1:])
    return [mix((total[np.minimum(starts + n, ends)] - total[starts]) * down[starts]) for n in lengths], at


def shingle_hashes(words: np.ndarray, at: np.ndarray, size: int = WORDS_IN_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and where each text's shingles begin.

    A text of one to ``size - 1`` words has one shingle of all its words; a text without words has none.
    """
    n = len(words)
    counts = np.diff(at)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    left = np.repeat(at[1:], counts) - np.arange(n)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        factor = np.uint64(pow(SHINGLE_BASE, k + 1, 1 << 64))
        total += np.where(left > k, padded[k : k + n] * factor, np.uint64(k + 1))
    first = np.zeros(n, bool)
    first[at[:-1][counts > 0]] = True
    keep = (left >= size) | (first & (left < size))
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    return mix(total[keep]), np.concatenate([[0], np.cumsum(made)])


def text_shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS_IN_SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    return shingle_hashes(*word_hashes(data, offsets), size)


def counted(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each text in rising order, how often each occurs, and where each text's values begin."""
    values = values.copy()
    for start, end in zip(at[:-1], at[1:]):
        values[start:end].sort()
    n = len(values)
    if n == 0:
        return values, np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    new = np.ones(n, bool)
    new[1:] = values[1:] != values[:-1]
    new[at[:-1][at[:-1] < n]] = True
    places = np.flatnonzero(new)
    counts = np.diff(np.append(places, n))
    return values[places], counts, np.searchsorted(places, at)
