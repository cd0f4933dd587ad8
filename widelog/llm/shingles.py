"""Sets of word shingles as sorted 64-bit hashes.

Words are maximal runs of bytes other than \\x09-\\x0D and \\x20 with A-Z in lower case. A text of five words or more has
the set of its distinct five-word runs; one with fewer has its whole sequence as the only member; one without words, an
empty or a null text has none. The hash of a member also serves as its rank in the one random order that sketches use.
"""

from __future__ import annotations

import numpy as np

from .common import WordHash, mix, within

WORDS = 5
STEP = mix(np.arange(11, 11 + WORDS, dtype=np.uint64)) | np.uint64(1)
HASH = WordHash()


def hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All members, repeats included, row after row, and how many each row has."""
    begin, end, counts = HASH.spans(raw, at)
    if not len(begin):
        return np.zeros(0, np.uint64), counts
    words = np.concatenate([HASH(raw, begin, end), np.zeros(WORDS, np.uint64)])
    n = len(begin)
    left = np.repeat(counts, counts) - within(counts)
    first = np.flatnonzero((left >= WORDS) | ((left == np.repeat(counts, counts)) & (left < WORDS)))
    total = np.zeros(len(first), np.uint64)
    for k in range(WORDS):
        total += np.where(left[first] > k, words[first + k] * STEP[k], np.uint64(k))
    assert n == counts.sum()
    return mix(total), np.where(counts >= WORDS, counts - WORDS + 1, np.minimum(counts, 1))


def sets(raw: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct members of each row."""
    found, counts = hashes(raw, at)
    ends = np.cumsum(counts)
    return [np.unique(found[b - n : b]) for b, n in zip(ends, counts, strict=True)]
