"""Word shingles of a text as a set of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

WORDS = 5
#: Bytes of a text that are cut into words at a time.
BLOCK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)
_FIRST = np.array([True])


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value hashed."""
    values = values ^ (values >> _SHIFT)
    for _ in range(2):
        values *= _FACTOR
        values ^= values >> _SHIFT
    return values


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    values = np.sort(values)
    return values[np.concatenate([_FIRST, values[1:] != values[:-1]])] if len(values) else values


def _blocks(data: bytes) -> Iterator[bytes]:
    start = 0
    while len(data) - start > BLOCK:
        cut = data.find(b" ", start + BLOCK)
        if cut < 0:
            break
        yield data[start:cut]
        start = cut
    yield data[start:]


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word: runs of anything but ASCII white space, A to Z in lower case. Bytes
    are lowered and split, which touches ASCII alone."""
    parts = []
    for block in _blocks(text.encode()):
        words = block.lower().split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """The distinct shingles, sorted. Of a text with fewer words, the whole sequence as one; of a
    text without words, none."""
    found = word_hashes(text)
    if not len(found):
        return found
    width = min(words, len(found))
    value = np.full(len(found) - width + 1, width, np.uint64)
    for k in range(width):
        value = value * _STEP + found[k : k + len(value)]
    return distinct(mixed(value))
