"""Anchors of byte strings: places that equal windows have at equal offsets."""

from __future__ import annotations

import numpy as np

#: Bytes that are hashed at a time; the places of a block fit beside a hash in 64 bits.
BLOCK = 1 << 20
_ODD = 0x9E3779B97F4A7C15 | 1


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return values ^ (values >> np.uint64(33))


def gram_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` bytes from each place on, by doubling."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    table = mixed(np.arange(1, 257, dtype=np.uint64))
    value, done = table[data], 1
    whole, covered = None, 0
    base = _ODD
    left = width
    while left:
        if left & 1:
            if whole is None:
                whole = value
            else:  # covered bytes, then done more
                m = len(data) - covered - done + 1
                whole = whole[:m] * np.uint64(pow(_ODD, done, 1 << 64)) + value[covered : covered + m]
            covered += done
        left >>= 1
        if left:
            m = len(value) - done
            value = value[:m] * np.uint64(base) + value[done:]
            done *= 2
            base = base * base % (1 << 64)
    return mixed(whole[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    done = 1
    while done * 2 <= width:
        values = np.minimum(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, width: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams of ``width`` bytes that are the least, by hash, of all in
    some window of ``window`` bytes, the first of equals.

    What a window selects depends on its bytes alone, so two equal windows select grams at the
    same offset. Data shorter than a window has no anchors.
    """
    grams = window - width + 1
    places, hashes = [], []
    for start in range(0, max(0, len(data) - window + 1), BLOCK):
        found = gram_hashes(data[start : start + BLOCK + window - 1], width)
        low = np.uint64((1 << 21) - 1)
        ranked = (found & ~low) | np.arange(len(found), dtype=np.uint64)
        least = np.unique(_least(ranked, grams) & low).astype(np.int64)
        places.append(least + start)
        hashes.append(mixed(found[least] + np.uint64(_ODD)))  # the least ones are all alike small
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    place, hashed = np.concatenate(places), np.concatenate(hashes)
    place, first = np.unique(place, return_index=True)
    return place, hashed[first]
