"""Suffix arrays of many short byte strings, by two-stage sorting, to a bounded depth."""

from __future__ import annotations

import numpy as np

#: Ends a string; no byte of UTF-8.
END = 0xFF


def _types(data: np.ndarray) -> np.ndarray:
    """Whether the suffix at each place is smaller than the one after it; the last one is."""
    step = np.append(np.sign(data[1:].astype(np.int16) - data[:-1].astype(np.int16)), 1)
    decides = np.where(step != 0, np.arange(len(step)), len(step) - 1)
    decides = np.minimum.accumulate(decides[::-1])[::-1]
    return step[decides] > 0


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that orders like them."""
    padded = np.concatenate([data, np.full(8, END, np.uint8)])
    value = np.zeros(len(data), np.uint64)
    for k in range(8):
        value = (value << np.uint64(8)) | padded[k : k + len(data)].astype(np.uint64)
    return value


def _word_at(words: np.ndarray, places: np.ndarray) -> np.ndarray:
    return words[np.minimum(places, len(words) - 1)]


def _sorted(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` bytes: by eight bytes first, and where these tie
    by the next eight."""
    if not len(places):
        return places
    order = places[np.argsort(words[places], kind="stable")]
    # Of tied runs: where in the order, and a number per run.
    keys = words[order]
    at = np.arange(len(order))
    run = np.cumsum(np.concatenate([[0], keys[1:] != keys[:-1]]))
    for offset in range(8, depth, 8):
        counts = np.bincount(run, minlength=1)
        tied = counts[run] > 1
        at, run = at[tied], run[tied]
        if not len(at):
            break
        keys = _word_at(words, order[at] + offset)
        # Runs whose members all go on alike stay as they are.
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        low, high = np.minimum.reduceat(keys, first), np.maximum.reduceat(keys, first)
        differs = np.repeat(low != high, np.diff(np.append(first, len(run))))
        if differs.any():
            part, runs, part_keys = at[differs], run[differs], keys[differs]
            by = np.lexsort((part_keys, runs))
            order[part] = order[part[by]]
            keys[differs] = part_keys[by]
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (keys[1:] != keys[:-1])])
        run = np.cumsum(new) - 1
    return order


def suffix_order(data: np.ndarray, wanted: np.ndarray, depth: int) -> np.ndarray:
    """The ``wanted`` places of ``data`` in order of the ``depth`` bytes from there on.

    ``data`` is strings that each end with ``END``; a wanted place has ``depth`` bytes of its string.
    Only suffixes smaller than their successors are sorted by comparison. A suffix that is larger
    than its successor follows from it: going through the order bucket by bucket of first bytes,
    each suffix puts the one before it, if that is such a one, next into that one's bucket, where
    these come before the sorted ones. So that every wanted suffix follows from something, the
    places after a string's last wanted one take part up to the first that is sorted.
    """
    smaller = _types(data)
    words = _words(data)
    part = wanted.copy()
    last = np.flatnonzero(wanted & ~np.append(wanted[1:], False)) + 1
    while len(last):  # one step for all strings at a time; a string's last byte is a sorted one
        part[last] = True
        last = last[~smaller[last]] + 1
    induced = part & ~smaller
    seeds = _sorted(np.flatnonzero(part & smaller), words, depth)
    starts = np.searchsorted(data[seeds], np.arange(257))  # in order, so first bytes ascend
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    found = []
    for byte in range(256):
        layers = [np.concatenate(waiting[byte])] if waiting[byte] else []
        while layers and len(layers[-1]):
            before = layers[-1] - 1
            before = before[before >= 0]
            layers.append(before[induced[before] & (data[before] == byte)])
        bucket = np.concatenate([*layers, seeds[starts[byte] : starts[byte + 1]]])
        if not len(bucket):
            continue
        found.append(bucket)
        before = bucket - 1
        before = before[before >= 0]
        before = before[induced[before] & (data[before] > byte)]
        by = np.argsort(data[before], kind="stable")
        before = before[by]
        first = np.flatnonzero(np.concatenate([[True], np.diff(data[before].astype(np.int16)) != 0]))
        for start, end in zip(first, np.append(first[1:], len(before)), strict=True):
            if end > start:
                waiting[data[before[start]]].append(before[start:end])
    order = np.concatenate(found) if found else np.zeros(0, np.int64)
    return order[wanted[order]]


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix of the order has in common with the one before it, up to ``depth``;
    0 for the first."""
    words = _words(data)
    common = np.zeros(len(order), np.int64)
    alive = np.arange(1, len(order))
    for offset in range(0, depth, 8):
        if not len(alive):
            break
        a, b = _word_at(words, order[alive] + offset), _word_at(words, order[alive - 1] + offset)
        apart = a ^ b
        # Leading equal bytes: 8 less those from the highest set bit down.
        bits = np.zeros(len(apart), np.int64)
        for shift in range(8):
            bits += (apart >> np.uint64(8 * shift)) != 0
        common[alive] += 8 - bits
        alive = alive[bits == 0]
    return np.minimum(common, depth)
