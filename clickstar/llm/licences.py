"""Licence notices in texts, by the Dice coefficient of word bigrams against templates.

Texts and templates are normalised alike: lower case, words of letters and digits. A window of
consecutive lines is compared with a template if their sizes allow the score at all: with scores of
at least ``t``, the one has at most (2 - t) / t times the bigrams of the other, and that prunes
templates for a window and lines for a template. A window has to begin and end with a line with a
word of a bigram of the template, or it would score more without that line; and it needs so many of
the template's bigrams that most texts have too few in all, and are read once and done.

A notice within a longer line, or in a text without line breaks, fills no window of lines. So windows
of words, from one bigram of the template to another, are compared too, and those that have no word
in common with a match by lines, or with a better one of words, are matches as well.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstar.llm.tables import texts

THRESHOLD = 0.8
_WORDS = re.compile(r"[a-z0-9]+(?:[.\-][a-z0-9]+)*")

_GNU = (
    ("GPL-2.0", "General", "program", "2"),
    ("LGPL-2.1", "Lesser General", "library", "2.1"),
    ("LGPL-3.0", "Lesser General", "library", "3"),
    ("AGPL-3.0", "Affero General", "program", "3"),
)
# Notices as licences and their stewards word them. Full texts are not among them.
NOTICES: tuple[tuple[str, str], ...] = (
    *(
        (licence, f"This work is licensed under the GNU {kind} Public License, version {version}.")
        for licence, kind, _, version in _GNU
    ),
    *(
        (
            licence,
            f"This {what} is free software: you can redistribute it and/or modify it under the terms "
            f"of the GNU {kind} Public License as published by the Free Software Foundation, either "
            f"version {version} of the License, or (at your option) any later version.",
        )
        for licence, kind, what, version in _GNU
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/.",
    ),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file '
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-4.0",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ),
)


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


def bigrams(words: list[str]) -> Counter:
    return Counter(zip(words, words[1:], strict=False))


def dice(a: Counter, b: Counter) -> float:
    """Twice the bigrams in common through all bigrams, repeats counted."""
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


@dataclass(frozen=True)
class Match:
    licence: str
    score: float
    first: int
    last: int


class Templates:
    """Templates, their bigrams, and the sizes a window may have for each."""

    def __init__(self, notices: tuple[tuple[str, str], ...], threshold: float):
        self.threshold = threshold
        self.rows: list[tuple[str, Counter, int]] = []
        self.having: dict[tuple[str, str], list[int]] = {}
        for k, (licence, text) in enumerate(notices):
            grams = bigrams(words_of(text))
            if not grams:
                raise ValueError(f"template without two words: {text!r}")
            self.rows.append((licence, grams, grams.total()))
            for pair in grams:
                self.having.setdefault(pair, []).append(k)

    def matches(self, text: str) -> list[Match]:
        """The best window of lines for what matches, windows that overlap a better one left out.

        Better is a higher score, then more lines, then the earlier one. Lines count from 1.
        """
        lowered = text.lower()
        flat = _WORDS.findall(lowered)
        return self._best_lines(lowered, flat, self._places(flat))[0]

    def notices(self, text: str) -> list[Match]:
        """The matches by lines, and by windows of words where these have none.

        Better is a higher score, then more words, then the earlier one. A match tells the lines of
        its first and its last word.
        """
        lowered = text.lower()
        flat = _WORDS.findall(lowered)
        places = self._places(flat)
        kept, ends = self._best_lines(lowered, flat, places)
        found = []
        for k, hits in places.items():
            if self._enough(k, hits):
                found += self._word_windows(k, hits, flat)
        if not found:
            return kept
        taken = [(ends[m.first - 1], ends[m.last] - 1) for m in kept]
        found.sort(key=lambda w: (-w[1], w[2] - w[3], w[2], w[0]))
        for licence, score, low, high in found:
            at = bisect.bisect_right(taken, (high, len(flat)))
            if at and taken[at - 1][1] >= low:
                continue
            taken.insert(at, (low, high))
            first, last = (bisect.bisect_right(ends, w) for w in (low, high))
            kept.append(Match(licence, score, first, last))
        return sorted(kept, key=lambda m: (m.first, m.last))

    def _places(self, flat: list[str]) -> dict[int, list[int]]:
        """For each template, where the text has a bigram of it."""
        places: dict[int, list[int]] = {}
        having = self.having.get
        for at, pair in enumerate(zip(flat, flat[1:], strict=False)):
            for k in having(pair, ()):
                places.setdefault(k, []).append(at)
        return places

    def _enough(self, k: int, hits: list[int]) -> bool:
        """Not too few for the smallest window that may match."""
        n = self.rows[k][2]
        return 2 * len(hits) >= self.threshold * (n + n * self.threshold / (2 - self.threshold))

    def _best_lines(self, lowered: str, flat: list[str], places) -> tuple[list[Match], list[int]]:
        """Matches by lines, and before which word each line starts, if there is a candidate."""
        found: list[Match] = []
        ends: list[int] = []
        for k, hits in places.items():
            if not self._enough(k, hits):
                continue
            if not ends:
                ends = [0]
                for line in lowered.split("\n"):
                    ends.append(ends[-1] + len(_WORDS.findall(line)))
            found += self._windows(k, hits, flat, ends)
        found.sort(key=lambda m: (-m.score, m.first - m.last, m.first, m.licence))
        kept: list[Match] = []
        for match in found:
            if all(match.last < k.first or match.first > k.last for k in kept):
                kept.append(match)
        return sorted(kept, key=lambda m: m.first), ends

    def _windows(self, k: int, hits: list[int], flat: list[str], ends: list[int]) -> Iterator[Match]:
        """Windows of lines that match a template, whose bigrams start at ``hits``."""
        licence, grams, n = self.rows[k]
        share = (2 - self.threshold) / self.threshold
        # A line has part in a hit with either word.
        lines = sorted({bisect.bisect_right(ends, w) - 1 for at in hits for w in (at, at + 1)})
        for a, first in enumerate(lines):
            for last in lines[a:]:
                low, high = ends[first], ends[last + 1]
                size = high - low - 1
                if size > n * share:
                    break
                inside = bisect.bisect_left(hits, high - 1) - bisect.bisect_left(hits, low)
                if size * share < n or 2 * inside < self.threshold * (size + n):
                    continue
                score = dice(bigrams(flat[low:high]), grams)
                if score >= self.threshold:
                    yield Match(licence, score, first + 1, last + 1)


    def _word_windows(
        self, k: int, hits: list[int], flat: list[str]
    ) -> Iterator[tuple[str, float, int, int]]:
        """Windows of words, first and last one, that match a template and start and end at a hit."""
        licence, grams, n = self.rows[k]
        share = (2 - self.threshold) / self.threshold
        for a, low in enumerate(hits):
            seen: dict[tuple[str, str], int] = {}
            common = 0
            for at in hits[a : a + int(n * share) + 1]:
                size = at - low + 1
                if size > n * share:
                    break
                pair = (flat[at], flat[at + 1])
                seen[pair] = seen.get(pair, 0) + 1
                common += seen[pair] <= grams[pair]
                if 2 * common >= self.threshold * (size + n):
                    yield licence, 2 * common / (size + n), low, at + 1


def scan_licences(
    docs: DataFrame,
    notices: tuple[tuple[str, str], ...] = NOTICES,
    threshold: float = THRESHOLD,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id_column, matches`` for each row: an array of licence, score, first and last line.

    A null or empty text has none. Repeated rows stay repeated, a null id stays null, further
    columns are not read; an empty table gives an empty one. Memory: a batch of texts and the words
    of one; there is no shuffle.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    match = pa.struct(
        [("licence", pa.string()), ("score", pa.float64()), ("first", pa.int64()), ("last", pa.int64())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(notices, threshold)
        for batch in batches:
            found = [
                [(m.licence, m.score, m.first, m.last) for m in templates.notices(text)]
                for text in texts(batch.column("text"))
            ]
            as_dicts = [[dict(zip(("licence", "score", "first", "last"), m, strict=True)) for m in f] for f in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(as_dicts, pa.list_(match))], ["id", "matches"]
            )

    one = T.StructType().add("licence", "string").add("score", "double")
    one = one.add("first", "long").add("last", "long")
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    schema = schema.add("matches", T.ArrayType(one))
    return rows.mapInArrow(scan, schema).withColumnRenamed("id", id_column)


def licence_summary(scanned: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``id_column, n_matches, licences, best_score, lines``: licences in order, with commas; lines of
    each match, from 1."""
    matches = F.col("matches")
    return scanned.select(
        id_column,
        F.size(matches).cast("long").alias("n_matches"),
        F.concat_ws(",", F.array_sort(F.array_distinct(matches["licence"]))).alias("licences"),
        F.array_max(matches["score"]).alias("best_score"),
        F.transform(
            matches, lambda m: F.concat_ws("-", m["first"], m["last"])
        ).alias("lines"),
    )
