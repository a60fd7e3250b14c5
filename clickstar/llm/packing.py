"""Packing of documents into training windows of several sizes.

A document is cut into windows of the largest size while it is longer than that; what is left is
routed to the tier of the smallest window that holds it. A window of a tier starts with a document
of the tier, its gap is filled with the best fitting documents of shorter tiers, and the last of
the gap with the head of a document that is cut there; its rest goes back to its tier. So windows
are filled to the last token, and have no padding, but for one at the end of each partition.
Windows of one size are dealt to step groups of an equal number of tokens, those of a flush in
order of their attention cost (sum of squared piece lengths), to and fro, which evens the costs out.

Everything happens where the text is read: a partition packs its own documents, with a buffer of
bounded size, and nothing is shuffled.
"""

from __future__ import annotations

import bisect
import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from clickstar.llm.tables import give_back, texts

TIERS = (256, 512, 1024, 2048)
#: Bytes of words and their ids that a worker's memo holds, about; beyond that it starts anew.
MEMO_BYTES = 300 << 20
#: Bytes that a word takes in a memo besides its text and ids: its key, places and the table's share.
WORD_BYTES = 130
#: Characters of a text that are tokenized at a time.
BLOCK = 1 << 19
#: Tokens and documents that wait in a partition's buffer.
BUFFER_TOKENS, BUFFER_DOCS = 2_000_000, 8_192

# Tokens --------------------------------------------------------------------------------------


def _width(word: str) -> int:
    """Characters of a word, those of plain ASCII ones, which take a byte each, as a quarter."""
    return len(word) // 4 if word.isascii() else len(word)


class WordIds:
    """Token ids by word, each word tokenized once by the library.

    The tokenizer drops white space and splits at it before all else, so the ids of a text are
    those of its words in order. Only at spaces and line ends are texts cut here; the library
    sees to all other white space. The memo is bounded in bytes, and what a single text adds: a text
    without spaces is one word, and the next text finds the memo empty again.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.clear()

    def clear(self) -> None:
        self.places: dict[str, int] = {"": 0}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)
        self.used = self.bytes = 0

    def _learn(self, words: list[str]) -> None:
        first = len(self.places)
        encoded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        counts = np.bincount(np.array(encoded.word_ids, np.int64), minlength=len(words))
        found = np.array(encoded.ids, np.uint32)
        while self.used + len(found) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while first + len(words) > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.ids[self.used : self.used + len(found)] = found
        self.starts[first : first + len(words)] = self.used + np.cumsum(counts) - counts
        self.lengths[first : first + len(words)] = counts
        self.used += len(found)
        # Four bytes a character is the most that a text takes.
        self.bytes += WORD_BYTES * len(words) + 4 * (len(found) + sum(map(_width, words)))
        self.places.update(zip(words, range(first, first + len(words)), strict=True))

    def encode(self, text: str) -> np.ndarray:
        if self.bytes > MEMO_BYTES:
            self.clear()
        words = text.replace("\n", " ").split(" ")
        if unknown := set(words).difference(self.places):
            self._learn(list(unknown))
        place = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
        lengths = self.lengths[place]
        ends = np.cumsum(lengths)
        if not ends[-1]:
            return np.zeros(0, np.uint32)
        return self.ids[np.repeat(self.starts[place] - ends + lengths, lengths) + np.arange(ends[-1])]


def _blocks(text: str) -> Iterator[str]:
    """The text in pieces that end at a space."""
    start = 0
    while len(text) - start > BLOCK:
        cut = text.find(" ", start + BLOCK)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


_KEPT: dict[str, WordIds] = {}


def word_ids(model: str) -> WordIds:
    """The worker's memo for a tokenizer, kept from task to task."""
    key = hashlib.md5(model.encode()).hexdigest()
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = WordIds(Tokenizer.from_str(model))
    return _KEPT[key]


# Packing -------------------------------------------------------------------------------------


@dataclass
class Doc:
    """A document's place in the output; its number of tokens is known after its last piece."""

    key: object
    tokens: int = 0


@dataclass(order=True)
class Part:
    """Tokens of a document that still have to go into a window."""

    length: int
    arrival: int
    doc: Doc = field(compare=False)
    start: int = field(compare=False)
    ids: np.ndarray = field(compare=False)


@dataclass
class Piece:
    doc: Doc
    start: int
    length: int
    crc: int


class Packer:
    """Windows of one partition, from a stream of documents."""

    def __init__(self, tiers: tuple[int, ...], step_tokens: int):
        self.tiers = sorted(tiers)
        self.longest = self.tiers[-1]
        self.step_tokens = step_tokens
        self.waiting: dict[int, list[Part]] = {tier: [] for tier in self.tiers}
        self.tokens = self.arrivals = 0
        self.windows: dict[int, list[list[Piece]]] = {tier: [] for tier in self.tiers}
        self.last: list[Piece] = []

    def _tier(self, length: int) -> int:
        return self.tiers[bisect.bisect_left(self.tiers, length)]

    def _put(self, doc: Doc, start: int, ids: np.ndarray) -> None:
        if len(ids):
            self.arrivals += 1
            part = Part(len(ids), self.arrivals, doc, start, ids)
            bisect.insort(self.waiting[self._tier(len(ids))], part)
            self.tokens += len(ids)

    def _take(self, tier: int, place: int) -> Part:
        part = self.waiting[tier].pop(place)
        self.tokens -= part.length
        return part

    @staticmethod
    def _piece(part: Part, length: int) -> Piece:
        crc = zlib.crc32(part.ids[:length].astype("<u4").tobytes())
        return Piece(part.doc, part.start, length, crc)

    def add(self, key: object, blocks: Iterator[np.ndarray]) -> None:
        """A document, as blocks of ids: its long windows at once, the rest to its tier."""
        doc = Doc(key)
        left = np.zeros(0, np.uint32)
        start = 0
        for ids in blocks:
            left = np.concatenate([left, ids]) if len(left) else ids
            doc.tokens += len(ids)
            cut = 0
            while len(left) - cut > self.longest:
                part = Part(self.longest, 0, doc, start + cut, left[cut : cut + self.longest])
                self.windows[self.longest].append([self._piece(part, self.longest)])
                cut += self.longest
            left, start = left[cut:], start + cut
        self._put(doc, start, left.copy())

    @property
    def full(self) -> bool:
        return self.tokens >= BUFFER_TOKENS or sum(map(len, self.waiting.values())) >= BUFFER_DOCS

    def _filler(self, gap: int) -> Part | None:
        """The longest part that fits the gap, else the shortest one, to be cut."""
        for tier in reversed(self.tiers):
            waiting = self.waiting[tier]
            place = bisect.bisect_right(waiting, gap, key=lambda part: part.length) - 1
            if place >= 0:
                return self._take(tier, place)
        for tier in self.tiers:
            if self.waiting[tier]:
                return self._take(tier, 0)
        return None

    def pack(self, final: bool) -> None:
        """Windows from what waits; parts that cannot fill one stay, unless this is the end."""
        for tier in reversed(self.tiers):
            while self.waiting[tier]:
                if self.tokens < tier:
                    break
                gap, window = tier, []
                part = self._take(tier, -1)
                while True:
                    length = min(gap, part.length)
                    window.append(self._piece(part, length))
                    self._put(part.doc, part.start + length, part.ids[length:])
                    gap -= length
                    if not gap:
                        break
                    part = self._filler(gap)  # there is one: enough tokens waited
                self.windows[tier].append(window)
        if final:
            self._pack_rest()

    def _pack_rest(self) -> None:
        """The last parts, fewer tokens than their tier: full windows of smaller tiers, and one
        window that is padded."""
        for tier in reversed(self.tiers):
            while self.tokens >= tier:
                gap, window = tier, []
                while gap:
                    part = self._filler(gap)
                    length = min(gap, part.length)
                    window.append(self._piece(part, length))
                    self._put(part.doc, part.start + length, part.ids[length:])
                    gap -= length
                self.windows[tier].append(window)
        while (part := self._filler(self.longest)) is not None:
            self.last.append(self._piece(part, part.length))

    def steps(self, final: bool) -> Iterator[tuple[int, list[list[Piece]]]]:
        """Groups of windows of one size with ``step_tokens`` tokens; at the end also smaller."""
        for tier in self.tiers:
            size = max(1, self.step_tokens // tier)
            ready = len(self.windows[tier]) if final else len(self.windows[tier]) // size * size
            windows, self.windows[tier] = self.windows[tier][:ready], self.windows[tier][ready:]
            windows.sort(key=lambda window: sum(piece.length**2 for piece in window))
            n = -(-len(windows) // size)
            groups: list[list] = [[] for _ in range(n)]
            for k, window in enumerate(windows):
                lap, at = divmod(k, n)
                groups[at if lap % 2 == 0 else n - 1 - at].append(window)
            for group in groups:
                yield tier, group
        if final and self.last:
            yield self.longest, [self.last]
            self.last = []


def pack_documents(
    docs: DataFrame,
    model: str,
    end_id: int = 1,
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = 65_536,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_memo: bool = True,
) -> DataFrame:
    """One row per piece of a document in a window.

    ``id_column, start, length, ids_crc32, doc_tokens``: where the piece begins in its document, its
    length, the checksum of its ids as little-endian unsigned 32-bit numbers, and the tokens of its
    document, ``end_id`` included. ``sequence_id, offset``: the window and the place in it, gapless
    from 0. ``window``: the window's size; ``step_id``: its step group.

    ``model`` is the JSON of a tokenizer that drops white space. A null text counts as empty, and
    has ``end_id`` alone. Each row of ``docs`` is a document of its own, also if its id is null
    or repeated; further columns are not read; an empty table gives an empty one. Ids are numbered
    by partition, which reading the same files gives alike. ``keep_memo`` lets a worker take its memo
    of words from task to task, and hold it while it does other work.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # a vocabulary: a few MB
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    names = "id start length ids_crc32 doc_tokens sequence_id offset window step_id".split()
    kinds = [rows.schema["id"].dataType] + [T.LongType()] * 8
    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_ids(shared.value)
        packer = Packer(tiers, step_tokens)
        base = TaskContext.get().partitionId() << 33
        sequence = step = 0
        id_type = None
        end = np.array([end_id], np.uint32)

        def ids_of(text: str) -> Iterator[np.ndarray]:
            yield from map(memo.encode, _blocks(text))
            yield end

        def emitted(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, step
            out: list[tuple] = []
            for window, group in packer.steps(final):
                for pieces in group:
                    offset = 0
                    for p in pieces:
                        out.append(
                            (p.doc.key, p.start, p.length, p.crc, p.doc.tokens)
                            + (base + sequence, offset, window, base + step)
                        )
                        offset += p.length
                    sequence += 1
                step += 1
            if out:
                columns = list(zip(*out, strict=True))
                arrays = [pa.array(columns[0], id_type)]
                arrays += [pa.array(c, pa.int64()) for c in columns[1:]]
                yield pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            id_type = batch.column("id").type
            keys = batch.column("id").to_pylist()
            for key, text in zip(keys, texts(batch.column("text")), strict=True):
                packer.add(key, ids_of(text))
                if packer.full:
                    packer.pack(final=False)
                    yield from emitted(final=False)
        packer.pack(final=True)
        yield from emitted(final=True)
        if not keep_memo:
            memo.clear()
            _KEPT.clear()
            give_back()

    return rows.mapInArrow(pack, schema).withColumnRenamed("id", id_column)
