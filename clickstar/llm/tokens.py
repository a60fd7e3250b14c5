"""Token counts by byte-pair merging, without token ids.

A text becomes its characters, and the adjacent pair whose merged piece ranks first is merged, the
leftmost of equals, until no pair forms a piece: a heap holds the pairs, a linked list the symbols.
Each merge takes one symbol away, so the count is the symbols at the start less the merges, plus,
for a character that is no piece, its bytes beyond the first.

No piece has a space inside, only in front, so merges never cross from a word into the space after
it, and words are merged one by one. A worker keeps the counts of words it has met, up to
``MEMO_WORDS``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping
from heapq import heapify, heappop, heappush

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar.llm.tables import texts

SPACE = "▁"
MEMO_WORDS = 400_000
#: Words longer than this are counted and not kept.
MEMO_LENGTH = 64


def read_ranks(path: str) -> dict[str, int]:
    """The pieces of a model file and their order of merging, first is 0.

    The file is read on the driver: a vocabulary has some ten thousands of pieces. Only models
    that keep spaces as they are and put one in front are understood, and only if a space stands
    in front in every piece.
    """
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        i
        for i in range(model.vocab_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    pieces.sort(key=lambda i: (-model.get_score(i), i))
    ranks = {model.id_to_piece(i): rank for rank, i in enumerate(pieces)}
    inside = [piece for piece in ranks if SPACE in piece.lstrip(SPACE)]
    if inside or any("\n" in piece and len(piece) > 1 for piece in ranks):
        raise ValueError(f"pieces with a space or line end inside: {inside[:3]}")
    if len(model.encode("  a ")) < len(model.encode("a")) + 2:
        raise ValueError("the model drops spaces")
    return ranks


def merged_count(word: str, ranks: Mapping[str, int]) -> int:
    """Tokens of a word whose spaces are already marks."""
    symbols: list[str] = list(word)
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    end, merges = len(symbols), 0
    find = ranks.get
    heap = []
    for left in range(end - 1):
        rank = find(symbols[left] + symbols[left + 1])
        if rank is not None:
            heap.append((rank, left, symbols[left] + symbols[left + 1]))
    heapify(heap)
    while heap:
        _, left, piece = heappop(heap)
        right = after[left]
        if right >= end or not symbols[left] or symbols[left] + symbols[right] != piece:
            continue  # one of the two has been merged since
        symbols[left], symbols[right] = piece, ""
        merges += 1
        right = after[left] = after[right]
        if right < end:
            before[right] = left
            pair = piece + symbols[right]
            if (rank := find(pair)) is not None:
                heappush(heap, (rank, left, pair))
        first = before[left]
        if first >= 0:
            pair = symbols[first] + piece
            if (rank := find(pair)) is not None:
                heappush(heap, (rank, first, pair))
    spelled = sum(len(c.encode()) - 1 for c in symbols if len(c) == 1 and c not in ranks)
    return len(word) - merges + spelled


class WordCounts(dict):
    """Tokens by word; those not met yet are merged."""

    def __init__(self, ranks: Mapping[str, int]):
        super().__init__()
        self.ranks = ranks

    def __missing__(self, word: str) -> int:
        count = merged_count(word, self.ranks)
        if len(word) <= MEMO_LENGTH:
            if len(self) >= MEMO_WORDS:
                self.clear()
            self[word] = count
        return count


_RUNS = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def words_of(text: str) -> list[str]:
    """The text cut where no merge can cross: in front of spaces and around line ends."""
    if not text:
        return []
    text = SPACE + text.replace(" ", SPACE)
    if SPACE + SPACE in text:
        return _RUNS.findall(text)
    return text.replace(SPACE, " " + SPACE).replace("\n", " \n ").split(" ")


def text_tokens(text: str, counts: WordCounts) -> int:
    return sum(map(counts.__getitem__, words_of(text)))


_KEPT: dict[int, WordCounts] = {}


def _counts(ranks: Mapping[str, int]) -> WordCounts:
    """The worker's memo, kept from task to task for the same vocabulary."""
    key = hash(frozenset(ranks.items()))
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = WordCounts(ranks)
    return _KEPT[key]


def count_tokens(
    docs: DataFrame,
    ranks: Mapping[str, int],
    limit: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``id_column, n_bytes, n_tokens, over_limit`` for each row, of its whole text.

    A null or empty text has no bytes and no tokens. Repeated rows stay repeated, a null id stays
    null, further columns are not read. An empty table gives an empty one. Memory: a batch of texts,
    the vocabulary and the memo; there is no shuffle.
    """
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    rows = rows.withColumn("n_bytes", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _counts(ranks)
        for batch in batches:
            found = [text_tokens(text, memo) for text in texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(found, pa.int64())],
                ["id", "n_bytes", "n_tokens"],
            )

    kind = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_column),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )
