"""Removal of byte strings that occur more than once, exactly and over all texts, with suffix arrays.

Every byte covered by a string of ``length`` bytes that also starts elsewhere is removed. Two equal
strings of that length have an *anchor* at the same offset (see ``anchors``), so only places around
anchors that occur twice can hold one. What can be part of such a string with the anchor in it is
its *context*, the bytes up to ``length`` before its end and after its start. Equal contexts are
one, however many places have them; the distinct contexts of an anchor meet in one task, where a
suffix array of them, sorted in two stages, and the common prefixes of its neighbours tell which
strings of ``length`` bytes occur twice. The places of each context then take the spans found in it.

An anchor of more than ``HOT_CONTEXTS`` distinct contexts (a passage with different surroundings in
each text) has no suffix array. Two equal strings hold their anchor at the same offset, so its
contexts are cut into their windows of ``length`` bytes, at most ``length - width + 1`` with the
anchor in them, known by offset and 128-bit hash. Counting these is an aggregate over all tasks.

Equal texts are one text from the start, known by a 64-bit hash: all of it occurs elsewhere, if it
is long enough, and as a partner for others it counts once. Texts are shuffled once, those with an
anchor that occurs twice two more times; everything else are numbers.

Most that a task holds: the anchors of a part (``TASK_ANCHORS`` on average; all places of one anchor are
in one part, as numbers), or ``HOT_CONTEXTS`` contexts of an anchor and a block of others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.llm.anchors import anchors
from clickstar.llm.suffixes import END, common_prefixes, suffix_order
from clickstar.llm.tables import STEP, written

LENGTH = 200
#: Bytes of an anchor: fewer make fewer of them, more make fewer that occur twice by chance.
ANCHOR = 100
TASK_ANCHORS = 250_000
#: Distinct contexts of an anchor that one suffix array is made of.
HOT_CONTEXTS = 20_000
#: Rows of a batch that is given back.
ROWS = 20_000
#: Bytes of contexts that one suffix array is made of, if an anchor has no more; and a task's.
BLOCK_BYTES, TASK_BYTES = 1 << 20, 24 << 20


def _text_key(text: Column) -> Column:
    return F.xxhash64(text)


def _binaries(column: pa.Array) -> Iterator[bytes]:
    for start in range(0, len(column), STEP):
        yield from column.slice(start, STEP).to_pylist()


def _unseen(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """A task's texts by key, each once."""
    seen: set[int] = set()
    for batch in batches:
        keys = batch.column("k").to_pylist()
        for k, text in zip(keys, _binaries(batch.column("text")), strict=True):
            if k not in seen:
                seen.add(k)
                yield k, text


# Anchors -------------------------------------------------------------------------------------


def _anchored(rows: DataFrame, length: int, width: int, parts: int) -> DataFrame:
    """The anchors of a task's texts as ``part, data``, some thousand texts to a block: their keys,
    how many anchors each has there, and the anchors' hashes (32 bits), contexts and places."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, owner, hashed, context, place, waiting = [], [], [], [], [], 0
        for k, text in _unseen(batches):
            at, h = anchors(np.frombuffer(text, np.uint8), width, length)
            if not len(at):
                continue
            reach = length - width
            c = [
                xxhash.xxh3_64_intdigest(text[max(0, p - reach) : p + length]) for p in at.tolist()
            ]
            owner.append(np.full(len(at), len(keys)))
            keys.append(k)
            hashed.append(h)
            context.append(np.array(c, np.uint64))
            place.append(at)
            waiting += len(at)
            if waiting >= TASK_ANCHORS // 2:
                yield _blocks(keys, owner, hashed, context, place, parts)
                keys, owner, hashed, context, place, waiting = [], [], [], [], [], 0
        if waiting:
            yield _blocks(keys, owner, hashed, context, place, parts)

    return rows.mapInArrow(scan, "part int, data binary")


def _blocks(keys, owner, hashed, context, place, parts: int) -> pa.RecordBatch:
    owner, hashed = np.concatenate(owner), np.concatenate(hashed)
    context, place = np.concatenate(context), np.concatenate(place)
    keys = np.array(keys, np.int64)
    part = ((hashed >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    owner, hashed, context, place, part = (x[order] for x in (owner, hashed, context, place, part))
    first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
    blocks = []
    for start, end in zip(first, np.append(first[1:], len(part)), strict=True):
        has, counts = np.unique(owner[start:end], return_counts=True)
        blocks.append(
            np.array([len(has), end - start], "<i8").tobytes()
            + keys[has].astype("<i8").tobytes()
            + context[start:end].astype("<u8").tobytes()
            + counts.astype("<u4").tobytes()
            + hashed[start:end].astype("<u4").tobytes()
            + place[start:end].astype("<u4").tobytes()
        )
    return pa.RecordBatch.from_arrays(
        [pa.array(part[first], pa.int32()), pa.array(blocks, pa.binary())], ["part", "data"]
    )


def _unblocked(data: bytes) -> tuple[np.ndarray, ...]:
    n, m = np.frombuffer(data, "<i8", 2).tolist()
    at = 16
    keys = np.frombuffer(data, "<i8", n, at)
    context = np.frombuffer(data, "<u8", m, at := at + 8 * n)
    counts = np.frombuffer(data, "<u4", n, at := at + 8 * m)
    hashed = np.frombuffer(data, "<u4", m, at := at + 4 * n)
    place = np.frombuffer(data, "<u4", m, at + 4 * m)
    return hashed, context, np.repeat(keys, counts), place.astype(np.int64)


def _met(part: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
    columns = zip(*map(_unblocked, blocks), strict=True)
    hashed, context, key, place = (np.concatenate(c) for c in columns)
    order = np.lexsort((place, key, context, hashed))
    hashed, context, key, place = (x[order] for x in (hashed, context, key, place))

    def starts(*columns: np.ndarray) -> np.ndarray:
        changed = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return np.concatenate([[True], changed])

    once = starts(hashed, context, key, place)  # equal texts of different tasks
    hashed, context, key, place = (x[once] for x in (hashed, context, key, place))
    group = np.cumsum(starts(hashed)) - 1
    twice = np.bincount(group)[group] > 1
    hashed, context, key, place = (x[twice] for x in (hashed, context, key, place))
    if not len(hashed):
        return
    base = np.int64(part) << np.int64(32)
    lead = starts(hashed, context)
    number = np.cumsum(lead) - 1
    several = np.bincount(number)[number] > 1
    found = pa.RecordBatch.from_arrays(
        [
            pa.array(base + hashed.astype(np.int64)),
            pa.array(base + number),
            pa.array(key),
            pa.array(place),
            pa.array(lead),
            pa.array(several),
        ],
        ["anchor", "context", "k", "place", "lead", "several"],
    )
    for low in range(0, found.num_rows, ROWS):
        yield found.slice(low, ROWS)


def _places(anchored: DataFrame, parts: int) -> DataFrame:
    """``anchor, context, k, place`` of the anchors that occur twice. ``lead`` at one place of each
    context, ``several`` if the context has more."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []
        for batch in batches:
            for p, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if p != part and blocks:
                    yield from _met(part, blocks)
                    blocks = []
                part = p
                blocks.append(data.as_py())
        if blocks:
            yield from _met(part, blocks)

    ordered = anchored.repartition(parts, "part").sortWithinPartitions("part")
    schema = "anchor long, context long, k long, place long, lead boolean, several boolean"
    return ordered.mapInArrow(meet, schema)


# Contexts and suffix arrays ------------------------------------------------------------------


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``k, text`` of the wanted keys, each once. A task sends a text once at most."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, text in _unseen(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int64()), pa.array([text], pa.binary())], ["k", "text"]
            )

    sent = rows.mapInArrow(once, "k long, text binary")
    return sent.join(wanted, "k", "left_semi").dropDuplicates(["k"])


def _contexts(texts: DataFrame, places: DataFrame, length: int, width: int) -> DataFrame:
    """``anchor, context, several, k, start, data``: the bytes of each context, from one place."""
    leads = places.where("lead").groupBy("k").agg(
        F.collect_list(F.struct("anchor", "context", "several", "place")).alias("leads")
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "several", "k", "start", "data"]
        for batch in batches:
            columns = [batch.column(c) for c in ("k", "leads")]
            for k, leads, text in zip(
                columns[0].to_pylist(), columns[1], _binaries(batch.column("text")), strict=True
            ):
                leads = leads.values
                start = np.maximum(0, leads.field("place").to_numpy() - (length - width))
                data = [
                    text[s : p + length]
                    for s, p in zip(start.tolist(), leads.field("place").to_pylist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(leads.field(c) for c in names[:3]),
                        pa.array(np.full(len(start), k, np.int64)),
                        pa.array(start),
                        pa.array(data, pa.binary()),
                    ],
                    names,
                )

    schema = "anchor long, context long, several boolean, k long, start long, data binary"
    return texts.join(leads, "k").mapInArrow(cut, schema)


def _repeated(rows: list[tuple], length: int) -> list[tuple[int, int, int]]:
    """``context, from, to`` (places of its text) of what occurs twice in these contexts."""
    lengths = np.array([len(r[5]) for r in rows])
    data = np.frombuffer(b"".join(r[5] + bytes([END]) for r in rows), np.uint8)
    begins = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    change = np.zeros(len(data) + 1, np.int64)
    change[begins] += 1
    change[begins + np.maximum(0, lengths - length + 1)] -= 1
    wanted = np.cumsum(change[:-1]) > 0
    order = suffix_order(data, wanted, length)
    if not len(order):
        return []
    alike = common_prefixes(data, order, length) >= length
    run = np.flatnonzero(~alike)  # the first of each run of equal strings
    of = np.searchsorted(begins, order, "right") - 1
    key = np.array([r[3] for r in rows], np.int64)[of]
    start = np.array([r[4] for r in rows], np.int64)[of] + order - begins[of]
    several = np.array([r[2] for r in rows], bool)[of]
    # Contexts overlap, so the same place may come more than once: that is no other place.
    twice = np.logical_or.reduceat(several, run)
    for values in (key, start):
        twice |= np.minimum.reduceat(values, run) != np.maximum.reduceat(values, run)
    marked = np.repeat(twice, np.diff(np.append(run, len(order))))
    found = np.lexsort((start[marked], of[marked]))
    of, start = of[marked][found], start[marked][found]
    if not len(of):
        return []
    new = np.concatenate([[True], (of[1:] != of[:-1]) | (start[1:] > start[:-1] + length)])
    first = np.flatnonzero(new)
    ends = start[np.append(first[1:], len(of)) - 1] + length
    return [
        (rows[r][1], int(s), int(e)) for r, s, e in zip(of[first], start[first], ends, strict=True)
    ]


def _spans(contexts: DataFrame, length: int, tasks: int) -> DataFrame:
    """``context, low, high``: repeated bytes, counted from where its lead's text has it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if found := _repeated(rows, length):
                arrays = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["context", "low", "high"])

        block: list[tuple] = []
        size = 0
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if block and row[1] == block[-1][1]:
                        continue  # a context from a text whose row is there twice
                    if size >= BLOCK_BYTES and row[0] != block[-1][0]:
                        yield from emitted(block)
                        block, size = [], 0
                    block.append(row)
                    size += len(row[5])
        if block:
            yield from emitted(block)

    ordered = contexts.repartition(tasks, "anchor").sortWithinPartitions("anchor", "context")
    return ordered.mapInArrow(scan, "context long, low long, high long")


def _windows(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """``context, several, k, start, window``: each string of ``length`` bytes with the anchor in it, its
    place in the text, and a hash of its bytes, its anchor and where in it that is."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "several", "k", "start", "place", "data"]
        for batch in batches:
            for low in range(0, batch.num_rows, STEP):
                part = batch.slice(low, STEP)
                rows = []
                for anchor, context, several, k, start, place, data in zip(
                    *(part.column(c).to_pylist() for c in names), strict=True
                ):
                    head = anchor.to_bytes(8, "little", signed=True)
                    first = max(0, place + width - length - start)
                    for s in range(first, min(place - start, len(data) - length) + 1):
                        offset = (place - start - s).to_bytes(4, "little")
                        window = xxhash.xxh3_128_digest(head + offset + data[s : s + length])
                        rows.append((context, several, k, start + s, window))
                if rows:
                    kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
                    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        arrays, ["context", "several", "k", "start", "window"]
                    )

    schema = "context long, several boolean, k long, start long, window binary"
    return contexts.mapInArrow(cut, schema)


def _hot_spans(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """``context, low, high`` as ``_spans`` gives them, one for each repeated string."""
    windows = written(_windows(contexts, length, width), "repeat-windows")
    # The same place may come from more than one context: that is no other place.
    place = F.struct("k", "start")
    twice = windows.groupBy("window").agg(
        F.max("several").alias("several"), F.min(place).alias("least"), F.max(place).alias("most")
    )
    twice = written(twice.where("several or least <> most").select("window"), "repeat-twice")
    found = windows.join(twice, "window", "left_semi")
    return found.select("context", F.col("start").alias("low"), (F.col("start") + length).alias("high"))


# Results -------------------------------------------------------------------------------------


def _merged(covered: DataFrame) -> DataFrame:
    """``k, spans``: each text's removed runs as low, high, low, high."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, spans = None, []
        for batch in batches:
            ks, lows, highs = (batch.column(c).to_pylist() for c in ("k", "low", "high"))
            out: list[tuple[int, list[int]]] = []
            for k, low, high in zip(ks, lows, highs, strict=True):
                if k != key:
                    if spans:
                        out.append((key, spans))
                    key, spans = k, [low, high]
                elif low <= spans[-1]:
                    spans[-1] = max(spans[-1], high)
                else:
                    spans += [low, high]
            if out:
                yield _span_rows(out)
        if spans:
            yield _span_rows([(key, spans)])

    ordered = covered.repartition("k").sortWithinPartitions("k", "low")
    return ordered.mapInArrow(merge, "k long, spans array<long>")


def _span_rows(rows: list[tuple[int, list[int]]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.list_(pa.int64())),
        ],
        ["k", "spans"],
    )


def _kept(texts: DataFrame, merged: DataFrame) -> DataFrame:
    """``k, n_removed, n_spans, kept_sha256, kept`` of the texts that lose something."""

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k, spans, text in zip(
                batch.column("k").to_pylist(),
                batch.column("spans").to_pylist(),
                _binaries(batch.column("text")),
                strict=True,
            ):
                edges = [0, *spans, len(text)]
                kept = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                digest = hashlib.sha256(kept).hexdigest()
                rows.append((k, len(text) - len(kept), len(spans) // 2, digest, kept))
            if rows:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["k", "n_removed", "n_spans", "kept_sha256", "kept"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    schema = "k long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    return texts.join(merged, "k").mapInArrow(take, schema)


def repeats(
    docs: DataFrame,
    text_column: str = "text",
    length: int = LENGTH,
    width: int = ANCHOR,
    task_anchors: int = TASK_ANCHORS,
    hot_contexts: int = HOT_CONTEXTS,
) -> DataFrame:
    """``k, n_removed, n_spans, kept_sha256, kept`` of each distinct text that loses bytes; ``k`` is
    the text's ``xxhash64``.

    A byte goes if a string of ``length`` bytes that covers it starts anywhere else too, in this
    text, in another, or in a repeated row of this one. Null, empty and shorter texts lose nothing.
    """
    text = F.col(text_column).cast("binary")
    whole = docs.select(_text_key(F.col(text_column)).alias("k"), text.alias("text"))
    rows = whole.where(F.octet_length("text") >= length)
    counted = written(
        rows.groupBy("k").agg(F.count("*").alias("n"), F.first(F.octet_length("text")).alias("size")),
        "repeat-keys",
    )
    total = counted.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-2 * total // (length - width + 2) // task_anchors))
    places = written(_places(_anchored(rows, length, width, parts), parts), "repeat-places")
    wanted = places.select("k").distinct()
    texts = written(_texts(rows, wanted), "repeat-texts")
    found = places.where("lead").count()
    tasks = max(1, -(-found * (2 * length - width) // TASK_BYTES))
    hot = places.where("lead").groupBy("anchor").count().where(F.col("count") > hot_contexts)
    hot = written(hot.select("anchor"), "repeat-hot")
    some_hot = hot.limit(1).count() > 0
    cold = places.join(hot, "anchor", "left_anti") if some_hot else places
    spans = _spans(_contexts(texts, cold, length, width), length, tasks)
    if some_hot:
        parted = places.join(hot, "anchor", "left_semi")
        contexts = _contexts(texts, parted, length, width)
        at = parted.where("lead").select("context", "place")
        spans = spans.unionByName(_hot_spans(contexts.join(at, "context"), length, width))
    # Spans are told by the lead's places; the others of a context have them as far from theirs.
    leads = places.where("lead").select("context", F.col("place").alias("lead_place"))
    spans = written(
        spans.join(leads, "context").select(
            "context",
            (F.col("low") - F.col("lead_place")).alias("low"),
            (F.col("high") - F.col("lead_place")).alias("high"),
        ),
        "repeat-spans",
    )
    covered = places.select("context", "k", "place").join(spans, "context")
    covered = covered.select(
        "k", (F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high")
    )
    copied = counted.where("n > 1")
    kept = _kept(texts, _merged(covered.join(copied, "k", "left_anti")))
    nothing = hashlib.sha256(b"").hexdigest()
    return kept.unionByName(
        copied.select(
            "k",
            F.col("size").cast("long").alias("n_removed"),
            F.lit(1).cast("long").alias("n_spans"),
            F.lit(nothing).alias("kept_sha256"),
            F.lit(b"").alias("kept"),
        )
    )


def repeat_counts(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``id_column, n_bytes, n_removed, n_spans, kept_sha256`` for each row.

    A null text counts as empty. Repeated rows are each other's copies. A null id is an id; further
    columns are not read; an empty table gives an empty one.
    """
    lost = repeats(docs, text_column, **options).drop("kept")
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"),
        _text_key(text).alias("k"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole"),
    )
    return rows.join(lost, "k", "left").select(
        F.col("id").alias(id_column),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """The rows with what is left of their texts. A character that loses some of its bytes goes.

    Null texts stay null, equal texts lose the same, columns may have any names.
    """

    lost = repeats(docs, text_column, **options)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = [kept.decode("utf-8", "ignore") for kept in _binaries(batch.column("kept"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k"), pa.array(left, pa.string())], ["k", "kept"]
            )

    left = written(lost.select("k", "kept").mapInArrow(decode, "k long, kept string"), "repeat-kept")
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    joined = docs.select(whole, _text_key(F.col(text_column)).alias("k")).join(left, "k", "left")
    text = F.coalesce("kept", F.col("row")[text_column])
    return joined.select(
        *[(text if c == text_column else F.col("row")[c]).alias(c) for c in docs.columns]
    )
