"""Join of near-duplicate texts by the Jaccard similarity of their word shingles, with PartEnum.

Sets are put in bands of size, and a band's sets are cut alike: the domain of hashed shingles into
``m`` ranges. Two sets with a similarity of at least ``similarity`` differ in at most ``k`` elements,
``k`` following from the band's largest size; each of them spoils one range at most, so with ``m``
above ``k`` some range holds the same elements in both. The content of a range is a signature, and
near-duplicates share one. Ranges that are empty prove nothing, so what counts is that a set
*fills* more than ``k`` ranges. A set signs in its own band and, if a larger partner can be there, in
the next.

Shingles that very many sets have (a passage all over the corpus) would sign for unrelated sets.
They are left out of the ranges, which changes no proof: leaving the same shingles out of both sets
makes neither differ in more. If the others fill too few ranges, the set also signs with single
shingles, those that the fewest sets have, and with as few as prove something: of near-duplicates
that both do so, the larger lacks at most ``n - similarity * n`` of its ``n`` shingles in the other,
and the smaller, which has its size to go by, fewer still. One more each, rarest first in one order
for all, and they share one. What a set signs only as the larger one (a *probe*) pairs it with sets
that sign the same as the smaller one. So a passage signs for a set only if nearly all of the set is
passage: six sevenths, at a similarity of three quarters.

Equal sets are one class from the start, so copies are never paired. Classes that share a signature
are linked to the least of them that is no probe, not to each other; these candidates pass a bound on the difference
by parity sketches and are then compared exactly. Where members of one signature are still in
different components, pairs that would join these are compared in further rounds, a spanning forest
of each signature at a time, until none is left to compare. So components are exact. A signature
of more than ``TILE`` members is dealt out: each pair of its tiles is compared in a task of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickstar.llm.components import components
from clickstar.llm.shingles import WORDS, mixed, shingle_set
from clickstar.llm.tables import STEP, hashable, released, slices, texts, written

#: A shingle is common if at least this share of the sets has it: at most 1 / COMMON times the
#: mean set size are, which bounds what is broadcast.
COMMON = 0.0005
#: Signatures that meet in one task.
TASK_SIGNATURES = 1_000_000
#: Bits of a fine sketch to one of a coarse one.
FINE = 8
#: Members of a signature whose pairs are compared at a time.
BLOCK = 256
#: Words of sketches that are compared before a look at what is left.
STRIDE = 8
#: Members of a signature that are compared in one task, with each other or as many more.
TILE = 4096

# Sets and signatures -------------------------------------------------------------------------


@dataclass(frozen=True)
class Bands:
    """Size bands for a similarity: where they start, and into how many ranges each is cut."""

    similarity: Fraction

    def differences(self, size, other):
        """The most elements by which two similar sets of these sizes differ; sizes may be arrays."""
        same, whole = self.similarity.numerator, self.similarity.denominator
        return (whole - same) * (size + other) // (whole + same)

    def linked(self, size, other, difference):
        return difference <= self.differences(size, other)

    def starts(self, largest: int) -> list[int]:
        """A band's largest size is at least 1 / similarity of its smallest, twice over."""
        found = [1]
        while found[-1] <= largest:
            found.append(int(np.ceil(found[-1] / self.similarity**2)))
        return found

    def targets(self, size: int) -> Iterator[tuple[int, int, int]]:
        """For a set: number of a band where it signs, ranges there, most differences there."""
        starts = self.starts(size)
        own = len(starts) - 2
        for band in (own, own + 1):
            low = starts[band]
            high = int(np.ceil(low / self.similarity**2)) - 1
            if size < low and size < self.similarity * low:
                continue
            most = self.differences(high, high)
            ranges = 1 if most == 0 else int(np.ceil(1.15 * most + 6))
            partner = min(high, int(size / self.similarity))
            yield band, ranges, self.differences(size, partner)


@lru_cache(1 << 14)
def _targets(bands: Bands, size: int) -> list[tuple[int, int, int]]:
    """Sizes come again and again, and fractions are slow."""
    return list(bands.targets(size))


def _range_signatures(elements: np.ndarray, hashed: np.ndarray, ranges: int, salt: int) -> np.ndarray:
    if not len(elements):
        return elements
    place = (elements >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    content = np.add.reduceat(hashed, first)
    return mixed(content + mixed(place[first] + np.uint64(salt)))


def roles(
    elements: np.ndarray, common: np.ndarray, counts: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of a set of sorted hashes, and which of them are probes; ``common`` is sorted
    too, ``counts`` says how many sets have each."""
    often = np.zeros(len(elements), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, elements), len(common) - 1)
        often = np.where(common[at] == elements, counts[at], 0)
    rare = elements[often == 0]
    hashed = mixed(rare)
    found, few = [], False
    for band, ranges, most in _targets(bands, len(elements)):
        found.append(_range_signatures(rare, hashed, ranges, band * 4_000_037))
        few |= len(found[-1]) <= most
    probes = 0
    if few:
        n = len(elements)
        smaller = n - math.ceil(2 * bands.similarity / (1 + bands.similarity) * n) + 1
        larger = n - math.ceil(bands.similarity * n) + 1
        rarest = elements[np.lexsort((elements, often))[:larger]]
        found.append(mixed(rarest + np.uint64(2)))
        probes = larger - smaller
    signed = np.concatenate(found)
    return signed, np.arange(len(signed)) >= len(signed) - probes


def signatures(elements: np.ndarray, common: np.ndarray, bands: Bands) -> np.ndarray:
    """All signatures of a set, with common shingles that equally many sets have."""
    return roles(elements, common, np.ones(len(common), np.int64), bands)[0]


def class_of(elements: np.ndarray) -> int:
    """A number for the content of a set."""
    total = np.add.reduce(mixed(elements ^ np.uint64(0x5851F42D4C957F2D)))
    return int(mixed(np.array([total + np.uint64(len(elements))], np.uint64)).view(np.int64)[0])


def sketch(elements: np.ndarray, fineness: int = 1) -> np.ndarray:
    """Of each bucket the parity of how many elements fall in it: two sets differ in at least as
    many elements as their sketches in bits, and hardly in more if buckets are many. Two to four
    bits an element, a power of two, times ``fineness``, one too."""
    width = fineness * max(64, 1 << (2 * len(elements) - 1).bit_length())
    odd = np.bincount((elements & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """A sketch of fewer buckets, a power of two of words."""
    return np.bitwise_xor.reduce(bits.reshape(-1, words), axis=0)


def fewest_differences(a: np.ndarray, b: np.ndarray) -> int:
    words = min(len(a), len(b))
    return int(np.bitwise_count(folded(a, words) ^ folded(b, words)).sum())


def fewest_of_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """``fewest_differences`` of each pair of sketches, those of like widths together."""
    fewest = np.zeros(len(a), np.int64)
    widths = np.array([(len(x) // 8, len(y) // 8) for x, y in zip(a, b, strict=True)])
    for width in set(map(tuple, widths.tolist())):
        at = np.flatnonzero((widths == width).all(axis=1))
        bits = [
            np.bitwise_xor.reduce(
                np.frombuffer(b"".join([sketches[k] for k in at]), "<u8").reshape(len(at), -1, min(width)),
                axis=1,
            )
            for sketches in (a, b)
        ]
        fewest[at] = np.bitwise_count(bits[0] ^ bits[1]).sum(axis=1)
    return fewest


def differing(a: bytes, b: bytes) -> int:
    """In how many elements two sets differ."""
    both = np.sort(np.frombuffer(a + b, "<u8"))
    return len(both) - 2 * int(np.count_nonzero(both[1:] == both[:-1]))


# Steps over tables ---------------------------------------------------------------------------


def _sets(rows: DataFrame, width: int) -> DataFrame:
    """Each row's ``id, t, n, c, sketch, fine``: ``t`` as it comes, size, class and two sketches of its
    set; and, as rows with ``h``, the shingles that many sets of a batch have, with their number (``n``)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, coarse, fine, seen = [], [], [], [], {}
            for text in texts(batch.column("text")):
                elements = shingle_set(text, width)
                sizes.append(len(elements))
                classes.append(class_of(elements) if len(elements) else 0)
                bits = sketch(elements, FINE) if len(elements) else None
                fine.append(None if bits is None else bits.astype("<u8").tobytes())
                if bits is not None:
                    bits = folded(bits, len(bits) // FINE).astype("<u8").tobytes()
                coarse.append(bits)
                if len(elements):
                    seen.setdefault(classes[-1], elements)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("t"),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    pa.array(coarse, pa.binary()),
                    pa.array(fine, pa.binary()),
                    pa.nulls(n, pa.int64()),
                ],
                ["id", "t", "n", "c", "sketch", "fine", "h"],
            )
            if seen:
                every, counts = np.unique(np.concatenate(list(seen.values())), return_counts=True)
                often = counts >= max(3, COMMON * n)
                m = int(often.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(m, batch.column("id").type),
                        pa.nulls(m, pa.int64()),
                        pa.array(counts[often], pa.int64()),
                        pa.nulls(m, pa.int64()),
                        pa.nulls(m, pa.binary()),
                        pa.nulls(m, pa.binary()),
                        pa.array(every[often].view(np.int64)),
                    ],
                    ["id", "t", "n", "c", "sketch", "fine", "h"],
                )

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(released(scan), f"id {kind}, t long, n long, c long, sketch binary, fine binary, h long")


def _signed(rows: DataFrame, width: int, bands: Bands, common, tasks: int) -> DataFrame:
    """The signatures of each slice's classes as ``part, data``: one block for each task they go
    to, with the classes, how many signatures each has there, and these as 31 bits and one that is
    set for a probe. ``common`` is a broadcast of the common shingles and their counts."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, "text")):
            seen: dict[int, np.ndarray] = {}
            for text in texts(batch.column("text")):
                elements = shingle_set(text, width)
                if len(elements):
                    c = class_of(elements)
                    if c not in seen:
                        s, probe = roles(elements, *common.value, bands)
                        seen[c] = s & ~np.uint64(1) | probe
            if not seen:
                continue
            classes = np.fromiter(seen, np.int64, len(seen))
            owner = np.repeat(np.arange(len(seen)), [len(s) for s in seen.values()])
            signed = np.concatenate(list(seen.values()))
            part = ((signed >> np.uint64(32)) * np.uint64(tasks) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            owner, signed, part = owner[order], signed[order].astype("<u4"), part[order]
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            blocks = []
            for start, end in zip(first, np.append(first[1:], len(part)), strict=True):
                has, counts = np.unique(owner[start:end], return_counts=True)
                head = np.array([len(has)], "<i8").tobytes()
                blocks.append(
                    head
                    + classes[has].astype("<i8").tobytes()
                    + counts.astype("<u4").tobytes()
                    + signed[start:end].tobytes()
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array(part[first], pa.int32()), pa.array(blocks, pa.binary())], ["part", "data"]
            )

    return rows.mapInArrow(released(sign), "part int, data binary")


def _unblocked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int(np.frombuffer(data, "<i8", 1)[0])
    classes = np.frombuffer(data, "<i8", n, 8)
    counts = np.frombuffer(data, "<u4", n, 8 + 8 * n)
    return np.frombuffer(data, "<u4", -1, 8 + 12 * n), np.repeat(classes, counts)


def _met(part: int, blocks: list[bytes]) -> Iterator[pa.RecordBatch]:
    pairs = [_unblocked(block) for block in blocks]
    signed = np.concatenate([p[0] for p in pairs])
    classes = np.concatenate([p[1] for p in pairs])
    probe, signed = (signed & 1).astype(bool), signed >> 1

    def starts(*columns: np.ndarray) -> np.ndarray:
        changed = np.any([c[1:] != c[:-1] for c in columns], axis=0)
        return np.concatenate([[True], changed])

    order = np.lexsort((probe, classes, signed))
    order = order[starts(signed[order], classes[order])]
    order = order[np.lexsort((classes[order], probe[order], signed[order]))]
    signed, classes, probe = signed[order], classes[order], probe[order]
    first = np.flatnonzero(starts(signed))
    counts = np.diff(np.append(first, len(signed)))
    lead = np.repeat(classes[first], counts)
    # Where all are probes, none is paired.
    met = ~np.repeat(probe[first], counts)
    other = met & (lead != classes)
    edges = np.unique(np.sort(np.stack([lead[other], classes[other]], axis=1), axis=1), axis=0)
    # The lead is compared with all others as it is, so what remains are pairs of the others.
    many = other & np.repeat(counts >= 3, counts)
    keys = (np.int64(part) << np.int64(32)) + signed.astype(np.int64)
    for kind, x, y in (
        (0, edges[:, 0], edges[:, 1]),
        (1, keys[many & ~probe], classes[many & ~probe]),
        (2, keys[many & probe], classes[many & probe]),
    ):
        if len(x):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y)],
                ["kind", "x", "y"],
            )


def _meetings(signed: DataFrame, tasks: int) -> DataFrame:
    """Kind 0: ``x`` and ``y`` the least class of a signature that is no probe, and another one. Kind
    1: ``x`` a signature of three or more classes, ``y`` one of these others. Kind 2: the same, a
    probe."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []
        for batch in batches:
            for p, data in zip(*(batch.column(k).to_pylist() for k in (0, 1)), strict=True):
                if p != part and blocks:
                    yield from _met(part, blocks)
                    blocks = []
                part = p
                blocks.append(data)
        if blocks:
            yield from _met(part, blocks)

    ordered = signed.repartition(tasks, "part").sortWithinPartitions("part")
    return ordered.mapInArrow(meet, "kind int, x long, y long")


def _elements(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """``c, n, elements`` of the classes in ``wanted`` (``c, id``), from the text of a member."""
    rows = docs.join(wanted, "id").select("c", "text")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sizes, sets = [], [], []
            for c, text in zip(
                batch.column("c").to_pylist(), texts(batch.column("text")), strict=True
            ):
                elements = shingle_set(text, width)
                # An id may stand for several texts; only one with this very set will do.
                if len(elements) and class_of(elements) == c:
                    classes.append(c)
                    sizes.append(len(elements))
                    sets.append(elements.astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(classes, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(sets, pa.binary()),
                ],
                ["c", "n", "elements"],
            )

    return rows.mapInArrow(released(build), "c long, n long, elements binary").dropDuplicates(["c"])


def _beside(pairs: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """``x, y`` with the size and ``column`` of both."""
    of_x = classes.select(
        F.col("c").alias("x"), F.col("n").alias("n_x"), F.col(column).alias("of_x")
    )
    of_y = classes.select(
        F.col("c").alias("y"), F.col("n").alias("n_y"), F.col(column).alias("of_y")
    )
    return pairs.join(of_x, "x").join(of_y, "y")


def _compared(pairs: DataFrame, classes: DataFrame, bands: Bands, exact: bool) -> DataFrame:
    """The pairs that their sketches do not rule out, or that their sets prove."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, STEP):
                part = batch.slice(start, STEP)
                sizes = [part.column(c).to_numpy() for c in ("n_x", "n_y")]
                x, y = (part.column(c).to_pylist() for c in ("of_x", "of_y"))
                if exact:
                    apart = np.array(list(map(differing, x, y)), np.int64)
                else:
                    apart = fewest_of_pairs(x, y)
                found = part.filter(pa.array(bands.linked(*sizes, apart)))
                yield found.select(["x", "y"])

    column = "elements" if exact else "sketch"
    return _beside(pairs, classes, column).mapInArrow(compare, "x long, y long")


def _across(
    rows: list[tuple],
    bands: Bands,
    forests: int,
    left: range | None = None,
    right: int = 1,
    open_: np.ndarray | None = None,
) -> list[tuple[int, int]]:
    """Pairs of a signature's members (``key, c, root, n, sketch, failed, probe``) that their
    sketches do not rule out and that join components: up to ``forests`` spanning forests of them.
    Members in ``left`` are paired with those from ``right`` on that come after them, probes not
    with each other; without ``left``, the first member has been compared with all others before.
    Each has been with its ``failed``. In ``open_``, if given, all members are marked that have a
    pair which their sketches do not rule out, whether it is needed for a forest or not."""
    left = left or range(1, len(rows))
    probe = np.array([len(r) > 6 and r[6] for r in rows], bool)
    words = min(len(r[4]) for r in rows) // 8
    bits = np.stack([folded(np.frombuffer(r[4], "<u8"), words) for r in rows])
    c, root, n = (np.array([r[k] for r in rows], np.int64) for k in (1, 2, 3))
    share = (1 - bands.similarity) / (1 + bands.similarity)
    place = {int(x): k for k, x in enumerate(c)}
    tried = {(k, place[y]) for k, r in enumerate(rows) for y in r[5] or () if y in place}
    labels = np.stack([root] * forests)
    found: list[tuple[int, int]] = []
    for i in left[::BLOCK]:
        for j in range(max(i, right), len(rows), BLOCK):
            a, b = slice(i, min(i + BLOCK, left.stop)), slice(j, j + BLOCK)
            apart = root[a, None] != root[None, b]
            apart &= ~(probe[a, None] & probe[None, b])
            unjoined = (labels[:, a, None] != labels[:, None, b]).any(axis=0)
            if not (apart if open_ is not None else apart & unjoined).any():
                continue
            most = (n[a, None] + n[None, b]) * share.numerator // share.denominator
            odd, near = np.zeros(apart.shape, np.uint32), apart
            # Differences only add up, so a block of unlike sets is done after a part of the words.
            for start in range(0, words, STRIDE):
                for w in range(start, min(start + STRIDE, words)):
                    odd += np.bitwise_count(bits[a, None, w] ^ bits[None, b, w])
                near = apart & (odd <= most)
                if not near.any():
                    break
            apart = near
            if open_ is not None:
                open_[a] |= apart.any(axis=1)
                open_[b] |= apart.any(axis=0)
            apart &= unjoined
            for x, y in zip(*np.nonzero(apart), strict=True):
                x, y = int(i + x), int(j + y)
                if x >= y or (x, y) in tried or (y, x) in tried:
                    continue
                for label in labels:
                    if label[x] != label[y]:
                        label[label == label[y]] = label[x]
                        found.append((int(c[x]), int(c[y])))
                        break
    return found


def _dealt(members: DataFrame) -> DataFrame:
    """The members of each signature (``key, c, tiles, ...``) once for each pair ``i, j`` of its tiles
    that they take part in; ``at`` is their own."""
    at = F.pmod(F.xxhash64("c"), F.col("tiles")).cast("int")
    dealt = members.withColumn("at", at)
    dealt = dealt.withColumn("o", F.explode(F.expr("sequence(0, cast(tiles as int) - 1)")))
    return dealt.withColumns({"i": F.least("at", "o"), "j": F.greatest("at", "o")}).drop("o")


def _pairs_across(members: DataFrame, bands: Bands, forests: int) -> DataFrame:
    """``key, x, y``: for each signature the pairs that ``_across`` finds; and, without ``y``, the
    members that it leaves open. A task holds the sketches of two tiles at a time, and gives no more
    pairs than ``forests`` times their members."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(rows) < 2:
                return
            _, i, j = rows[0][-3:]
            if i == j:  # probes come last
                left, right = range(sum(not r[6] for r in rows)), 1
            else:
                right = sum(r[-3] == i for r in rows)
                left = range(right)
            marks = np.zeros(len(rows), bool)
            if left and (pairs := _across(rows, bands, forests, left, right, marks)):
                found = [(rows[0][0], x, y) for x, y in pairs]
                found += [(rows[0][0], rows[k][1], None) for k in np.flatnonzero(marks)]
                columns = zip(*found, strict=True)
                arrays = [pa.array(column, pa.int64()) for column in columns]
                yield pa.RecordBatch.from_arrays(arrays, ["key", "x", "y"])

        group: list[tuple] = []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if group and (group[0][0], *group[0][-2:]) != (row[0], *row[-2:]):
                    yield from emitted(group)
                    group = []
                group.append(row)
        yield from emitted(group)

    columns = ["key", "c", "root", "n", "sketch", "failed", "probe", "at", "i", "j"]
    ordered = _dealt(members).select(*columns).repartition("key", "i", "j")
    ordered = ordered.sortWithinPartitions("key", "i", "j", "at", "probe", "c")
    return ordered.mapInArrow(released(stream), "key long, x long, y long")


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, width: int, bands: Bands):
    """Those of the candidate pairs that are near-duplicates, as ``a, b``."""
    wanted = pairs.select(F.explode(F.array("x", "y")).alias("c")).distinct()
    wanted = wanted.join(classes.select("c", "id"), "c")
    sets = written(_elements(docs, wanted, width), "jaccard-elements")
    links = written(_compared(pairs, sets, bands, exact=True), "jaccard-links")
    return links.select(F.col("x").alias("a"), F.col("y").alias("b"))


def _text_number(text: Column) -> Column:
    """A number for a text, by which rows that share an id are told apart."""
    return F.xxhash64(text)


def _labelled(
    docs: DataFrame,
    similarity: Fraction = Fraction(3, 4),
    width: int = WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
    task_signatures: int = TASK_SIGNATURES,
    tile: int = TILE,
) -> DataFrame:
    """``id, t, n, c, root, component_id`` of each row: its text's number, the size and class of its
    set, and its component's least class and least id. The last three are null of a row that is
    linked with nothing by definition, but for the id that is its component's."""
    bands = Bands(similarity)
    sc = docs.sparkSession.sparkContext
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    numbered = rows.withColumn("t", _text_number(F.col("text")))
    scanned = written(_sets(numbered, width), "jaccard-sets")
    sets = scanned.where(F.col("h").isNull()).select("id", "t", "n", "c", "sketch", "fine")
    linkable = sets.where((F.col("n") > 0) & F.col("id").isNotNull())
    n_rows, n_shingles = linkable.agg(F.count("*"), F.sum("n")).first()
    often = scanned.where(F.col("h").isNotNull()).groupBy("h").agg(F.sum("n").alias("n"))
    often = often.where(F.col("n") >= max(5, COMMON * n_rows)).select("h", "n").toArrow()
    common = often.column("h").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(common)
    common = common[order], often.column("n").to_numpy().astype(np.int64)[order]
    tasks = max(1, -(-(n_shingles or 0) // task_signatures))

    known = rows.where(F.col("id").isNotNull())
    signed = _signed(known, width, bands, sc.broadcast(common), tasks)
    met = written(_meetings(signed, tasks), "jaccard-meetings")
    stars = written(met.where("kind = 0").select("x", "y").distinct(), "jaccard-stars")
    members = linkable.groupBy("c").agg(
        F.min("id").alias("id"), *[F.first(c).alias(c) for c in ("n", "sketch", "fine")]
    )
    classes = written(members, "jaccard-classes")
    near = written(_compared(stars, classes, bands, exact=False), "jaccard-near")
    links = _links(near, known, classes, width, bands)
    roots = components(links)

    # Signatures whose members are in more than one component: their pairs are compared as far as
    # they join components, and those that fail are left out of the next round. Components with a
    # pair that sketches let through hang together by pairs that were compared; so where none of
    # these failed a signature is done, and elsewhere only members that had such a pair go on. They
    # are few, and fine sketches let hardly a wrong pair through.
    every = met.where("kind > 0")
    every = every.select(F.col("x").alias("key"), F.col("y").alias("c"), (F.col("kind") == 2).alias("probe"))
    bits = classes.select("c", "n", "sketch")
    failed, forests = None, 1
    while True:
        members = every.join(roots.withColumnRenamed("node", "c"), "c", "left")
        members = members.withColumn("root", F.coalesce("root", "c"))
        several = members.groupBy("key").agg(
            F.min("root").alias("r"), F.max("root").alias("s"), F.ceil(F.count("*") / tile).alias("tiles")
        )
        several = several.where("r <> s").select("key", "tiles")
        narrow = written(members.join(several, "key"), "jaccard-members")
        members = narrow.join(bits, "c")
        if failed is None:
            members = members.withColumn("failed", F.lit(None).cast("array<long>"))
        else:
            tried = failed.groupBy(F.col("x").alias("c")).agg(F.collect_set("y").alias("failed"))
            members = members.join(tried, "c", "left")
        met_across = written(_pairs_across(members, bands, forests), "jaccard-across")
        across = met_across.where("y is not null")
        across = across.select("key", F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        pairs = across.select("x", "y").distinct()
        if across.isEmpty():
            break
        more = _links(pairs, known, classes, width, bands)
        wrong = pairs.join(more, (F.col("x") == F.col("a")) & (F.col("y") == F.col("b")), "left_anti")
        wrong = written(wrong, "jaccard-failed")
        links = written(links.unionByName(more), "jaccard-links")
        roots = components(links)
        if wrong.isEmpty():
            break
        failed = wrong if failed is None else failed.unionByName(wrong)
        undone = across.join(wrong, ["x", "y"], "left_semi").select("key").distinct()
        going = met_across.where("y is null").join(undone, "key", "left_semi")
        going = going.select("key", F.col("x").alias("c")).distinct()
        every = narrow.join(going, ["key", "c"], "left_semi").select("key", "c", "probe")
        bits = classes.select("c", "n", F.col("fine").alias("sketch"))
        forests *= 2

    of_class = classes.select("c", "id").join(roots.withColumnRenamed("node", "c"), "c", "left")
    of_class = of_class.withColumn("root", F.coalesce("root", "c"))
    least = of_class.groupBy("root").agg(F.min("id").alias("component_id"))
    labelled = of_class.join(least, "root").select("c", "root", "component_id")
    labelled = written(labelled, "jaccard-labels")
    alone = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    in_set = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("c"))
    joined = sets.select("id", "t", "n", in_set.alias("c")).join(labelled, "c", "left")
    return joined.select("id", "t", "n", "c", "root", alone.alias("component_id"))


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """``id_column, n_shingles, class_id, component_id`` for each row.

    ``n_shingles`` is the size of the row's set; ``component_id`` the least id reachable by links
    between sets of at least ``similarity``, its own included. A row without words has an empty
    set and is linked with nothing, and so is one without an id, whose component is null. Repeated
    rows are members of one class, and rows that share an id but not their text of several.
    Further columns are not read; an empty table gives an empty one. ``options``: ``similarity``,
    ``width`` in words, and how much meets in a task (``task_signatures``, ``tile``).
    """
    found = _labelled(docs, id_column=id_column, text_column=text_column, **options)
    return found.select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.col("c").alias("class_id"),
        "component_id",
    )


def one_of_each(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options
) -> DataFrame:
    """The rows, with all columns, of one document of each component: that with the least id.

    A document is an id and a text. Of several texts with the least id in one component, one is kept,
    and of rows that repeat it one. Rows without an id and rows without words are linked with nothing
    and are all kept, whatever other rows share their id. Columns may have any names.
    """
    found = _labelled(docs, id_column=id_column, text_column=text_column, **options)
    of_component = found.where(F.col("root").isNotNull()).groupBy("root")
    keeps = of_component.agg(F.min(F.struct("id", "t")).alias("kept")).select(
        F.col("kept.id").alias("kept_id"), F.col("kept.t").alias("kept_t")
    )
    keeps = keeps.distinct()
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = docs.select(
        row,
        F.col(id_column).alias("id"),
        _text_number(F.col(text_column)).alias("t"),
        F.coalesce(F.col(text_column).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)).alias("worded"),
    )
    linkable = F.col("worded") & F.col("id").isNotNull()
    same = (F.col("id") == F.col("kept_id")) & (F.col("t") == F.col("kept_t"))
    kept = rows.where(linkable).join(keeps, same, "left_semi")
    # Rows alike in id and text may differ elsewhere; the number of the whole row tells which stays.
    whole = F.xxhash64(*[F.col("row")[f.name] for f in docs.schema if hashable(f.dataType)])
    first = kept.groupBy("id", "t").agg(F.min_by("row", whole).alias("row")).select("row.*")
    return first.unionByName(rows.where(~linkable).select("row.*"))
