"""All pairs of near vectors, by products within cells that near vectors share.

A small table is cut into shards, and every shard meets every other in a task that takes all products:
no pair is missed. Products of all with all grow with the square of the table, so a larger one is dealt
out by hash tables: a vector's shard is the one of some random directions, or its opposite, that it
points to most, which two near vectors often share and others seldom do. Within a shard further such
hashes make cells, and all products are taken within a cell. Whether two vectors share a cell depends
on their cosine and on the draw of the directions alone, so tables are drawn until a pair at the
threshold is missed by all of them with a chance of ``MISSED`` at most, whatever the table holds.

Products are taken in single precision, and again in double precision near the threshold. Hashes are
sums of whole numbers that single precision holds exactly, so each task finds the same ones. A pair
that shares several cells is counted in the first of them.

A large group of near vectors would cost the square of its size in each table. So vectors near the
centre of such a group meet each other once, apart from the tables, which leave out pairs of one group.
In its ball, nearer to the centre than half the threshold's angle, all are linked with each other, as
angles add up, and need no products. Centres come from a drawn sample, which decides where a pair is
found, and no result.
"""

from __future__ import annotations

import gc
import math
import time
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar.llm.tables import released, written

#: Chance at most that a pair just at the threshold shares no cell.
MISSED = 1e-6
#: Up to so many shards all meet all; shards have so many vectors at least if there are several, and
#: so many bytes at most on average, in single precision.
EXACT_SHARDS, LEAST_SHARD, SHARD_BYTES = 5, 2_048, 8 << 20
#: Tables of a round, whose shuffle files go before the next; bytes and least number of the tasks
#: that take products.
ROUND, TASK_BYTES, LEAST_PARTS = 3, 48 << 20, 12
#: Bytes of vectors that are dealt out at a time, and rows hashed and multiplied at a time.
GATHERED, HASHED, ROWS, WIDE = 8 << 20, 2_048, 128, 2_048
#: Links that are counted at a time.
COUNTED = 500_000
#: Vectors and bytes of the sample; of its vectors a group has so many, and there are so many groups.
SAMPLE, SAMPLE_BYTES, LEAST_GROUP, MOST_GROUPS = 8_192, 16 << 20, 8, 256
#: In place of a table's number, for the meetings of groups.
GROUPS = -1
#: Whole numbers for a length of 1: of a vector that is hashed or put into a group, of a centre, and
#: for the deviation 1 of a direction's components. Their products stay below 2^24.
HASH_SCALE, GROUP_SCALE, CENTRE_SCALE, DIRECTION_SCALE = 1 << 10, 1 << 12, 1 << 11, 1 << 5
#: Seconds, as measured, of a product of two components, of a vector's copy, and of one in a cell.
#: Cells come out uneven, so that a vector meets so many times the mean size of one.
_PRODUCT, _COPY, _MEMBER, _UNEVEN = 5.3e-11, 5e-6, 4.5e-7, 1.4


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors in double precision and scaled to length 1. The largest component is divided out
    first, lest squares overflow or vanish."""
    wide = vectors.astype(np.float64)
    scaled = wide / np.abs(wide).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


# Hashes -----------------------------------------------------------------------------------------


@lru_cache(maxsize=512)
def _directions(size: int, width: int, table: int, cell: int) -> np.ndarray:
    drawn = np.random.default_rng([7, size, width, table, cell]).standard_normal((size, width))
    return np.rint(drawn * DIRECTION_SCALE).astype(np.float32)


def hashes(whole: np.ndarray, width: int, table: int, cell: int) -> np.ndarray:
    """For each vector the one of ``width`` directions and their opposites that it points to most."""
    found = np.zeros(len(whole), np.int32)
    if not width:
        return found
    to = _directions(whole.shape[1], width, table, cell)
    for low in range(0, len(whole), HASHED):
        along = whole[low : low + HASHED] @ to
        rows, most, least = np.arange(len(along)), along.argmax(axis=1), along.argmin(axis=1)
        found[low : low + HASHED] = np.where(
            along[rows, most] >= -along[rows, least], most, least + width
        )
    return found


def whole(units: np.ndarray, scale: int = HASH_SCALE) -> np.ndarray:
    return np.rint(units * scale).astype(np.float32)


@lru_cache(maxsize=512)
def shared(width: int, cosine: float) -> float:
    """The chance that two vectors of this cosine have a hash in common, or a little less: along
    random directions they are normal numbers so correlated, whatever their length."""
    if not width:
        return 1.0
    rng, met, drawn = np.random.default_rng(11), 0, 100_000
    step = max(1, min(drawn, 1_000_000 // width))
    for low in range(0, drawn, step):
        a = rng.standard_normal((min(step, drawn - low), width), np.float32)
        b = cosine * a + math.sqrt(1 - cosine**2) * rng.standard_normal(a.shape, np.float32)
        rows, most = np.arange(len(a)), np.abs(a).argmax(axis=1)
        met += ((most == np.abs(b).argmax(axis=1)) & (a[rows, most] * b[rows, most] > 0)).sum()
    return max(0.0, met / drawn - 3 * math.sqrt(max(met, 1) / drawn**2))


class Plan(NamedTuple):
    """For vectors of one size: tables and directions that deal them to shards, and hashes and
    directions that make cells of a shard. No directions: all are one shard or cell."""

    tables: int = 1
    width: int = 0
    cells: int = 1
    cell_width: int = 0


def planned(size: int, count: int, threshold: float, shard_vectors: int) -> Plan:
    """The cheapest plan by estimate that misses a pair with a chance of ``MISSED`` at most."""
    product = _PRODUCT * size
    best, least = Plan(), count * product / 2
    shards = -(-count // shard_vectors)
    if shards <= EXACT_SHARDS or not 0 < threshold < 1:
        return best
    width = -(-shards // 2)
    dealt = shared(width, threshold)
    for cell_width in (0, 16, 32, 64, 128, 256):
        once = shared(cell_width, threshold)
        for cells in range(1, 13 if cell_width else 2):
            found = dealt * (1 - (1 - once) ** cells)
            if not found:
                continue
            tables = 1 if found == 1 else math.ceil(math.log(MISSED) / math.log(1 - found))
            size_of_cell = count / (2 * width) / max(1, 2 * cell_width)
            cell = _MEMBER + product * (cell_width + size_of_cell * (_UNEVEN if cell_width else 0.5))
            cost = tables * (_COPY + product * width + cells * cell)
            if cost < least:
                best, least = Plan(tables, width, cells, cell_width), cost
    return best


# Groups -----------------------------------------------------------------------------------------


def grouped(units: np.ndarray, centres: np.ndarray, threshold: float) -> np.ndarray:
    """For each vector twice the number of its group, and one more if it is in the group's ball, or
    -1; the same wherever it is asked."""
    found = np.full(len(units), -1, np.int16)
    one = GROUP_SCALE * CENTRE_SCALE
    # The ball's edge allows for what whole numbers leave out of a vector and of a centre.
    rounded = math.sqrt(units.shape[1]) / 2 * (1 / GROUP_SCALE + 1 / CENTRE_SCALE)
    ball = math.sqrt((1 + threshold) / 2) + rounded + 1e-6
    for low in range(0, len(units) if len(centres) else 0, HASHED):
        along = whole(units[low : low + HASHED], GROUP_SCALE) @ centres.T
        best = along.argmax(axis=1)
        near = along[np.arange(len(along)), best]
        name = 2 * best + (near >= ball * one)
        found[low : low + HASHED] = np.where(near >= min(threshold, ball) * one, name, -1)
    return found


def centres_of(units: np.ndarray, threshold: float) -> np.ndarray:
    """Centres of the large groups of a sample, as whole numbers."""
    single = units.astype(np.float32)
    linked = np.zeros((len(units), len(units)), bool)
    for low in range(0, len(units), 1_024):
        linked[low : low + 1_024] = single[low : low + 1_024] @ single.T >= threshold
    degrees = linked.sum(axis=1)
    left, centres = np.ones(len(units), bool), []
    while len(centres) < MOST_GROUPS and len(units):
        first = int(np.where(left, degrees, 0).argmax())
        group = linked[first] & left
        if group.sum() < LEAST_GROUP:
            break
        middle = units[group].sum(axis=0, keepdims=True)
        if middle.any():
            centre = whole(unit(middle), CENTRE_SCALE)
            inside = (grouped(units, centre, threshold) >= 0) & left
            if inside.sum() >= LEAST_GROUP:
                centres.append(centre)
                group |= inside
        left &= ~group
        degrees = degrees - linked[:, group].sum(axis=1)
    return np.concatenate(centres) if centres else np.zeros((0, units.shape[1]), np.float32)


# Dealing out ------------------------------------------------------------------------------------


class _Dealt(NamedTuple):
    """A table of a round, or the groups: for each shard its first task number, and the blocks it is
    cut into."""

    size: int
    table: int
    first: np.ndarray
    blocks: np.ndarray


def _meetings(blocks: int) -> int:
    return blocks * (blocks + 1) // 2


def _meeting(a: np.ndarray, b: np.ndarray, blocks: np.ndarray | int) -> np.ndarray:
    """The number of the meeting of two blocks, the first no greater than the second."""
    return a * blocks - a * (a - 1) // 2 + b - a


def _rows(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Sizes of a batch, and the keys, weights and vectors of each."""
    sizes = batch.column("size").to_numpy()
    for size in np.unique(sizes):
        part = batch if (sizes == size).all() else batch.filter(pa.array(sizes == size))
        column = part.column("bytes")
        # The bytes of all rows in a row, none of which is null.
        _, offsets, data = column.buffers()
        wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        start = np.frombuffer(offsets, wide)[column.offset]
        raw = np.frombuffer(data, kind, len(part) * size, start).reshape(len(part), size)
        yield int(size), part.column("k").to_numpy(), part.column("members").to_numpy(), raw


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches put together to some bytes, so that each shard's part of them has several vectors."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        waiting.append(batch)
        if sum(b.nbytes for b in waiting) >= GATHERED:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting = []
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


def _dealt(
    classes: DataFrame,
    kind: str,
    tables: list[_Dealt],
    plans: dict[int, Plan],
    centres: dict[int, np.ndarray],
    threshold: float,
) -> DataFrame:
    """``task, side, block``: parts of the table, each for a task; of a task's two sides the first
    is also met by itself if there is no second."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _gathered(batches):
            for size, keys, weights, raw in _rows(batch, kind):
                numbers, group = np.empty(raw.shape, np.float32), np.empty(len(raw), np.int16)
                for low in range(0, len(raw), HASHED):
                    units, part = unit(raw[low : low + HASHED]), slice(low, low + HASHED)
                    numbers[part], group[part] = whole(units), grouped(units, centres[size], threshold)
                hashed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
                out: list[list] = [[], [], [], []]
                for dealt in tables:
                    if dealt.size != size:
                        continue
                    if dealt.table == GROUPS:
                        rows = np.flatnonzero(group >= 0)
                        shard = group[rows] >> 1
                    else:
                        rows = np.arange(len(keys))
                        shard = hashes(numbers, plans[size].width, dealt.table, 0)
                    if not len(rows):
                        continue
                    blocks = dealt.blocks[shard]
                    own = (hashed[rows] % blocks.astype(np.uint64)).astype(np.int64)
                    row = np.repeat(np.arange(len(rows)), blocks)
                    other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
                    low, high = np.minimum(own[row], other), np.maximum(own[row], other)
                    task = dealt.first[shard[row]] + _meeting(low, high, blocks[row])
                    side, row = task * 2 + (own[row] > other), rows[row]
                    order = np.argsort(side, kind="stable")
                    row, side = row[order], side[order]
                    cuts = np.flatnonzero(np.diff(side)) + 1
                    columns = keys[row], weights[row], raw[row], group[row]
                    for low, high in zip([0, *cuts], [*cuts, len(row)], strict=True):
                        out[0].append(int(side[low]) >> 1)
                        out[1].append(int(side[low]) & 1)
                        out[2].append(size)
                        out[3].append(b"".join(c[low:high].tobytes() for c in columns))
                if out[0]:
                    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.binary()]
                    arrays = [pa.array(c, t) for c, t in zip(out, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, ["task", "side", "size", "block"])

    schema = "task int, side int, size int, block binary"
    return classes.select("k", "members", "size", "bytes").mapInArrow(deal, schema)


def _read(blocks: list[bytes], size: int, kind: str) -> tuple[np.ndarray, ...]:
    """Keys, weights, vectors and groups of some blocks."""
    width = np.dtype(kind).itemsize * size
    parts: list[list[np.ndarray]] = [[], [], [], []]
    for block in blocks:
        n = len(block) // (18 + width)
        parts[0].append(np.frombuffer(block, "<i8", n))
        parts[1].append(np.frombuffer(block, "<i8", n, 8 * n))
        parts[2].append(np.frombuffer(block, kind, n * size, 16 * n).reshape(n, size))
        parts[3].append(np.frombuffer(block, "<i2", n, 16 * n + width * n))
    return tuple(np.concatenate(p) for p in parts)


# Products ---------------------------------------------------------------------------------------


class _Meeting:
    """What a task finds among its vectors: how many rows each is linked with by pairs that are
    counted here, and which of them belong together."""

    def __init__(
        self, sides: list[list[bytes]], size: int, kind: str, plan: Plan, table: int, threshold: float
    ):
        self.plan = Plan() if table == GROUPS else plan
        self.table, self.threshold = table, threshold
        read = [_read(blocks, size, kind) for blocks in sides if blocks]
        columns = [np.concatenate(c) for c in zip(*read, strict=True)]
        self.keys, self.weights, self.raw, group = columns
        # Those of one number have met: in their ball, or apart from the tables in their group.
        settled = group % 2 == 1 if table == GROUPS else group >= 0
        self.settled = np.where(settled, group >> 1, MOST_GROUPS).astype(np.int64)
        self.side = np.repeat(np.arange(len(read), dtype=np.int64), [len(r[0]) for r in read])
        self.alone = len(read) < 2
        n = len(self.keys)
        self.single = np.empty((n, size), np.float32)
        self.whole = np.empty((n, size), np.float32)
        for low in range(0, n, HASHED):
            units = unit(self.raw[low : low + HASHED])
            self.single[low : low + HASHED] = units
            self.whole[low : low + HASHED] = whole(units)
        # Of sums of so many products of components in single precision, and of their rounding.
        self.error = (size + 8) * 2.0**-23
        self.count = np.zeros(n)
        self.root = np.arange(n)
        self.cells: list[np.ndarray] = []
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def found(self) -> pa.RecordBatch:
        for cell in range(self.plan.cells):
            self.cells.append(self._cell(slice(None), self.table, cell))
            self._cells_met(self.cells[-1])
            self._counted()
        some = np.flatnonzero(self.count)
        columns = self.keys[some], self.keys[self._rooted(some)], self.count[some].astype(np.int64)
        arrays = [pa.array(c, pa.int64()) for c in columns]
        return pa.RecordBatch.from_arrays(arrays, ["k", "other", "n"])

    def _cell(self, rows: slice | np.ndarray, table: int, cell: int) -> np.ndarray:
        return hashes(self.whole[rows], self.plan.cell_width, table, cell + 1)

    def _cells_met(self, cell: np.ndarray) -> None:
        """Products within each cell, of the two sides if there are two."""
        place = (cell.astype(np.int64) * 2 + self.side) * (MOST_GROUPS + 1) + self.settled
        order = np.argsort(place, kind="stable")
        vectors, settled, side = self.single[order], self.settled[order], self.side[order]
        cuts = np.flatnonzero(np.diff(cell[order])) + 1
        for low, high in zip([0, *cuts], [*cuts, len(order)], strict=True):
            if self.alone:
                self._within(order, vectors, settled, low, high)
            else:
                middle = low + int(np.searchsorted(side[low:high], 1))
                self._across(order, vectors, settled, low, middle, high)

    def _within(
        self, order: np.ndarray, vectors: np.ndarray, settled: np.ndarray, low: int, high: int
    ) -> None:
        for first in range(low, high - 1, ROWS):
            end, start = min(first + ROWS, high), first
            if settled[first] == settled[end - 1] < MOST_GROUPS:
                # The rows are of one run that is settled; within it no products are needed.
                start = low + int(np.searchsorted(settled[low:high], settled[first], "right"))
            self._multiplied(order, vectors, (first, end), (start, high))

    def _across(
        self,
        order: np.ndarray,
        vectors: np.ndarray,
        settled: np.ndarray,
        low: int,
        middle: int,
        high: int,
    ) -> None:
        for first in range(low, middle, ROWS):
            rows = first, min(first + ROWS, middle)
            if settled[first] == settled[rows[1] - 1] < MOST_GROUPS:
                others = settled[middle:high]
                start = middle + int(np.searchsorted(others, settled[first], "left"))
                stop = middle + int(np.searchsorted(others, settled[first], "right"))
                self._multiplied(order, vectors, rows, (middle, start))
                self._multiplied(order, vectors, rows, (stop, high))
            else:
                self._multiplied(order, vectors, rows, (middle, high))

    def _multiplied(
        self, order: np.ndarray, vectors: np.ndarray, rows: tuple[int, int], others: tuple[int, int]
    ) -> None:
        """Products of rows with later ones among the others."""
        first, end = rows
        for low in range(*others, WIDE):
            high = min(low + WIDE, others[1])
            near = (vectors[first:end] @ vectors[low:high].T).ravel()
            hits = np.flatnonzero(near >= self.threshold - self.error)
            if not len(hits):
                continue
            a, b = np.divmod(hits, high - low)
            a, b = a + first, b + low
            later = b > a
            a, b = order[a[later]], order[b[later]]
            sure = near[hits[later]] >= self.threshold + self.error
            other = (self.settled[a] == MOST_GROUPS) | (self.settled[a] != self.settled[b])
            self.waiting.append((a[other], b[other], sure[other]))
            self.held += len(self.waiting[-1][0])
            if self.held >= COUNTED:
                self._counted()

    def _counted(self) -> None:
        """Counts the pairs that wait, unless an earlier cell has."""
        if not self.waiting:
            return
        a, b, sure = (np.concatenate(c) for c in zip(*self.waiting, strict=True))
        self.waiting, self.held = [], 0
        some = np.flatnonzero(~sure)
        for low in range(0, len(some), HASHED):
            part = some[low : low + HASHED]
            exact = (unit(self.raw[a[part]]) * unit(self.raw[b[part]])).sum(axis=1)
            sure[part] = exact >= self.threshold
        a, b = self._new(a[sure], b[sure])
        if not len(a):
            return
        n = len(self.keys)
        self.count += np.bincount(a, self.weights[b], n) + np.bincount(b, self.weights[a], n)
        while True:
            above, below = self._rooted(a), self._rooted(b)
            apart = above != below
            if not apart.any():
                return
            a, b, above, below = a[apart], b[apart], above[apart], below[apart]
            np.minimum.at(self.root, np.maximum(above, below), np.minimum(above, below))

    def _rooted(self, rows: np.ndarray) -> np.ndarray:
        found = self.root[rows]
        while (found != self.root[found]).any():
            found = self.root[found]
        self.root[rows] = found
        return found

    def _new(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that share no cell before the present one."""
        for cell in self.cells[:-1]:
            new = cell[a] != cell[b]
            a, b = a[new], b[new]
        for table in range(self.table):
            if not len(a):
                break
            seen = np.zeros(len(self.keys), bool)
            seen[a] = seen[b] = True
            place, rows = np.cumsum(seen) - 1, np.flatnonzero(seen)
            shard = hashes(self.whole[rows], self.plan.width, table, 0)
            met = shard[place[a]] == shard[place[b]]
            old = np.zeros(len(a), bool)
            for cell in range(self.plan.cells if met.any() else 0):
                code = self._cell(rows, table, cell)
                old |= met & (code[place[a]] == code[place[b]])
            a, b = a[~old], b[~old]
        return a, b


def _met(
    dealt: DataFrame, kind: str, tables: list[_Dealt], plans: dict[int, Plan], threshold: float
) -> DataFrame:
    """``k, other, n``: ``n`` rows are linked with ``k`` by pairs counted here, and class ``other``
    belongs together with it."""
    firsts = [int(d.first[0]) for d in tables]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, size, sides = None, 0, [[], []]

        def done() -> Iterator[pa.RecordBatch]:
            if at is None or not sides[0] and not sides[1]:
                return
            dealt = tables[int(np.searchsorted(firsts, at, "right")) - 1]
            shard = int(np.searchsorted(dealt.first, at, "right")) - 1
            # A block meets itself, or another one, which may have no vectors.
            own = np.arange(blocks := int(dealt.blocks[shard]))
            itself = at - dealt.first[shard] in _meeting(own, own, blocks)
            if itself or (sides[0] and sides[1]):
                found = _Meeting(sides, size, kind, plans[size], dealt.table, threshold).found()
                if found.num_rows:
                    yield found

        for batch in batches:
            task, side = batch.column("task").to_numpy(), batch.column("side").to_numpy()
            for i in range(len(task)):
                if task[i] != at:
                    yield from done()
                    at, size, sides = int(task[i]), batch.column("size")[i].as_py(), [[], []]
                sides[side[i]].append(batch.column("block")[i].as_py())
        yield from done()

    return dealt.mapInArrow(released(work), "k long, other long, n long")


# All --------------------------------------------------------------------------------------------


def _balls_met(
    classes: DataFrame, kind: str, centres: dict[int, np.ndarray], threshold: float
) -> DataFrame:
    """``k, other, n`` for the vectors of each ball, linked with all others of it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, keys, weights, raw in _rows(batch, kind):
                group = grouped(unit(raw), centres[size], threshold)
                some = (group >= 0) & (group % 2 == 1)
                if some.any():
                    name = np.full(some.sum(), size, np.int64) * MOST_GROUPS + (group[some] >> 1)
                    arrays = [pa.array(c, pa.int64()) for c in (keys[some], name, weights[some])]
                    yield pa.RecordBatch.from_arrays(arrays, ["k", "ball", "members"])

    columns = classes.select("k", "members", "size", "bytes")
    rows = written(columns.mapInArrow(work, "k long, ball long, members long"), "vector-balls")
    # One row a ball, at most MOST_GROUPS for each size.
    balls = rows.groupBy("ball").agg(F.min("k").alias("other"), F.sum("members").alias("all"))
    joined = rows.join(F.broadcast(balls), "ball")
    return joined.select("k", "other", (F.col("all") - F.col("members")).alias("n"))


def _let_go(rows: DataFrame) -> None:
    """Shuffle files of what has been written go now, where they would wait until the driver
    happens to collect its garbage. Python's references end a moment after it has."""
    for _ in range(2):
        gc.collect()
        rows.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def _blocks(shards: np.ndarray, least: int, count: float, most: int) -> np.ndarray:
    """The blocks that each of ``least`` shards or more is cut into: one for ``most`` vectors, where
    a sample of ``count`` vectors falls into these shards."""
    expected = np.bincount(shards, minlength=least) * count
    return np.maximum(1, np.ceil(expected / most)).astype(np.int64)


def near_pairs(classes: DataFrame, kind: str, threshold: float, shard_vectors: int) -> DataFrame:
    """``k, other, n`` for ``classes`` (``k, members, size, bytes``; ``bytes`` is the vector as
    ``size`` numbers of the numpy type ``kind``): for a class that is linked with others, ``n``
    rows of them, summed over the rows for ``k``; ``other`` belongs together with it, and all that
    belong together are connected so."""
    spark = classes.sparkSession
    _let_go(classes)
    counts = {r["size"]: r["count"] for r in classes.groupBy("size").count().collect()}
    if not counts:
        return spark.createDataFrame([], "k long, other long, n long")
    plans, centres, shards = {}, {}, []
    for size, n in counts.items():
        most = max(1, min(shard_vectors, SHARD_BYTES // (4 * size)))
        plan = plans[size] = planned(size, n, threshold, most)
        # A few thousand vectors come to the driver, at most SAMPLE_BYTES of them.
        wanted = max(1, min(SAMPLE, SAMPLE_BYTES // (size * np.dtype(kind).itemsize)))
        drawn = F.pmod(F.xxhash64("k", F.lit(9)), F.lit(-(-n // wanted))) == 0
        rows = classes.where((F.col("size") == size) & drawn).select("bytes").collect()
        units = unit(np.frombuffer(b"".join(r["bytes"] for r in rows), kind).reshape(len(rows), size))
        centres[size], numbers, each = centres_of(units, threshold), whole(units), n / max(1, len(rows))
        if groups := len(centres[size]):
            group = grouped(units, centres[size], threshold)
            shards.append((size, GROUPS, _blocks(group[group >= 0] >> 1, groups, each, most)))
        if not plan.width:
            blocks = max(-(-n // most), min(EXACT_SHARDS, n // LEAST_SHARD), 1)
            shards.append((size, 0, np.array([blocks])))
        for table in range(plan.tables if plan.width else 0):
            # Shards come out uneven, and a meeting of two blocks is no cheaper than both as one.
            shard = hashes(numbers, plan.width, table, 0)
            shards.append((size, table, _blocks(shard, 2 * plan.width, each, 4 * most)))

    found = []
    if any(len(c) for c in centres.values()):
        found.append(_balls_met(classes, kind, centres, threshold))
    # Groups first, as few vectors are in one, and then the tables of all sizes side by side.
    shards.sort(key=lambda s: s[1])
    copied = sum(n * (size * np.dtype(kind).itemsize + 18) for size, n in counts.items())
    for start in range(0, max(p.tables for p in plans.values()), ROUND):
        low = start or GROUPS
        tables, tasks, copies = [], 0, 0.0
        for size, table, blocks in shards:
            if low <= table < start + ROUND:
                starts = list(accumulate((_meetings(int(b)) for b in blocks), initial=tasks))
                tables.append(_Dealt(size, table, np.array(starts[:-1]), blocks))
                tasks = starts[-1]
                # A block goes to a task for each block of its shard; nearly all have one.
                copies += float(blocks.mean()) if table != GROUPS else 0
        parts = min(tasks, max(LEAST_PARTS, int(copied * copies / TASK_BYTES)))
        dealt = _dealt(classes, kind, tables, plans, centres, threshold)
        dealt = dealt.repartitionById(parts, F.pmod("task", F.lit(parts)))
        dealt = dealt.sortWithinPartitions("task", "side")
        found.append(written(_met(dealt, kind, tables, plans, threshold), "vector-links"))
        del dealt
        _let_go(classes)
    return reduce(DataFrame.unionByName, found)
