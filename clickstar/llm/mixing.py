"""Mixing of sources to target weights by pivotal rounding.

Each source has a target number of words, and so each of its documents an expected number of
copies, target / source size, alike for all. The whole part of that is given to every document; the
rest, a probability, is rounded by pairs: of two documents one gives probability to the other until
one of the two is 0 or 1. What one loses in words the other gains, so a source's expected words stay
what they were, and which of the two ways a pair goes is drawn so that each document's expected
copies stay as well. One document at most is left undecided in the end, so a source's words miss its
target by less than that document's words.

Pairs are made within chunks of the rows, cut by a hash of the id, so a large source is spread over
many tasks. A chunk leaves at most one undecided document a source; these meet in a tree of ever
fewer chunks, and the last one of a source is drawn by its probability.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from clickstar.llm.tables import written

WEIGHTS = (5.0, 2.0, 1.0)
#: Rows of a chunk at the leaves, and chunks that meet in one at each level.
CHUNK_ROWS, FAN_IN = 10_000, 32


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = 3.0
) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row a source.

    Sources in code point order, null last, have the weights in turn, and share the sum of all
    sizes; no target goes beyond ``most`` times its source's size, what is beyond is shared again.
    That settles at one level for all sources below their limit, and those at it are the ones
    with the least limit per weight, so it is found by running sums in that order: no rounds.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.array(*map(F.lit, weights))[(F.row_number().over(order) - 1) % len(weights)]
    ranked = sizes.select("source", "source_size", turn.alias("weight"))
    limit = F.col("source_size") * F.lit(float(most))
    by_limit = Window.orderBy(limit / F.col("weight"), F.col("source").asc_nulls_last())
    until = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    # The level if all sources before this one were at their limit and no other was.
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(until), F.lit(0.0))
    shared = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(until), F.lit(0.0)
    )
    levels = ranked.select("source", "source_size", "weight", (left / shared).alias("level"))
    # The first source that its level does not bring to its limit sets the level for all; it is the
    # highest of such levels, as whatever is held at a limit above its share lowers the rest.
    free = F.when(F.col("level") * F.col("weight") <= limit, F.col("level"))
    level = F.max(free).over(everything)
    target = F.coalesce(F.least(limit, level * F.col("weight")), limit)
    return levels.select("source", "source_size", target.alias("target"))


def _decide(rows: Iterator[dict], seed: int, level: int, last: bool) -> Iterator[dict]:
    """Pairs off rows that come by chunk and source. Gives each row with ``copies`` once it is
    decided, and at the end of a chunk and source the undecided one as it is."""
    group, held, draw = None, None, None

    def settle() -> Iterator[dict]:
        if held is not None:
            if last:
                held["copies"] = held["copies"] + (1 if draw.random() < held["part"] else 0)
                held["part"] = None
            yield held

    for row in rows:
        here = (row["chunk"], row["source"])
        if here != group:
            yield from settle()
            group, held = here, None
            name = repr((seed, level, here)).encode()
            draw = random.Random(hashlib.sha256(name).digest())
        if row["part"] <= 0 or not row["size"]:
            row["part"] = None  # nothing to round: no words, or a whole number of copies
            yield row
        elif held is None:
            held = row
        else:
            first, second = _paired(held, row, draw)
            held = None
            for one in (first, second):
                if one["part"] is None:
                    yield one
                else:
                    held = one
    yield from settle()


def _paired(a: dict, b: dict, draw: random.Random) -> tuple[dict, dict]:
    """One of the two gets 0 or 1 copies more, the other what that leaves, counted in words."""
    wa, wb = a["part"] * a["size"], b["part"] * b["size"]
    up = min(a["size"] - wa, wb)  # words a can gain from b
    down = min(wa, b["size"] - wb)  # and lose to it
    # The bound that is met decides, not how a difference of floats rounds.
    if draw.random() * (up + down) < down:
        filled = a["size"] - wa <= wb
        decided, other, whole = (a, b, 1) if filled else (b, a, 0)
        left = wb - (a["size"] - wa) if filled else wa + wb
    else:
        emptied = wa <= b["size"] - wb
        decided, other, whole = (a, b, 0) if emptied else (b, a, 1)
        left = wb + wa if emptied else wa - (b["size"] - wb)
    decided["copies"] += whole
    decided["part"] = None
    other["part"] = min(1.0, max(0.0, left / other["size"]))
    if other["part"] in (0.0, 1.0):
        other["copies"] += int(other["part"])
        other["part"] = None
    return a, b


def _level(rows: DataFrame, seed: int, level: int, last: bool) -> DataFrame:
    """One level of the tree: a task's rows in order of chunk, source and id."""
    schema = rows.schema

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None

        def flow() -> Iterator[dict]:
            nonlocal kinds
            for batch in batches:
                kinds = batch.schema
                yield from batch.to_pylist()

        out: list[dict] = []
        for row in _decide(flow(), seed, level, last):
            out.append(row)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kinds)

    in_order = ["chunk", F.col("source").asc_nulls_last(), "id", "size", "part"]
    return rows.repartition("chunk").sortWithinPartitions(*in_order).mapInArrow(decide, schema)


def mix(
    docs: DataFrame,
    size: Column,
    weights: tuple[float, ...] = WEIGHTS,
    most: float = 3.0,
    seed: int = 17,
    id_column: str = "doc_id",
    source_column: str = "source",
) -> DataFrame:
    """``id_column, source, size, source_size, target, copies, taken`` for each row.

    ``copies`` is how often the mix has the row, ``taken`` its words in it, ``copies * size``. The
    null source is a source, the last one. Rows without words take nothing. Repeated rows are
    rows of their own, and as they are alike it is the same whichever of them is taken. Runs over
    the same rows agree, in whatever partitions they come. A null id is an id; further columns are
    not read; an empty table gives an empty one. Sources are ranked in one task, a row a source;
    all else is spread by id. The rows' ids and sizes, not their texts, are written to the shared
    folder once for each level of the tree.
    """
    stored = written(
        docs.select(
            F.col(id_column).alias("id"),
            F.col(source_column).cast("string").alias("source"),
            size.cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    sizes = stored.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("n_rows")
    )
    n_rows = sizes.agg(F.sum("n_rows")).first()[0] or 0
    chunks = max(1, -(-n_rows // CHUNK_ROWS))
    hashed = F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(seed))
    share = F.col("target") / F.col("source_size")
    expected = F.when(F.col("source_size") > 0, F.least(share, F.lit(float(most)))).otherwise(0.0)
    targets = source_targets(sizes, weights, most).withColumnRenamed("source", "of_source")
    rows = stored.join(targets, F.col("source").eqNullSafe(F.col("of_source"))).select(
        F.pmod(hashed, F.lit(chunks)).alias("chunk"),
        "source",
        "id",
        "size",
        "source_size",
        "target",
        F.floor(expected).alias("copies"),
        (expected - F.floor(expected)).alias("part"),
    )
    decided, level = None, 0
    while True:
        last = chunks == 1
        rows = written(_level(rows, seed, level, last), "mix-level")
        done = rows.where(F.col("part").isNull())
        decided = done if decided is None else decided.unionByName(done)
        if last:
            break
        chunks, level = -(-chunks // FAN_IN), level + 1
        rows = rows.where(F.col("part").isNotNull()).withColumn(
            "chunk", F.floor(F.col("chunk") / FAN_IN)
        )
    return decided.select(
        F.col("id").alias(id_column),
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(
    docs: DataFrame,
    size: Column,
    id_column: str = "doc_id",
    source_column: str = "source",
    **options,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as the mix has them.

    Rows are told apart by id, source and size; those alike in all three are numbered, so that each
    of them gets the copies of one. Null ids and sources are values like others; columns may have any
    names.
    """
    keys = ["id", "source", "size"]
    # Rows alike in the keys are numbered in any order: whichever gets the copies, the words are the same.
    rows = docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col(id_column).alias("id"),
        F.col(source_column).cast("string").alias("source"),
        size.cast("long").alias("size"),
    ).withColumn("number", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    most_first = Window.partitionBy(*[f"of_{k}" for k in keys]).orderBy(F.desc("copies"))
    decided = mix(
        docs, size, id_column=id_column, source_column=source_column, **options
    ).select(
        F.col(id_column).alias("of_id"),
        F.col("source").alias("of_source"),
        F.col("size").alias("of_size"),
        "copies",
    )
    decided = decided.withColumn("of_number", F.row_number().over(most_first))
    matched = [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in [*keys, "number"]]
    whole = rows.join(decided.where(F.col("copies") > 0), matched)
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return whole.select("row", copies).select("row.*")
