"""Shards that each mirror the mixture of sources: proportional stratified interleaving.

The rows of a source are put into a seeded random order; the row at place r of n has the fractional
rank (r + 1/2) / n. Sorted by it, the sources' rows lie between one another in proportion to their
numbers, all the way, so equal cuts of that order hold the same mixture. Shards differ by one row at
most.

Places are counted, not dealt out by one sorted task. A random order needs no sorting to be cut
into even cells: the cell of a row is the upper part of its key. Cells are counted, the counts summed
up in order, and rows numbered within their cell only. The same is done with cells of fractional
ranks for the places in the whole. So a source with a third of all rows is as many cells as its rows
call for, and a table of counts, at most ``MOST_CELLS`` a source, is what sums run over.

Everything is DataFrame functions. Texts do not cross a shuffle: checksums and sizes do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickstar.llm.tables import hashable, written

#: Rows of a cell, about, and most cells; past that cells grow, and their sorts can spill.
CELL_ROWS, MOST_CELLS = 1_000, 16_384
#: Bits of a row's key in the random order.
KEY_BITS = 60


def shuffle_key(seed: int, id_column: Column, text: Column) -> Column:
    """A number of ``KEY_BITS`` bits from seed, id and text, evenly spread."""
    named = F.concat_ws(
        ":", F.lit(str(seed)), F.coalesce(id_column.cast("string"), F.lit("")), F.md5(text)
    )
    return F.conv(F.substring(F.md5(named), 1, KEY_BITS // 4), 16, 10).cast("long")


def _identified(
    docs: DataFrame, seed: int, id_column: str, source_column: str, text_column: str
) -> DataFrame:
    """What tells rows apart, for ordering: those alike in all of it are alike in all columns."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    # A null source is a source of its own, told from every text by the lack of a first sign.
    source = F.coalesce(F.concat(F.lit("="), F.col(source_column).cast("string")), F.lit(""))
    content = [F.col(f.name) for f in docs.schema if hashable(f.dataType)]
    return docs.select(
        F.col(id_column).alias("id"),
        source.alias("source"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("crc"),
        shuffle_key(seed, F.col(id_column), text).alias("key"),
        F.xxhash64(*content).alias("content"),
    )


_IDENTITY = ["id", "source", "size", "crc", "key", "content"]


def _cells(rows: int) -> int:
    return max(1, min(MOST_CELLS, -(-rows // CELL_ROWS)))


def _ranked(rows: DataFrame, n_rows: int) -> DataFrame:
    """Each row with its place in its source and the source's number of rows."""
    width = -(-(1 << KEY_BITS) // _cells(n_rows))
    placed = rows.withColumn("cell", F.floor(F.col("key") / F.lit(width)))
    of_source = Window.partitionBy("source")
    before = of_source.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        placed.groupBy("source", "cell")
        .agg(F.sum("copies").alias("n"))
        .select(
            "source",
            "cell",
            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"),
            F.sum("n").over(of_source).alias("of"),
        )
    )
    order = Window.partitionBy("source", "cell").orderBy("key", "id", "size", "crc", "content")
    earlier = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = F.col("start") + F.coalesce(earlier, F.lit(0))
    copies = F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    return (
        placed.join(counts, ["source", "cell"])
        .select(*_IDENTITY, "of", "copies", first.alias("first"))
        .select(*_IDENTITY, "of", "first", copies.alias("copy"))
        .select(*_IDENTITY, "of", (F.col("first") + F.col("copy")).alias("rank"))
    )


def assigned(
    docs: DataFrame,
    shards: int,
    seed: int = 12,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """``id, source, size, crc, key, content, fraction, shard, slot``: a row for each of ``docs``.

    ``size`` is the text's bytes and 8 more, ``crc`` its unsigned checksum; a null text counts as
    empty. ``shard`` is 0 to ``shards - 1``, ``slot`` the place in it, from 0 without gaps. Null ids
    and null sources are ids and sources like others. Rows alike in id, source and text are told
    apart by their other columns, and where these are equal too they are counted before they are
    shuffled and take neighbouring places; which of them is which makes no difference. Equal texts
    under different ids are spread like other rows. Columns may have any names; those with maps
    are not looked at. An empty table gives an empty one. With fewer rows than shards some stay
    empty. Runs over the same rows agree, in whatever partitions they come.
    """
    rows = _identified(docs, seed, id_column, source_column, text_column)
    alike = written(rows.groupBy(*_IDENTITY).agg(F.count("*").alias("copies")), "shard-rows")
    n_rows = alike.agg(F.sum("copies")).first()[0] or 0
    fraction = (F.col("rank") + F.lit(0.5)) / F.col("of")
    ranked = _ranked(alike, n_rows).withColumn("fraction", fraction)
    cell = F.floor(F.col("fraction") * F.lit(_cells(n_rows)))
    ranked = written(ranked.withColumn("cell", cell), "shard-ranks")
    # As many counts as cells, so their number is bounded and they may be broadcast.
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranked.groupBy("cell")
        .agg(F.count("*").alias("n"))
        .select("cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    order = Window.partitionBy("cell").orderBy("fraction", "source", "rank")
    place = F.col("start") + F.row_number().over(order) - 1
    shard = F.expr(f"place * {shards}L div {max(1, n_rows)}L")
    opening = F.expr(f"(shard * {n_rows}L + {shards - 1}L) div {shards}L")
    return (
        ranked.join(F.broadcast(starts), "cell")
        .withColumn("place", place)
        .withColumn("shard", shard)
        .withColumn("slot", F.col("place") - opening)
        .select(*_IDENTITY, "fraction", F.col("shard").cast("int").alias("shard"), "slot")
    )


def sharded(
    docs: DataFrame,
    shards: int,
    seed: int = 12,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
    shard_column: str = "shard",
    slot_column: str = "slot",
) -> DataFrame:
    """The rows of ``docs``, all their columns, with shard and slot; as ``assigned`` has them.

    One row of each that are alike in all columns meets their places, so copies do not meet each
    other. ``shard_column`` and ``slot_column`` must not be columns of ``docs``.
    """
    taken = {shard_column, slot_column} & set(docs.columns)
    if taken:
        raise ValueError(f"docs have the columns {', '.join(sorted(taken))} already")
    columns = [id_column, source_column, text_column]
    keys = _identified(docs, seed, *columns).columns
    whole = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    text = F.coalesce(F.col("row")[text_column], F.lit(""))
    content = [F.col("row")[f.name] for f in docs.schema if hashable(f.dataType)]
    rows = docs.select(whole).select(
        "row",
        F.col("row")[id_column].alias("id"),
        shuffle_key(seed, F.col("row")[id_column], text).alias("key"),
        F.xxhash64(*content).alias("content"),
    )
    one = rows.groupBy("id", "key", "content").agg(F.first("row").alias("row"))
    places = assigned(docs, shards, seed, *columns).select(
        *[F.col(k).alias(f"of_{k}") for k in keys if k in ("id", "key", "content")],
        F.col("shard").alias("to_shard"),
        F.col("slot").alias("to_slot"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("of_id"))
        & (F.col("key") == F.col("of_key"))
        & (F.col("content") == F.col("of_content"))
    )
    return places.join(one, same).select(
        *[F.col("row")[c].alias(c) for c in docs.columns],
        F.col("to_shard").alias(shard_column),
        F.col("to_slot").alias(slot_column),
    )


def write_shards(docs: DataFrame, path: str, shards: int, **options) -> None:
    """Parquet folders ``shard=0`` and so on, whose files in order of name hold the slots in order."""
    placed = sharded(docs, shards, **options)
    shard, slot = placed.columns[-2:]
    placed.repartitionByRange(shard, slot).sortWithinPartitions(shard, slot).write.partitionBy(
        shard
    ).parquet(path)
