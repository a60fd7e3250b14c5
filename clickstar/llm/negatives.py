"""Hard negatives by exact integer scores.

Anchors are scored against all rows in blocks: a block of anchors meets a block of rows in one task,
whose memory and time are bounded by the two sizes, whatever the table's. Products are taken in a
residue number system (``residues.py``). Positives come from rows of the anchor's label only, so
these are cut into blocks label by label; a label with a third of all rows is many blocks. A block
gives an anchor its best few; the best of all blocks are ranked by anchor. Negatives are then looked
for among all rows, within a window of scores set by each positive.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickstar.llm.residues import ResidueMatrix
from clickstar.llm.tables import written

#: Rows and anchors of a block, on average, and anchors scored at a time.
ROW_BLOCK, ANCHOR_BLOCK, STEP = 8_192, 4_096, 128

_POSITIVES = "anchor_id long, positive_id long, positive_score long"
_NEGATIVES = f"{_POSITIVES}, negative_id long, negative_score long"


def scaled(vector: Column, scale: int) -> Column:
    """Components as whole numbers, ``floor(scale * x)``; null where one is null or not finite.

    Also null where a component is so large that a hundred times a score might not fit a long: for
    vectors of 64 components that is beyond 37 million.
    """
    numbers = F.transform(vector, lambda x: x.cast("double") * F.lit(float(scale)))
    limit = F.sqrt(F.lit(9.0e16) / F.greatest(F.size(numbers), F.lit(1)))
    sound = F.forall(numbers, lambda x: F.coalesce(F.abs(x) <= limit, F.lit(False)) & ~F.isnan(x))
    return F.when(sound, F.transform(numbers, lambda x: F.floor(x)))


def usable_rows(
    vectors: DataFrame,
    anchors: Column,
    scale: int,
    id_column: str,
    label: Column,
    vector_column: str,
) -> DataFrame:
    """``vec_id, label, numbers, is_anchor``, one row an id."""
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        scaled(F.col(vector_column), scale).alias("numbers"),
        F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    sound = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND numbers IS NOT NULL")
    row = F.min(F.struct("label", "numbers", "is_anchor")).alias("row")
    return sound.groupBy("vec_id").agg(row).select("vec_id", "row.*")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, shorter ones filled up with 0."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = pa.concat_arrays(lists.chunks) if lists.num_chunks else pa.array([], column.type)
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    widths = np.diff(ends, prepend=0)
    filled = np.zeros((len(lists), int(widths.max(initial=0))), np.int64)
    filled[np.arange(filled.shape[1]) < widths[:, None]] = flat
    return filled


def _sides(block: pa.Table) -> tuple[pa.Table, np.ndarray, pa.Table, ResidueMatrix]:
    """Anchors and rows of a block, each by id, with their numbers in matrices of one width."""
    block = block.sort_by("vec_id")
    numbers = _matrix(block["numbers"])
    asks = block["asks"].to_numpy().astype(bool)
    left, right = block.filter(pa.array(asks)), block.filter(pa.array(~asks))
    return left, numbers[asks], right, ResidueMatrix(numbers[~asks])


def _falling(scores: np.ndarray) -> np.ndarray:
    """For each row of a matrix its columns by falling score, equal ones in order."""
    width = scores.shape[1]
    if int(np.abs(scores).max(initial=0)) < 2**61 // max(1, width):
        # Score and column in one number sort several times as fast as by an index.
        return np.sort(np.arange(width) - scores * width, axis=1) % max(1, width)
    return np.argsort(-scores, axis=1, kind="stable")


def _ranked(
    left: pa.Table, numbers: np.ndarray, right: ResidueMatrix
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each anchor its place, the rows' scores in falling order, and the rows so ordered."""
    for start in range(0, len(left), STEP):
        scores = right.scores(numbers[start : start + STEP])
        for k, (own, order) in enumerate(zip(scores, _falling(scores), strict=True)):
            yield start + k, own[order], order


def _table(columns: list[list[np.ndarray]], schema: str) -> pa.Table:
    names = [field.split()[0] for field in schema.split(", ")]
    whole = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, whole, strict=True)})


def _best_in_block(block: pa.Table, k: int) -> pa.Table:
    """The first ``k`` rows for each anchor; all rows of a block have one label."""
    left, numbers, right, matrix = _sides(block)
    out: list[list[np.ndarray]] = [[], [], []]
    ids, anchor_ids = right["vec_id"].to_numpy(), left["vec_id"].to_numpy()
    for a, scores, order in _ranked(left, numbers, matrix):
        others = ids[order[: k + 1]] != anchor_ids[a]
        best = ids[order[: k + 1]][others][:k]
        out[0].append(np.full(len(best), anchor_ids[a]))
        out[1].append(best)
        out[2].append(scores[: k + 1][others][:k])
    return _table(out, _POSITIVES)


def _windowed(block: pa.Table, k: int, low: int, high: int) -> pa.Table:
    """For each anchor and positive the first ``k`` rows of other labels in the score window."""
    left, numbers, right, matrix = _sides(block)
    out: list[list[np.ndarray]] = [[] for _ in range(5)]
    ids, labels = right["vec_id"].to_numpy(), right["label"].to_numpy()
    anchor_ids, anchor_labels = left["vec_id"].to_numpy(), left["label"].to_numpy()
    positives = left["positives"].to_pylist()
    for a, scores, order in _ranked(left, numbers, matrix):
        other = labels[order] != anchor_labels[a]
        falling, rows = -scores[other], ids[order[other]]
        for positive in positives[a]:
            score = positive["positive_score"]
            # Whole bounds: the least and the greatest score that the two inequalities allow.
            most, least = high * score // 100, -(-low * score // 100)
            first = int(np.searchsorted(falling, -most, "left"))
            end = int(np.searchsorted(falling, -least, "right"))
            found = slice(first, max(first, min(end, first + k)))
            n = found.stop - found.start
            out[0].append(np.full(n, anchor_ids[a]))
            out[1].append(np.full(n, positive["positive_id"]))
            out[2].append(np.full(n, score))
            out[3].append(rows[found])
            out[4].append(-falling[found])
    return _table(out, _NEGATIVES)


def _blocks(count: Column | int, size: int) -> Column:
    count = F.lit(count) if isinstance(count, int) else count
    return F.greatest(F.lit(1), F.ceil(count / F.lit(size))).cast("int")


def _met(rows: DataFrame, anchors: DataFrame, key: list[str]) -> DataFrame:
    """Every block of rows beside every block of anchors. Both come with ``row_blocks`` and
    ``anchor_blocks``; each row goes to as many tasks as there are blocks of the other side."""

    def dealt(side: DataFrame, own: str, others: str, asks: bool) -> DataFrame:
        spread = F.pmod(F.xxhash64("vec_id"), F.col(f"{own}_blocks")).cast("int")
        beside = F.explode(F.sequence(F.lit(0), F.col(f"{others}_blocks") - 1))
        columns = [c for c in side.columns if not c.endswith("_blocks")]
        return side.select(
            *columns,
            F.lit(asks).alias("asks"),
            spread.alias(f"{own}_block"),
            beside.alias(f"{others}_block"),
        )

    asked = dealt(rows, "row", "anchor", False)
    asking = dealt(anchors, "anchor", "row", True)
    return asked.unionByName(asking, allowMissingColumns=True).groupBy(
        *key, "row_block", "anchor_block"
    )


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    scale: int = 256,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are products of ``floor(scale * component)``; higher ones first, ties by smaller id. For
    each row that ``anchors`` holds for, its first ``positives`` other rows of the same ``label``, and
    for each of those the first ``negatives`` rows of other labels whose score is from ``low`` to
    ``high`` percent of the positive's. With a positive score below 0 that window is empty.

    Rows without id, label or vector, with a component that is null or not finite, or so large that
    scores would not fit (see ``scaled``) take no part. Of rows that share an id the least by label
    and numbers counts, so repeated rows are one. Vectors of different lengths are compared as if
    the shorter ended in zeros; an empty one scores 0. Anchors without positives, and positives
    without negatives, give no rows; nor does an empty table. Further columns are not read.
    """
    rows = written(
        usable_rows(vectors, anchors, scale, id_column, label, vector_column), "mining-rows"
    )
    per_label = rows.groupBy("label").agg(
        F.count("*").alias("n"), F.count_if("is_anchor").alias("m")
    )
    totals = per_label.agg(F.sum("n"), F.sum("m")).first()
    n_rows, n_anchors = totals[0] or 0, totals[1] or 0
    # Labels without anchors have nothing to answer and are not moved.
    blocks = per_label.where("m > 0").select(
        "label",
        _blocks(F.col("n"), ROW_BLOCK).alias("row_blocks"),
        _blocks(F.col("m"), ANCHOR_BLOCK).alias("anchor_blocks"),
    )
    numbered = rows.join(blocks, "label")
    asking = numbered.where("is_anchor").drop("is_anchor")
    in_blocks = _met(numbered.drop("is_anchor"), asking, ["label"]).applyInArrow(
        lambda block: _best_in_block(block, positives), _POSITIVES
    )
    order = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    found = (
        in_blocks.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= positives)
        .groupBy("anchor_id")
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    whole = {
        "row_blocks": _blocks(n_rows, ROW_BLOCK),
        "anchor_blocks": _blocks(n_anchors, ANCHOR_BLOCK),
    }
    asked = rows.drop("is_anchor").withColumns(whole)
    asking = (
        rows.where("is_anchor")
        .drop("is_anchor")
        .join(found, F.col("vec_id") == F.col("anchor_id"))
        .drop("anchor_id")
        .withColumns(whole)
    )
    mined = _met(asked, asking, []).applyInArrow(
        lambda block: _windowed(block, negatives, low, high), _NEGATIVES
    )
    pair = Window.partitionBy("anchor_id", "positive_id")
    rank = F.row_number().over(pair.orderBy(F.desc("negative_score"), "negative_id"))
    return (
        mined.withColumn("rank", rank)
        .where(F.col("rank") <= negatives)
        .select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
        )
    )
