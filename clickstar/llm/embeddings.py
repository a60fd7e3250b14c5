"""Near-duplicates among embeddings.

Equal vectors are one class. Pairs of classes come from ``cells.py``: products of all with all in a small
table, in a larger one products within cells of hash tables. Each links a query and members in double
precision; links go on as a tree to the component search.

``_Shard`` answers by a small-world graph and audits itself. ``near_vectors`` asked one such graph for
each shard about every vector, which took 0.4 ms a question; products with all of a shard's 16,384
members take 0.06 ms and miss nothing, so it asks none any more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickstar.llm.cells import near_pairs
from clickstar.llm.components import components, forest
from clickstar.llm.hnsw import BATCH, Graph
from clickstar.llm.tables import ROW_GROUP, written

#: Vectors of a shard, on average.
SHARD_VECTORS = 32_768
#: First beam, members audited, and the recall of links and of near neighbours to pass with.
BEAM, AUDITED, RECALL, NEIGHBOURS = 32, 64, 0.99, 10
#: Queries of each batch that are audited, and queries multiplied with all members at a time.
AUDITED_QUERIES, EXACT = 4, 64


def _usable(vectors: pa.Array, ids: pa.Array, kind: str) -> pa.Array:
    """Each vector's numbers as bytes, or null where no cosine is defined or there is no id: a
    vector that is null, empty or all zero, or has a component that is null or not finite."""
    flat = vectors.flatten()
    null = flat.is_null().to_numpy(zero_copy_only=False)
    numbers = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(kind, copy=False)
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])

    def some(mark: np.ndarray) -> np.ndarray:
        counts = np.concatenate([[0], np.cumsum(mark)])[ends]
        return counts[1:] > counts[:-1]

    able = some(numbers != 0) & ~some(null | ~np.isfinite(numbers))
    able &= ids.is_valid().to_numpy(zero_copy_only=False)
    offsets = (ends * numbers.dtype.itemsize).astype(np.int32)
    bits = np.packbits(able, bitorder="little")
    buffers = [pa.py_buffer(bits), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(numbers))]
    return pa.Array.from_buffers(pa.binary(), len(vectors), buffers)


def _keyed(rows: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, str]:
    """``id, k, size, bytes``, of which the last three are null for a vector that is not usable,
    and the numpy type of the numbers that ``bytes`` holds."""
    element = rows.schema[vector_column].dataType.elementType
    single = isinstance(element, T.FloatType)
    kind = "<f4" if single else "<f8"
    columns = rows.select(
        F.col(id_column).alias("id"),
        F.col(vector_column).cast("array<float>" if single else "array<double>").alias("vector"),
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _usable(batch.column("vector"), batch.column("id"), kind)
            yield pa.RecordBatch.from_arrays([batch.column("id"), found], ["id", "bytes"])

    fields = [T.StructField("id", rows.schema[id_column].dataType), T.StructField("bytes", T.BinaryType())]
    found = columns.mapInArrow(read, T.StructType(fields))
    size = (F.length("bytes") / F.lit(np.dtype(kind).itemsize)).cast("int")
    return found.select(
        "id",
        F.when(F.col("bytes").isNotNull(), F.xxhash64(F.length("bytes"), "bytes")).alias("k"),
        size.alias("size"),
        "bytes",
    ), kind


class _Shard:
    """A shard's graph and the search of queries in it."""

    def __init__(self, keys: list[int], weights: list[int], unit: np.ndarray, threshold: float):
        self.keys = np.array(keys, np.int64)
        self.weights = np.array(weights, np.int64)
        self.unit, self.threshold = unit, threshold
        hashed = self.keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.draws = (hashed >> np.uint64(11)).astype(np.float64) / (1 << 53)
        self.graph = Graph(unit, self.draws)
        drawn = np.argsort(self.draws, kind="stable")[-AUDITED:]
        self.beam = self._audited(unit[drawn])
        self.tied: dict[int, int] = {}
        self.pairs: list[tuple[int, int]] = []

    def _exact(self, queries: np.ndarray) -> list[np.ndarray]:
        """Members linked with each query, by products with all members."""
        found = []
        for low in range(0, len(queries), EXACT):
            near = queries[low : low + EXACT] @ self.unit.T
            found += [np.flatnonzero(row >= self.threshold) for row in near]
        return found

    def _found(self, queries: np.ndarray, beam: int) -> list[np.ndarray]:
        """Members linked with each query: all of them, where the graph leads to one."""
        if beam >= len(self.keys):
            return self._exact(queries)
        ids, near = self.graph.search(queries, beam)
        # Well below the threshold, so that the graph's single precision rules nothing out.
        led = np.flatnonzero(((ids >= 0) & (near >= self.threshold - 1e-4)).any(axis=1))
        found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(queries)
        for k, members in zip(led, self._exact(queries[led]), strict=True):
            found[k] = members
        return found

    def _passes(self, drawn: np.ndarray, beam: int) -> bool:
        """Whether the graph finds the links of the drawn queries, and their nearest members."""
        every = drawn @ self.unit.T
        links = (every >= self.threshold).sum()
        nearest = np.argsort(-every, axis=1)[:, :NEIGHBOURS]
        got = sum(len(f) for f in self._found(drawn, beam))
        ids, _ = self.graph.search(drawn, beam)
        met = sum(len(np.intersect1d(a, b)) for a, b in zip(ids, nearest, strict=True))
        return got >= RECALL * links and met >= RECALL * nearest.size

    def _audited(self, drawn: np.ndarray) -> int:
        """A beam that passes; one as wide as the shard means products with all members."""
        beam = min(BEAM, len(self.keys))
        while beam < len(self.keys) and not self._passes(drawn, beam):
            beam = min(2 * beam, len(self.keys))
        return beam

    def _audit_queries(self, drawn: np.ndarray) -> None:
        """Widens the beam until it finds the links of queries, which may come from other shards.
        What is near to them without a link does not matter, and without links nothing does."""
        linked = [f for f in self._exact(drawn) if len(f)]
        if not linked:
            return
        links = sum(map(len, linked))
        while self.beam < len(self.keys):
            if sum(len(f) for f in self._found(drawn, self.beam)) >= RECALL * links:
                break
            self.beam = min(2 * self.beam, len(self.keys))

    def links(self, keys: list[int], queries: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """For each query with links here: its key, one it is linked with, and how many rows."""
        for low in range(0, len(keys), BATCH):
            part = slice(low, low + BATCH)
            # Queries come in order of their hash, so the first ones are as good as drawn.
            self._audit_queries(queries[part][:AUDITED_QUERIES])
            for key, members in zip(keys[part], self._found(queries[part], self.beam), strict=True):
                members = members[self.keys[members] != key]
                if not len(members):
                    continue
                linked = self.keys[members]
                self.pairs += [(int(linked[0]), int(x)) for x in linked[1:]]
                if len(self.pairs) > 1_000_000:
                    self.pairs = list(forest(iter(self.pairs)).items())
                yield key, int(linked[0]), int(self.weights[members].sum())

    def ties(self) -> list[tuple[int, int]]:
        """Members that one query is linked with, as a tree."""
        return [(a, b) for a, b in forest(iter(self.pairs)).items() if a != b]


def near_vectors(
    rows: DataFrame,
    threshold: float = 0.9,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    shard_vectors: int = SHARD_VECTORS,
) -> DataFrame:
    """``id_column, n_links, component_id, kept`` for each row.

    ``n_links`` counts the other rows whose cosine with this one is at least ``threshold``; none
    below it counts. Up to ``EXACT_SHARDS`` times ``shard_vectors`` different vectors each such row
    counts; of more, a row right at the threshold is missed with a chance of ``MISSED`` at most,
    and one nearer with less (``cells.py``). ``component_id`` is the least id reachable by
    links, ``kept`` whether that is the row's own. Vectors that are null, empty or zero, or that
    hold a null or what is no finite number, and rows without an id, are linked with nothing.
    Vectors of different lengths are never linked. Repeated rows are other rows, linked with each
    other. Further columns are not read; an empty table gives an empty one.
    """
    keyed, kind = _keyed(rows, id_column, vector_column)
    classes = written(
        keyed.where("k is not null")
        .groupBy("k")
        .agg(
            F.first(F.struct("size", "bytes")).alias("vector"),
            F.count("*").alias("members"),
            F.min("id").alias("id"),
        )
        .select("k", "members", "id", "vector.size", "vector.bytes"),
        "vector-classes",
        ROW_GROUP,
    )
    found = near_pairs(classes, kind, threshold, shard_vectors)

    links = found.select(F.col("k").alias("a"), F.col("other").alias("b"))
    roots = components(links).withColumnRenamed("node", "k")
    counted = found.groupBy("k").agg(F.sum("n").alias("n"))
    whole = classes.select("k", "id", "members").join(roots, "k", "left").join(counted, "k", "left")
    whole = whole.withColumn("root", F.coalesce("root", "k"))
    least = whole.groupBy("root").agg(F.min("id").alias("component_id"))
    labelled = whole.join(least, "root").select(
        "k",
        "component_id",
        (F.col("members") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
    )
    joined = keyed.select("id", "k").join(labelled, "k", "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
