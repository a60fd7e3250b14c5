"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstar.llm.tables import written

#: Links that one task contracts.
TASK_LINKS = 500_000


def forest(pairs: Iterator[tuple[int, int]]) -> dict[int, int]:
    """The least node reachable from each node that has a link."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    for a, b in pairs:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _contracted(links: DataFrame, tasks: int) -> DataFrame:
    """Each task's links as one link from each node to the least one it reaches there."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = (
            pair
            for batch in batches
            for pair in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        )
        found = [(a, b) for a, b in forest(pairs).items() if a != b]
        if found:
            arrays = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["a", "b"])

    return links.select("a", "b").repartition(tasks).mapInArrow(contract, "a long, b long")


def _both_ways(links: DataFrame) -> DataFrame:
    turned = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    return links.select("a", "b").unionByName(turned)


def _large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours linked to the least of the node and its neighbours."""
    around = _both_ways(links)
    least = around.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    larger = around.where(F.col("b") > F.col("a"))
    return larger.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours linked to the least of these."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    whole = moved.unionByName(least.select("a", F.col("m").alias("b")))
    return whole.where(F.col("a") != F.col("b")).distinct()


def components(links: DataFrame, task_links: int = TASK_LINKS) -> DataFrame:
    """``node, root`` for every node of ``links`` (``a, b``, long) that is not a root itself: the
    least node it reaches.

    Tasks contract their links by union and find, each up to ``task_links`` of them; while there is
    more than one task, large-star and small-star steps move the links on towards the roots. Every
    round is written to the shared folder. Nodes and links stay on the executors; only counts come
    to the driver. A node with very many links is no group of its own: its minimum is found by a
    partial aggregation, and its links meet it in a join.
    """
    links = written(links.select("a", "b").where(F.col("a") != F.col("b")), "links")
    while True:
        tasks = max(1, -(-links.count() // task_links))
        links = written(_contracted(links, tasks), "links")
        if tasks == 1:
            break
        links = written(_large_star(links), "links")
        links = written(_small_star(links), "links")
        # Stars, all of them: no node with two roots, no root with a root.
        roots = links.groupBy("a").agg(F.count("*").alias("n"))
        several = roots.where(F.col("n") > 1).limit(1).count()
        chained = links.join(links.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
        if not several and not chained.limit(1).count():
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
