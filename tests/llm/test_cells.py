"""Near vectors by hash tables against all products."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
import brute  # noqa: E402

from clickstar.llm import cells, embeddings  # noqa: E402


def clustered(rng, count, size):
    """Vectors of which a fifth are in one group, a fifth in small ones, and some are repeated."""
    vectors = rng.normal(size=(count, size))
    fifth = count // 5
    scales = rng.choice([0.1, 0.25, 0.35], (fifth, 1))
    vectors[:fifth] = rng.normal(size=size) + rng.normal(size=(fifth, size)) * scales
    for k in range(fifth, 2 * fifth - 4, 4):
        vectors[k + 1 : k + 4] = vectors[k] + rng.normal(size=(3, size)) * 0.25
    vectors[-20:] = vectors[:20]
    return vectors.astype(np.float32)


def counted(vectors, threshold=0.9):
    """Links of each vector and the least number reachable, by all products."""
    exact = vectors.astype(float)
    exact /= np.linalg.norm(exact, axis=1, keepdims=True)
    linked = exact @ exact.T >= threshold
    joined = brute.Joined(len(vectors))
    for a, b in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        joined.join(int(a), int(b))
    return [*zip(linked.sum(axis=1) - 1, brute.least_ids(list(range(len(vectors))), joined), strict=True)]


@pytest.mark.parametrize("shard_vectors", [400, 30])
@pytest.mark.parametrize("least_group", [8, 10_000])
def test_near_vectors_by_tables(spark, monkeypatch, shard_vectors, least_group):
    """Each link counts once, whichever of many tables and cells find it; with and without groups;
    shards of one block and of several."""
    monkeypatch.setattr(cells, "planned", lambda *_: cells.Plan(32, 4, 3, 3))
    monkeypatch.setattr(cells, "ROUND", 16)
    monkeypatch.setattr(cells, "LEAST_GROUP", least_group)
    vectors = clustered(np.random.default_rng(8), 1_500, 24)
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = embeddings.near_vectors(data, shard_vectors=shard_vectors).collect()
    want = counted(vectors)
    assert sum(w[0] for w in want) > 20_000
    found = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in got)
    assert found == [(k, *w) for k, w in enumerate(want)]


def test_a_vector_is_not_searched_in_every_shard(spark):
    """In a table of many shards it goes to one of each hash table, whatever their number is."""
    rng = np.random.default_rng(3)
    rows = [(k, 1, 24, v.tobytes()) for k, v in enumerate(rng.normal(size=(3_000, 24)))]
    classes = spark.createDataFrame(rows, "k long, members long, size int, bytes binary")
    plans, none = {24: cells.Plan(2, 50, 1, 4)}, {24: np.zeros((0, 24), np.float32)}
    tables = [cells._Dealt(24, t, np.arange(100) + 100 * t, np.ones(100, np.int64)) for t in (0, 1)]
    dealt = cells._dealt(classes, "<f8", tables, plans, none, 0.9)
    got = [r["task"] // 100 for r in dealt.collect() for _ in range(len(r["block"]) // (18 + 24 * 8))]
    assert sorted(got) == [0] * 3_000 + [1] * 3_000
    # Products, and so seconds a vector, of a table ten times as large are not ten times as many.
    work = []
    for count in (2_000_000, 20_000_000):
        plan = cells.planned(64, count, 0.9, embeddings.SHARD_VECTORS)
        cell = count / (2 * plan.width) / (2 * plan.cell_width)
        work.append(plan.tables * plan.cells * cell)
    assert work[0] < 50_000 and work[1] < 3 * work[0]


def test_pairs_at_the_threshold_share_a_cell():
    rng = np.random.default_rng(5)
    plan = cells.planned(48, 3_000_000, 0.9, embeddings.SHARD_VECTORS)
    assert plan.tables > 1
    a, b = (cells.unit(rng.normal(size=(3_000, 48))) for _ in "ab")
    b = cells.unit(b - (a * b).sum(axis=1, keepdims=True) * a)
    a, b = cells.whole(a), cells.whole(0.9 * a + np.sqrt(1 - 0.81) * b)
    met = np.zeros((plan.tables, len(a)), bool)
    for table in range(plan.tables):
        shard = [cells.hashes(x, plan.width, table, 0) for x in (a, b)]
        for cell in range(1, plan.cells + 1):
            code = [cells.hashes(x, plan.cell_width, table, cell) for x in (a, b)]
            met[table] |= (shard[0] == shard[1]) & (code[0] == code[1])
    assert met.any(axis=0).all()
    once = 1 - (1 - cells.shared(plan.cell_width, 0.9)) ** plan.cells
    assert met.mean() > 0.97 * cells.shared(plan.width, 0.9) * once
    # A hash is the same alone and among others.
    assert cells.hashes(a[:1], 500, 0, 0)[0] == cells.hashes(a, 500, 0, 0)[0]
