"""Hard negatives, shards and the trie against plain versions."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickstar.llm import negatives, residues, sharding, tries

# Products by residues --------------------------------------------------------------------------


@pytest.mark.parametrize("most", [0, 1, 300, 40_000, 3_000_000])
@pytest.mark.parametrize("width", [0, 1, 255, 256, 700])
def test_products_by_residues_are_exact(most, width):
    rng = np.random.default_rng(most + width)
    a = rng.integers(-most, most + 1, (7, width))
    b = rng.integers(-most, most + 1, (11, width))
    got = residues.ResidueMatrix(b).scores(a)
    want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in b] for p in a]
    assert got.tolist() == want


def test_products_at_the_bound():
    worst = np.full((2, 256), 254)
    worst[1] *= -1
    assert residues.ResidueMatrix(worst).scores(worst).tolist() == [
        [256 * 254**2, -256 * 254**2],
        [-256 * 254**2, 256 * 254**2],
    ]
    with pytest.raises(OverflowError):
        residues.ResidueMatrix(np.array([[2**33]])).scores(np.array([[2**33]]))


# Hard negatives --------------------------------------------------------------------------------


def plain_negatives(rows):
    named = defaultdict(list)
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        named[vec_id].append((label, [math.floor(256 * x) for x in vector]))
    rows = {vec_id: min(alike) for vec_id, alike in named.items()}
    out = []
    for a, (label, v) in rows.items():
        if a % 100:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w, strict=False)), b, other)
            for b, (other, w) in rows.items()
            if b != a
        )
        for score, b, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and -30 * score <= -100 * s[0] <= -90 * score]
            out += [(a, b, k + 1, c, -score, -s) for k, (s, c, _) in enumerate(fit[:10])]
    return sorted(out)


def mined(spark, rows, **options):
    data = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>, rank string")
    found = negatives.hard_negatives(
        data,
        anchors=F.col("vec_id") % 100 == 0,
        label=F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")),
        **options,
    )
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("blocks", [(8_192, 4_096), (37, 2)])
def test_hard_negatives_equal_plain_ones(spark, monkeypatch, blocks):
    monkeypatch.setattr(negatives, "ROW_BLOCK", blocks[0])
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", blocks[1])
    rng = random.Random(3)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = []
    for k in range(620):
        # A third of the rows have one label, and many vectors are alike, so scores are tied.
        label = 1 if k % 3 == 0 else rng.randint(0, 9)
        vector = [round(x + rng.choice([0, 0.25]), 2) for x in rng.choice(centres)]
        rows.append((k, label, vector, "x"))
    rows += [(1_000, 3, [], "x"), (1_001, 3, [1.0], "x"), (1_100, 4, [0.5] * 11, "x")]
    rows += [(1_200, None, [1.0] * 8, "x"), (1_300, 2, None, "x"), (None, 2, [1.0] * 8, "x")]
    rows += [(1_400, 2, [float("nan")] * 8, "x"), (1_500, 2, [1.0, None], "x")]
    rows += [(1_501, 2, [float("inf"), 1.0], "x"), rows[5], rows[200], (300, 0, [0.1] * 8, "again")]
    want = plain_negatives([r[:3] for r in rows])
    assert len(want) > 200
    assert mined(spark, rows) == want


def test_hard_negatives_without_rows_or_partners(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(100, 1, [1.0], "x")]) == []
    # No other label, and then a window that holds nothing.
    assert mined(spark, [(100, 1, [1.0], "x"), (101, 1, [1.0], "x")]) == []
    assert mined(spark, [(100, 1, [1.0], "x"), (101, 1, [-1.0], "x"), (102, 2, [-0.5], "x")]) == []
    # Components past the bound take no part, those below it are exact.
    large = [(100, 1, [1e5] * 64, "x"), (101, 1, [1e5] * 64, "x"), (102, 2, [5e4] * 64, "x")]
    score = 64 * 25_600_000**2
    assert mined(spark, [*large, (103, 2, [1e30], "x")]) == [(100, 101, 1, 102, score, score // 2)]


# Shards ----------------------------------------------------------------------------------------


def plain_key(seed, doc_id, text):
    name = ":".join([str(seed), "" if doc_id is None else str(doc_id), hashlib.md5(text).hexdigest()])
    return int(hashlib.md5(name.encode()).hexdigest()[:15], 16)


def plain_shards(rows, shards, seed=12):
    by_source = defaultdict(list)
    for doc_id, text, source in rows:
        data = (text or "").encode()
        key = plain_key(seed, doc_id, data)
        order = (key, doc_id is not None, doc_id or 0, len(data) + 8, zlib.crc32(data))
        by_source["" if source is None else "=" + source].append((order, doc_id))
    placed = []
    for source, own in by_source.items():
        for rank, (order, doc_id) in enumerate(sorted(own, key=lambda r: r[0])):
            placed.append(((rank + 0.5) / len(own), source, rank, doc_id, order[3], order[4]))
    out, n = [], len(placed)
    for place, (_, _, _, doc_id, size, crc) in enumerate(sorted(placed, key=lambda r: r[:3])):
        shard = place * shards // n
        out.append((doc_id, size, crc, shard, place - -(-shard * n // shards)))
    return sorted(out, key=repr)


def corpus(n):
    rng = random.Random(n)
    rows = [(k, f"text {k} " * rng.randint(0, 9), rng.choice("aaabc")) for k in range(n)]
    rows += [(None, "no id", "a"), (None, None, None), (3, None, "b"), (4, "é" * 40_000, None)]
    return rows + [(9, "copy", "c")] * 40 + [(k, "copy", "c") for k in range(n, n + 30)]


@pytest.mark.parametrize("cell_rows", [1_000, 7])
def test_shards_equal_plain_ones(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(sharding, "CELL_ROWS", cell_rows)
    rows = corpus(400)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs = docs.withColumns({"shard": F.lit(1), "copies": F.lit("x"), "id": F.lit(2), "key": F.array()})
    got = sharding.assigned(docs.repartition(5), 24)
    found = [tuple(r) for r in got.select("id", "size", "crc", "shard", "slot").collect()]
    assert sorted(found, key=repr) == plain_shards(rows, 24)
    held = Counter(r[3] for r in found)
    assert max(held.values()) - min(held.values()) <= 1
    # Every shard has each large source in proportion.
    of_a = Counter(r["shard"] for r in got.where("source = '=a'").collect())
    n_a = sum(of_a.values())
    assert all(abs(of_a[s] - n_a / 24) <= 4 for s in range(24))


def test_shards_of_few_or_no_rows(spark):
    schema = "doc_id long, text string, source string"
    assert sharding.assigned(spark.createDataFrame([], schema), 24).count() == 0
    few = spark.createDataFrame([(1, "a", "x"), (2, "b", "x")], schema)
    assert [r["slot"] for r in sharding.assigned(few, 24).collect()] == [0, 0]


def test_written_shards_hold_every_row_in_order(spark, tmp_path):
    rows = [(*r, {"k": str(n % 2)}, n % 3) for n, r in enumerate(corpus(150))]
    schema = "doc_id long, text string, source string, extra map<string,string>, slot int"
    docs = spark.createDataFrame(rows, schema)
    with pytest.raises(ValueError, match="slot"):
        sharding.sharded(docs, 4)
    sharding.write_shards(docs, str(tmp_path / "shards"), 4, shard_column="part", slot_column="at")
    back = spark.read.parquet(str(tmp_path / "shards"))
    # Maps are no part of a row's identity: of rows alike but for those, one stands for all.
    plain = [tuple(r) for r in back.select("doc_id", "text", "source", "slot").collect()]
    assert sorted(plain, key=repr) == sorted(((*r[:3], r[4]) for r in rows), key=repr)
    for part in range(4):
        own = spark.read.parquet(str(tmp_path / f"shards/part={part}"))
        slots = [r["at"] for r in own.collect()]
        assert sorted(slots) == list(range(len(slots)))


# The trie --------------------------------------------------------------------------------------


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, role, tie), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        # The remainder has the sign of the id, as in SQL.
        family = c - int(math.fmod(c, 100))
        whole[c] = tuple(own.get(family, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(path[:-1] for path in members if path)
    leaves, saved = Counter(), Counter()
    for path, convs in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(convs) - 1) * (len(path[-1][1]) if path else 0)
    out = []
    for path, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if whole[c] == path))
        above = min(members[path[:-1]]) if path else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append(
            (min(convs), len(path), above, len(convs), children[path], leaves[path], saved[path], digest)
        )
    return sorted(out, key=repr)


def trie(spark, rows):
    data = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    return sorted((tuple(r)[2:] for r in tries.conversation_trie(data).collect()), key=repr)


def conversations():
    rng = random.Random(8)
    rows = []
    for c in range(230):
        opening = [("user", "hello")] * (c % 2) + [("assistant", "yes?")] * (c % 4 == 3)
        turns = opening + [(rng.choice(["user", "assistant", None]), rng.choice("abc") * rng.randint(0, 3)) for _ in range(rng.randint(0, 8))]
        rows += [(c, t, *turn, "x") for t, turn in enumerate(turns)]
    # One with a fifth of all turns, one whose turns say nothing, equal conversations, odd rows.
    rows += [(500, t, "user", f"t{t % 3}", "x") for t in range(300)]
    rows += [(601, None, None, None, "x")] * 5 + [(602, None, "user", None, "x"), (602, 1, "user", "b", "x")]
    rows += [(603, 1, "user", "b", "x"), (603, 1, "user", "a", "x"), (603, 1, "system", "c", "x")]
    rows += [(700 + k, t, "user", "same", "x") for k in range(40) for t in range(6)]
    return rows + [(None, 0, "user", "nobody", "x"), (-7, 0, "user", "below", "x"), (-7, 1, "a", "é" * 9_000, "x")]


@pytest.mark.parametrize("stretch, ids", [(4_096, 4_096), (7, 3)])
def test_trie_equals_plain_one(spark, monkeypatch, stretch, ids):
    monkeypatch.setattr(tries, "STRETCH", stretch)
    monkeypatch.setattr(tries, "IDS", ids)
    rows = conversations()
    assert trie(spark, rows) == plain_trie([r[:4] for r in rows])


def test_trie_of_nothing(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "a", "x")]) == []
    rows = [(1, 0, "user", "a", "x")]
    assert trie(spark, rows) == plain_trie([r[:4] for r in rows])


def test_totals_of_chains_and_stars(spark):
    # A chain of 150, with a star of 500 at its end, and a tree of its own.
    up = {k: k - 1 for k in range(1, 150)} | {k: 149 for k in range(150, 650)}
    up |= {0: None, 1_000: None, 1_001: 1_000}
    rows = [((k, -k), None if p is None else (p, -p), k, 1) for k, p in up.items()]
    pair = "struct<x:long,y:long>"
    tree = spark.createDataFrame(rows, f"node {pair}, parent {pair}, w long, one long")
    want = {k: [k, 1] for k in up}
    for k in sorted(up, reverse=True):
        if up[k] is not None:
            want[up[k]] = [a + b for a, b in zip(want[up[k]], want[k], strict=True)]
    got = tries.subtree_totals(tree, ["w", "one"]).collect()
    assert {r["node"]["x"]: [r["w"], r["one"]] for r in got} == want


@pytest.mark.parametrize("task_nodes", [1, 30, 100_000])
def test_totals_over_parts_rounds_and_the_rest(spark, monkeypatch, task_nodes):
    # Parts of one node, which leave all to rounds of joins; parts with chains between; one whole.
    monkeypatch.setattr(tries, "TASK_NODES", task_nodes)
    rng = random.Random(13)
    up = {k: rng.choice([k - 1, k - 1, k - 1, rng.randrange(k)]) for k in range(1, 400)} | {0: None}
    rows = [((k, -k), None if p is None else (p, -p), k, 1) for k, p in up.items()]
    pair = "struct<x:long,y:long>"
    tree = spark.createDataFrame(rows, f"node {pair}, parent {pair}, w long, one long")
    want = {k: [k, 1] for k in up}
    for k in sorted(up, reverse=True):
        if up[k] is not None:
            want[up[k]] = [a + b for a, b in zip(want[up[k]], want[k], strict=True)]
    got = tries.subtree_totals(tree, ["w", "one"]).collect()
    assert len(got) == len(up)
    assert {r["node"]["x"]: [r["w"], r["one"]] for r in got} == want


@pytest.mark.parametrize("task_nodes", [5, 60])
def test_trie_in_small_parts_equals_plain_one(spark, monkeypatch, task_nodes):
    monkeypatch.setattr(tries, "TASK_NODES", task_nodes)
    rows = conversations()
    assert trie(spark, rows) == plain_trie([r[:4] for r in rows])


def test_trie_takes_few_jobs(spark):
    # Plans of many rounds heap up on the driver; what one task can finish has no rounds.
    sc = spark.sparkContext
    sc.setJobGroup("few jobs", "trie")
    try:
        trie(spark, conversations())
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(sc.statusTracker().getJobIdsForGroup("few jobs")) < 90
