"""A trie of conversations by their turns, with totals of every subtree by tree contraction.

A node is a sequence of turns that some conversation starts with. It is known by a 128-bit print: the
exclusive or of one hash for each turn, of its place, role and text. Such prints need no pass from
turn to turn: those of a conversation's stretches are found apart and put together, so a conversation
with a third of all turns is spread over many tasks. Texts are left behind at once; their checksums
and lengths go on.

Subtree totals come from tree contraction: leaves are raked, they are done and give their totals to
their parents, and of chains of nodes with one child each, nodes are spliced out, and their child hangs
on their parent, with what they had kept at the link. First each task rakes and compresses the part of
the tree that it holds, as far as that goes; what is left are nodes above parts of several tasks. While
these are more than one task takes, rounds of joins over all of them go on: a round rakes every
leaf, however many share a parent, by partial sums, and splices out about a quarter of a chain, no two
neighbours, so chains of any length and stars of any width go in a logarithmic number of rounds. Then one
task finishes. Going back, a node spliced out has its own and its child's total, which later rounds have
settled by then. Every round is a table in the shared folder and every join in a round is on keys that
one row has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickstar.llm.tables import written
from clickstar.runtime import scratch_path
from clickstar.sources.runs import path_exists

#: Turns of one stretch of a conversation, and ids that one text of them holds.
STRETCH, IDS = 4_096, 4_096
#: Nodes of a tree that a task contracts at a time, and that the last one finishes.
TASK_NODES = 100_000
#: Conversations that share the head of the first of them, and most turns of a head.
FAMILY, HEADS = 100, 6


def digest(role: Column, text: Column) -> Column:
    """128 bits of a turn, as hexadecimal; the role's length keeps the two apart."""
    return F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, place, turn_hash, chars`` with places from 0 in each conversation.

    Turns in order, null first; of equal ones by role and then by digest of the text. Sorted over
    all tasks, so a long conversation lies in several; what earlier tasks hold of it is added to
    the places of later ones.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        digest(role, text).alias("turn_hash"),
        F.char_length(text).cast("long").alias("chars"),
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "turn_hash"]
    # The number of a row tells its task, in the order of the whole, and its place there.
    numbered = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            "turn_hash",
            "chars",
            F.spark_partition_id().alias("task"),
            F.monotonically_increasing_id().alias("number"),
        ),
        "turns",
    )
    spans = numbered.groupBy("conv_id", "task").agg(
        F.min("number").alias("first"), F.count("*").alias("n")
    )
    before = Window.partitionBy("conv_id").orderBy("task")
    starts = spans.select(
        "conv_id",
        "task",
        (
            F.col("first")
            - F.coalesce(
                F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            )
        ).alias("zero"),
    )
    return numbered.join(starts, ["conv_id", "task"]).select(
        "conv_id", (F.col("number") - F.col("zero")).alias("place"), "turn_hash", "chars"
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, turn_hash, chars``: each conversation with the head of its family's first.

    The first ``h`` turns are those of conversation ``c - c % FAMILY`` (fewer if it has fewer, none if
    it is not there), then come its own after its first ``h``; ``h`` is the checksum of the decimal id
    modulo ``HEADS``. Remainders have the sign of the id. Depths count from 1. A conversation of which nothing is left has no row.
    """
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = turns.where((F.col("conv_id") % FAMILY == 0) & (F.col("place") < HEADS - 1))
    families = heads.groupBy(F.col("conv_id").alias("family")).agg(
        F.array_sort(F.collect_list(F.struct("place", "turn_hash", "chars"))).alias("head")
    )
    members = (
        turns.select("conv_id")
        .distinct()
        .select("conv_id", taken.alias("h"), first.alias("family"))
        .join(families, "family", "left")
        .select("conv_id", "h", F.slice("head", F.lit(1), F.col("h").cast("int")).alias("head"))
    )
    lends = F.when(F.col("head").isNull(), 0).otherwise(F.size("head"))
    own = turns.join(members.select("conv_id", "h", lends.alias("lent")), "conv_id")
    tail = own.where(F.col("place") >= F.col("h")).select(
        "conv_id",
        (F.col("place") - F.col("h") + F.col("lent") + 1).alias("depth"),
        "turn_hash",
        "chars",
    )
    lent = members.select("conv_id", F.posexplode("head").alias("at", "turn")).select(
        "conv_id", (F.col("at") + 1).cast("long").alias("depth"), "turn.turn_hash", "turn.chars"
    )
    return lent.unionByName(tail)


def _print(*columns: str) -> Column:
    """Two longs from the columns, each a hash of its own."""
    halves = [F.xxhash64(F.lit(half), *columns) for half in (1, 2)]
    return F.struct(halves[0].alias("x"), halves[1].alias("y"))


def _xor(a: Column, b: Column) -> Column:
    return F.struct(
        a["x"].bitwiseXOR(b["x"]).alias("x"), a["y"].bitwiseXOR(b["y"]).alias("y")
    )


def _root() -> Column:
    return F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))


def prefixes(sequences: DataFrame) -> DataFrame:
    """``conv_id, depth, node, parent, chars`` for each start of a sequence but the empty one."""
    own = sequences.select(
        "conv_id",
        "depth",
        "chars",
        F.floor(F.col("depth") / STRETCH).alias("stretch"),
        _print("depth", "turn_hash").alias("p"),
    ).select("conv_id", "depth", "chars", "stretch", "p.x", "p.y")
    before = Window.partitionBy("conv_id").orderBy("stretch")
    earlier = before.rowsBetween(Window.unboundedPreceding, -1)
    stretches = (
        own.groupBy("conv_id", "stretch")
        .agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
        .select(
            "conv_id",
            "stretch",
            *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(f"{c}0") for c in "xy"],
        )
    )
    here = Window.partitionBy("conv_id", "stretch").orderBy("depth")
    so_far = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    node = _xor(
        F.struct(F.bit_xor("x").over(so_far).alias("x"), F.bit_xor("y").over(so_far).alias("y")),
        F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")),
    )
    return (
        own.join(stretches, ["conv_id", "stretch"])
        .select("conv_id", "depth", "chars", "x", "y", node.alias("node"))
        .select(
            "conv_id", "depth", "chars", "node", _xor(F.col("node"), F.struct("x", "y")).alias("parent")
        )
    )


# Tree contraction ------------------------------------------------------------------------------


def _coin(node: Column) -> Column:
    return F.xxhash64(F.col("turn"), node["x"], node["y"]).bitwiseAND(1) == 1


def _met(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both sides by node, each a sorted part a task: rounds are many, and broadcasts would heap up on
    the driver."""
    return left.join(right.hint("merge"), "node", "left")


def _contracted(active: DataFrame, sums: list[str]) -> DataFrame:
    """One round: every active node with what became of it, ``raked``, ``spliced`` or ``active``.

    The number of the round is a column, so that all rounds are the same plan and the same code.
    """
    on_way, links = [f"{s}_up" for s in sums], [f"{s}_link" for s in sums]
    children = active.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node"))
    with_count = _met(active, children.agg(F.count("*").alias("n")))
    leaf = F.col("n").isNull()
    given = (
        with_count.where(leaf & F.col("parent").isNotNull())
        .groupBy(F.col("parent").alias("node"))
        .agg(
            F.count("*").alias("n_raked"),
            *[F.sum(F.col(s) + F.col(up)).alias(f"{s}_in") for s, up in zip(sums, on_way, strict=True)],
        )
    )
    totals = [(F.col(s) + F.coalesce(F.col(f"{s}_in"), F.lit(0))).alias(s) for s in sums]
    raked = _met(with_count, given).select(
        "node",
        "parent",
        "turn",
        *totals,
        *on_way,
        leaf.alias("done"),
        (F.col("n") - F.coalesce("n_raked", F.lit(0)) == 1).alias("unary"),
    )
    # The one child that a node still has, and what is kept at its link; two halves of a key, as
    # those have a plain minimum.
    only = (
        raked.where(~F.col("done") & F.col("parent").isNotNull())
        .groupBy(F.col("parent").alias("node"))
        .agg(
            F.min("node.x").alias("x"),
            F.min("node.y").alias("y"),
            *[F.min(up).alias(link) for up, link in zip(on_way, links, strict=True)],
        )
        .select("node", F.struct("x", "y").alias("child"), *links)
    )
    chosen = (
        ~F.col("done")
        & F.coalesce(F.col("unary"), F.lit(False))
        & F.col("parent").isNotNull()
        & _coin(F.col("node"))
        & ~_coin(F.col("parent"))
    )
    decided = _met(raked, only).withColumn("chosen", F.coalesce(chosen, F.lit(False)))
    spliced = decided.where("chosen").select(
        F.col("child").alias("node"),
        F.col("parent").alias("next"),
        *[(F.col(s) + F.col(up)).alias(f"{s}_more") for s, up in zip(sums, on_way, strict=True)],
    )
    state = F.when(F.col("done"), "raked").when(F.col("chosen"), "spliced").otherwise("active")
    return _met(decided, spliced).select(
        "node",
        F.coalesce("next", "parent").alias("parent"),
        # Of a node spliced out, what it has apart from its child's total.
        *[
            (F.col(s) + F.when(F.col("chosen"), F.col(link)).otherwise(F.lit(0))).alias(s)
            for s, link in zip(sums, links, strict=True)
        ],
        *[
            (F.col(up) + F.coalesce(F.col(f"{s}_more"), F.lit(0))).alias(up)
            for s, up in zip(sums, on_way, strict=True)
        ],
        F.when(F.col("chosen"), F.col("child")).alias("child"),
        (F.col("turn") + 1).alias("turn"),
        state.alias("state"),
    )


def _contracted_part(
    rows: dict[str, list], sums: list[str], whole: bool
) -> Iterator[tuple[str, list[tuple], list[list], list[tuple]]]:
    """Rake and compress in a part of the tree: for each state of nodes there, their keys, parents,
    sums with what is kept at links, and children.

    ``given`` are parents elsewhere, with what raked nodes gave them. ``n_open`` says how many children
    a node waits for, here and elsewhere; if the part is the ``whole`` tree, they are all here.
    """
    node = list(zip(rows["x"], rows["y"], strict=True))
    parent = list(zip(rows["px"], rows["py"], strict=True))
    columns = [rows[c] for c in sums], [rows[f"{c}_up"] for c in sums]
    own = list(map(list, zip(*columns[0], strict=True)))
    up = list(map(list, zip(*columns[1], strict=True)))
    place = {key: i for i, key in enumerate(node)}
    above = [place.get(p, -1) for p in parent]
    n_open = rows["n_open"]
    if whole:
        n_open = [0] * len(node)
        for p in above:
            if p >= 0:
                n_open[p] += 1
    waiting = [True] * len(node)
    given: dict[tuple, list] = {}
    leaves = [i for i, n in enumerate(n_open) if not n]
    raked = []
    while leaves:
        i = leaves.pop()
        raked.append(i)
        waiting[i] = False
        p = above[i]
        if p >= 0:
            more = own[p]
            n_open[p] -= 1
            if not n_open[p]:
                leaves.append(p)
        elif parent[i][0] is not None:
            more = given.setdefault(parent[i], [0] * len(sums))
        else:
            continue
        for k in range(len(sums)):
            more[k] += own[i][k] + up[i][k]
    # Chains of nodes that wait for one child, which is here and waits too, are spliced out.
    left = [i for i, w in enumerate(waiting) if w]
    here = [0] * len(node)
    for i in left:
        if above[i] >= 0:
            here[above[i]] += 1
    passed = [
        w and n == 1 and h == 1 and p[0] is not None
        for w, n, h, p in zip(waiting, n_open, here, parent, strict=True)
    ]
    child: list[tuple] = [(None, None)] * len(node)
    spliced, active = [], []
    for i in left:
        if passed[i]:
            continue
        active.append(i)
        v = above[i]
        while v >= 0 and passed[v]:
            spliced.append(v)
            child[v], parent[i] = node[i], parent[v]
            # Of a node spliced out, what it has apart from its child's total.
            for k in range(len(sums)):
                own[v][k], up[i][k] = own[v][k] + up[i][k], up[i][k] + own[v][k] + up[v][k]
            v = above[v]
    for state, some in (("raked", raked), ("spliced", spliced), ("active", active)):
        yield (
            state,
            [(*node[i], *parent[i]) for i in some],
            [own[i] + up[i] for i in some],
            [child[i] for i in some],
        )
    nothing = [0] * len(sums)
    yield (
        "given",
        [(*key, None, None) for key in given],
        [more + nothing for more in given.values()],
        [(None, None)] * len(given),
    )


def _within_tasks(active: DataFrame, sums: list[str], whole: bool = False) -> DataFrame:
    """Every active node with what became of it in the task that has it, as ``_contracted`` says, and
    rows ``given``, of nodes that other tasks have. ``TASK_NODES`` rows of a task go at a time."""
    on_way = [f"{s}_up" for s in sums]
    flat = active.select(
        F.col("node.x").alias("x"),
        F.col("node.y").alias("y"),
        F.col("parent.x").alias("px"),
        F.col("parent.y").alias("py"),
        *sums,
        *on_way,
        (F.lit(0).cast("long") if whole else F.col("n_open")).alias("n_open"),
        "turn",
    )
    names = ["x", "y", "px", "py", *sums, *on_way, "cx", "cy", "turn", "state"]
    most = TASK_NODES

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emitted(part: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(part).to_pydict()
            turn = rows["turn"][0] + 1
            for state, keys, kept, children in _contracted_part(rows, sums, whole):
                for start in range(0, len(keys), 8_192):
                    cut = slice(start, start + 8_192)
                    found = zip(keys[cut], kept[cut], children[cut], strict=True)
                    columns = zip(*[(*key, *has, *c) for key, has, c in found], strict=True)
                    arrays = [pa.array(column, pa.int64()) for column in columns]
                    n = len(arrays[0])
                    arrays += [pa.array([turn] * n, pa.int32()), pa.array([state] * n)]
                    yield pa.RecordBatch.from_arrays(arrays, names)

        part, n = [], 0
        for batch in batches:
            if batch.num_rows:
                part.append(batch)
                n += batch.num_rows
            if n >= most:
                yield from emitted(part)
                part, n = [], 0
        if part:
            yield from emitted(part)

    kinds = [f"{name} long" for name in names[:-2]] + ["turn int", "state string"]
    found = flat.mapInArrow(contract, ", ".join(kinds))

    def pair(x: str, y: str) -> Column:
        return F.when(F.col(x).isNotNull(), F.struct(F.col(x).alias("x"), F.col(y).alias("y")))

    return found.select(
        F.struct("x", "y").alias("node"),
        pair("px", "py").alias("parent"),
        *sums,
        *on_way,
        pair("cx", "cy").alias("child"),
        "turn",
        "state",
    )


def with_children(nodes: DataFrame) -> DataFrame:
    """The nodes (``node, parent, ...``) with the number of their children, ``n_children``."""
    children = (
        nodes.where("parent IS NOT NULL")
        .groupBy(F.col("parent").alias("node"))
        .agg(F.count("*").alias("n_children"))
    )
    return nodes.join(children, "node", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0)).cast("long")
    )


def subtree_totals(tree: DataFrame, sums: list[str], near: list[str] | None = None) -> DataFrame:
    """``node`` and, for each column of ``sums``, its total over the node and all below it.

    ``tree`` has ``node, parent`` (structs of two longs ``x, y``; null above a root) and the columns,
    long. There may be several roots. Keys must be unique and parents be there. ``near``: columns by
    which nodes lie near their children, as most do; they say which nodes a task has at first and
    change no total. ``n_children`` is counted if it is not there.

    Rounds lie side by side in one folder of the shared space, ``round=0/state=raked`` and so on, and
    going back reads them as one table, of which a round takes those after it.
    """
    spark = tree.sparkSession
    path = scratch_path(spark, "contraction")
    near = near or ["node"]
    if "n_children" not in tree.columns:
        tree = with_children(tree)
    on_way = [F.lit(0).cast("long").alias(f"{s}_up") for s in sums]
    dealt = tree.repartitionByRange(*near).sortWithinPartitions(*near)
    first = _within_tasks(
        dealt.select(
            "node", "parent", *sums, *on_way, F.col("n_children").alias("n_open"), F.lit(0).alias("turn")
        ),
        sums,
    )
    stored = first.drop("state").schema

    def of(rounds: str, state: str) -> DataFrame:
        """Rows of one state in the rounds of a pattern."""
        return spark.read.schema(stored).parquet(f"{path}/round={rounds}/state={state}")

    def there(number: int, state: str) -> bool:
        return path_exists(spark, f"{path}/round={number}/state={state}")

    first.write.partitionBy("state").parquet(f"{path}/round=0")
    if not there(0, "raked"):
        return tree.select("node", *sums)  # no nodes
    rounds, spliced = 0, []
    while True:
        if there(rounds, "spliced"):
            spliced.append(rounds)
        if not there(rounds, "active"):
            break
        active = of(str(rounds), "active").drop("child")
        few = active.count() <= TASK_NODES
        if not rounds:
            given = of("0", "given").groupBy("node").agg(*[F.sum(s).alias(f"{s}_in") for s in sums])
            totals = {s: F.col(s) + F.coalesce(F.col(f"{s}_in"), F.lit(0)) for s in sums}
            active = _met(active, given).withColumns(totals).drop(*[f"{s}_in" for s in sums])
        rounds += 1
        left = _within_tasks(active.coalesce(1), sums, True) if few else _contracted(active, sums)
        left.write.partitionBy("state").parquet(f"{path}/round={rounds}")
    # Everything that a round's waiting nodes hang on was settled in later rounds, or is by now.
    kept = ["node", *sums, "turn"]
    raked = of("*", "raked").select(*kept)
    expanded = spark.createDataFrame([], raked.schema)
    for number in reversed(spliced):
        below = raked.unionByName(expanded).where(F.col("turn") > number + 1)
        below = below.select(
            F.col("node").alias("child"), *[F.col(s).alias(f"{s}_below") for s in sums]
        )
        whole = of(str(number), "spliced").join(below.hint("merge"), "child")
        whole = whole.select(
            "node", *[(F.col(s) + F.col(f"{s}_below")).alias(s) for s in sums], "turn"
        )
        whole.write.parquet(f"{path}/expanded/back={number}")
        expanded = spark.read.schema(raked.schema).parquet(f"{path}/expanded/*")
    return raked.unionByName(expanded).drop("turn")


# Ids that end at a node ------------------------------------------------------------------------


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids in order as texts of up to ``IDS`` of them, each with its node and first id."""
    names = ["x", "y", "first", "ids"]
    out: list[tuple] = []
    node, ids = None, []

    def text() -> tuple:
        return (*node, ids[0], ",".join(map(str, ids)))

    for batch in batches:
        x, y, conv = (batch.column(c).to_pylist() for c in range(3))
        for row in zip(x, y, conv, strict=True):
            if row[:2] != node or len(ids) == IDS:
                if ids:
                    out.append(text())
                node, ids = row[:2], []
            ids.append(row[2])
            if len(out) >= 1_024:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                out = []
    if ids:
        out.append(text())
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest a node from its texts in order; a text at a time goes into it."""
    names = ["x", "y", "ends_sha256"]
    out: list[tuple] = []
    node, taken = None, None
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            for x, y, ids in zip(*(part.column(c).to_pylist() for c in (0, 1, 3)), strict=True):
                if (x, y) != node:
                    if taken:
                        out.append((*node, taken.hexdigest()))
                    node, taken = (x, y), hashlib.sha256(ids.encode())
                else:
                    taken.update(b"," + ids.encode())
            if len(out) >= 4_096:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                out = []
    if taken:
        out.append((*node, taken.hexdigest()))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)


def end_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256`` from ``node, conv_id``, one row a conversation.

    A digest can only be taken in order, but the texts that go into it are made apart: ids are sorted
    over all tasks, so a node on which a third of the conversations end is many texts by then.
    """
    rows = ends.select(F.col("node.x").alias("x"), F.col("node.y").alias("y"), "conv_id")
    texts = (
        rows.repartitionByRange("x", "y", "conv_id")
        .sortWithinPartitions("x", "y", "conv_id")
        .mapInArrow(_joined, "x long, y long, first long, ids string")
    )
    return (
        texts.repartition("x", "y")
        .sortWithinPartitions("x", "y", "first")
        .mapInArrow(_digested, "x long, y long, ends_sha256 string")
        .select(F.struct("x", "y").alias("node"), "ends_sha256")
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``,
    one row a node; further, ``node`` and ``parent``, their prints.

    The conversations are those that ``rebuilt`` makes. Null roles and texts are empty; rows with a
    null id belong to no conversation and are left out; equal turns of one conversation are turns of
    their own, ordered as ``ordered_turns`` says, and repeated rows repeat the turn. Further columns
    are not read. Without conversations there is no root, and no row. Nodes are told apart by 128-bit
    prints; among a hundred billion of them two are alike with a chance below 1 in 10^16.
    """
    turns = written(ordered_turns(conversations), "ordered")
    starts = written(prefixes(rebuilt(turns)), "prefixes")
    ids = turns.select("conv_id").distinct()
    everyone = ids.select(
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("chars"),
        _root().alias("node"),
        F.lit(None).cast("struct<x:long,y:long>").alias("parent"),
    )
    passing = starts.select("conv_id", "depth", "chars", "node", "parent").unionByName(everyone)
    nodes = written(
        passing.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"),
            F.min("depth").alias("depth"),
            F.min("chars").alias("chars"),
            F.count("*").alias("n_convs"),
            F.min("parent.x").alias("px"),
            F.min("parent.y").alias("py"),
        ),
        "nodes",
    )
    parent = F.when(F.col("px").isNotNull(), F.struct(F.col("px").alias("x"), F.col("py").alias("y")))
    nodes = nodes.withColumn("parent", parent).drop("px", "py")
    counted = written(with_children(nodes), "counted")
    totals = subtree_totals(
        counted.select(
            "node",
            "parent",
            (F.col("n_children") == 0).cast("long").alias("n_leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
            "n_children",
            "conv_id",
            "depth",
        ),
        ["n_leaves", "saved_tokens"],
        # A conversation has those nodes of which it is the least member one below the other.
        near=["conv_id", "depth"],
    )
    last = starts.groupBy("conv_id").agg(F.max("depth").alias("depth"))
    ending = starts.join(last, ["conv_id", "depth"]).select("node", "conv_id")
    turnless = ids.join(last, "conv_id", "left_anti").select(_root().alias("node"), "conv_id")
    ends = end_digests(ending.unionByName(turnless))
    above = counted.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        counted.join(above, "parent", "left")
        .join(totals, "node")
        .join(ends, "node", "left")
        .select(
            "node",
            "parent",
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        )
    )
