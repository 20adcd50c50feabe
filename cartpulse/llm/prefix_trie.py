"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations are rebuilt (``rebuild``): the first h turns of the conversation at
the head of its hundred, then its own turns after its first h. Every distinct
sequence of first d turns (role, text) is a node of depth d; the textless root has
depth 0.

1. A turn's content is a 128-bit hash. Turns are sorted into ranges, so that one
   conversation of any length is spread over tasks; places in it, and the running
   exclusive or of (place, content) hashes that names each prefix, are summed
   within a range and then over the ranges of a conversation.
2. Nodes are the groups of equal prefixes. The members of a node, and its weight,
   the number of turns that its members have from it on, are plain sums, partly
   aggregated before the shuffle, however common a first turn is.
3. Sums over subtrees: the parent-edge forest is split at centroids. The root is
   the first one; what is left are the trees of the first turns. In a component of
   weight W, the nodes of weight W / 2 or more are the path from its top to its
   centroid, the deepest of them. The total of the centroid's subtree goes to the
   centroid and is added to all nodes of that path; the subtree's branches and the
   rest above become components of at most half the weight. Components over
   ``LIMIT`` are split by Spark, all at once in each round, by joins on bounded
   lists of centroids; what is smaller is finished in one task in the same way.
4. The list of members that end at a node is joined in pieces of ``RANGE`` ids;
   its SHA-256 then streams over the pieces of a node.

Defined results: rows without conv_id take no part; a null turn comes first, equal
turns are ordered by hashes of their contents; a null role or text is empty;
repeated rows are turns each; extra columns are ignored; an empty table gives no
rows, not even a root; an id c belongs to the hundred c - c % 100, with the sign of
c for the remainder.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.llm.common import crc32_unsigned, lookup, map_arrow, saved, scratch

HUNDRED = 100
HEADS = 6  # h is a remainder by this
LIMIT = 100_000  # weight of a component that one task finishes
CENTROIDS = 1 << 16  # components that a round splits, at most
RANGE = 256  # conversation ids that one piece of a list covers

KEY = "struct<a: long, b: long>"


def _root() -> Column:
    return F.expr(f"cast(struct(0L, 0L) as {KEY})")


def _xor(x: Column, y: Column) -> Column:
    return F.struct(x["a"].bitwiseXOR(y["a"]).alias("a"), x["b"].bitwiseXOR(y["b"]).alias("b"))


def _step(depth: Column, content: Column) -> Column:
    """Hash of a turn at its depth; a prefix is the exclusive or of its steps."""
    return F.struct(F.xxhash64(depth, content["a"], content["b"]).alias("a"),
                    F.xxhash64(content["b"], content["a"], depth).alias("b"))


def turns(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """(conv_id, nth, content, chars) of every turn and ``piece``: the range of the
    sort that it lies in; nth counts from 1 within piece and conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    content = F.struct(F.xxhash64(F.lit(1), role, text).alias("a"),
                       F.xxhash64(F.lit(2), role, text).alias("b"))
    rows = (conversations.where(F.col("conv_id").isNotNull())
            .select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                    content.alias("content"), F.length(text).cast("long").alias("chars"))
            # spreads repeated rows; these are equal, so their order says nothing
            .withColumn("row", F.monotonically_increasing_id()))
    rows = saved(spark, rows, "trie-turns")
    order = [F.col("turn").asc_nulls_first(), "content", "row"]
    rows = rows.repartitionByRange("conv_id", *order).withColumn("piece", F.spark_partition_id())
    own = Window.partitionBy("piece", "conv_id").orderBy(*order)
    return saved(spark, rows.withColumn("nth", F.row_number().over(own)).select(
        "conv_id", "piece", F.col("nth").cast("long"), "content", "chars"), "trie-pieces")


def rebuild(spark: SparkSession, conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, depth, node, parent, top, chars, length) for each turn of
    each rebuilt conversation, and (conv_id, length) of all conversations."""
    own = turns(spark, conversations)
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(
        Window.unboundedPreceding, -1)
    pieces = own.groupBy("conv_id", "piece").agg(F.count("*").alias("n")).withColumn(
        "past", F.coalesce(F.sum("n").over(before), F.lit(0)))
    convs = pieces.groupBy("conv_id").agg(F.sum("n").alias("n_own"))

    # the prefixes that a hundred can share: up to five nodes each
    first = (own.where((F.col("conv_id") % HUNDRED == 0) & (F.col("nth") < HEADS))
             .join(pieces, ["conv_id", "piece"]).withColumn("depth", F.col("past") + F.col("nth"))
             .where(F.col("depth") < HEADS))
    steps = F.sort_array(F.collect_list(F.struct(
        "depth", _step(F.col("depth"), F.col("content")).alias("step"), "chars")))

    def prefix(i: Column) -> Column:
        return F.aggregate(F.slice("steps", 1, i), _root(),
                           lambda acc, s: _xor(acc, s["step"]))

    heads = first.groupBy(F.col("conv_id").alias("head")).agg(steps.alias("steps")).select(
        "head", F.transform("steps", lambda s: F.struct(
            s["depth"].alias("depth"), prefix(s["depth"].cast("int")).alias("node"),
            prefix(s["depth"].cast("int") - 1).alias("parent"), s["chars"].alias("chars"))).alias("nodes"))
    plan = (convs.withColumn("head", F.col("conv_id") - F.col("conv_id") % HUNDRED)
            .withColumn("h", F.pmod(crc32_unsigned(F.col("conv_id").cast("string")), F.lit(HEADS)))
            .join(heads, "head", "left"))
    shared = F.slice("nodes", 1, F.least("h", F.size("nodes")).cast("int"))
    plan = plan.withColumn("nodes", F.coalesce(shared, F.expr(
        f"cast(array() as array<struct<depth: long, node: {KEY}, parent: {KEY}, chars: long>>)")))
    plan = plan.withColumn("k", F.size("nodes").cast("long"))
    plan = saved(spark, plan.select(
        "conv_id", "h", "k", "nodes", (F.col("k") + F.greatest(F.lit(0), F.col("n_own") - F.col("h")))
        .alias("length")), "trie-plan")

    # own turns after the first h
    starts = pieces.join(plan.select("conv_id", "h", "k"), "conv_id").drop("n")
    rows = (own.join(starts, ["conv_id", "piece"])
            .withColumn("depth", F.col("k") + F.col("past") + F.col("nth") - F.col("h"))
            .where(F.col("depth") > F.col("k"))
            .withColumn("step", _step(F.col("depth"), F.col("content"))))
    here = Window.partitionBy("conv_id", "piece").orderBy("nth")
    rows = saved(spark, rows.select(
        "conv_id", "piece", "depth", "chars", "step",
        F.struct(F.bit_xor("step.a").over(here).alias("a"),
                 F.bit_xor("step.b").over(here).alias("b")).alias("sum")), "trie-steps")
    ends = rows.groupBy("conv_id", "piece").agg(
        F.bit_xor("step.a").alias("a"), F.bit_xor("step.b").alias("b"),
        F.max(F.when(F.col("depth") == 1, F.col("step"))).alias("top"))
    ends = ends.join(_bases(plan), "conv_id")
    ends = ends.select(
        "conv_id", "piece", "length",
        _xor(F.col("base"), F.struct(
            F.coalesce(F.bit_xor("a").over(before), F.lit(0)).alias("a"),
            F.coalesce(F.bit_xor("b").over(before), F.lit(0)).alias("b"))).alias("past"),
        F.coalesce("head_top", F.max("top").over(Window.partitionBy("conv_id"))).alias("top"))
    node = _xor(F.col("past"), F.col("sum"))
    rows = rows.join(ends, ["conv_id", "piece"]).select(
        "conv_id", "depth", node.alias("node"), _xor(node, F.col("step")).alias("parent"),
        "top", "chars", "length")
    heads = plan.select("conv_id", "length", F.get("nodes", F.lit(0))["node"].alias("top"),
                        F.explode("nodes").alias("n"))
    heads = heads.select("conv_id", "n.depth", "n.node", "n.parent", "top", "n.chars", "length")
    return (saved(spark, rows.unionByName(heads), "trie-rows"),
            plan.select("conv_id", "length"))


def _bases(plan: DataFrame) -> DataFrame:
    """Of each conversation: its first shared node, and its last one (else the root)."""
    return plan.select("conv_id", "length", F.get("nodes", F.lit(0))["node"].alias("head_top"),
                       F.coalesce(F.get("nodes", F.col("k").cast("int") - 1)["node"], _root()).alias("base"))


# --- sums over subtrees --------------------------------------------------------


def split_round(spark: SparkSession, state: DataFrame, rows: DataFrame,
                limit: int) -> tuple[DataFrame, DataFrame] | None:
    """Split all components heavier than ``limit`` at their centroids: (state of the
    rest, finished centroids); None if there is none."""
    tops = state.where("node = comp").select(F.col("comp").alias("big"), F.col("weight").alias("whole"))
    big = F.broadcast(saved(spark, tops.where(F.col("whole") > limit), "trie-big"))
    if big.isEmpty():
        return None
    mine = state.join(big, F.col("comp") == F.col("big"), "left").drop("big")
    mine = mine.withColumn("path", F.coalesce(2 * F.col("weight") >= F.col("whole"), F.lit(False)))
    centres = saved(spark, mine.where("path").groupBy("comp").agg(F.max(F.struct(
        "depth", "node", "weight")).alias("c")).select(
        "comp", F.col("c.node").alias("centre"), F.col("c.depth").alias("centre_depth"),
        F.col("c.weight").alias("centre_weight")), "trie-centres")
    # the branch of the centroid that a conversation takes
    branches = rows.join(F.broadcast(centres), F.col("parent") == F.col("centre")).select(
        "conv_id", "comp", F.col("node").alias("branch"))
    mine = mine.join(F.broadcast(centres), "comp", "left").join(branches, ["conv_id", "comp"], "left")
    below = F.col("branch").isNotNull() & (F.col("depth") > F.col("centre_depth"))
    mine = saved(spark, mine.withColumn("below", F.coalesce(below, F.lit(False)))
                 .withColumn("is_centre", F.coalesce(F.col("node") == F.col("centre"), F.lit(False))),
                 "trie-split")
    totals = mine.where("below or is_centre").groupBy("comp").agg(
        F.sum("own_leaves").alias("t_leaves"), F.sum("own_saved").alias("t_saved"))
    mine = mine.join(F.broadcast(totals), "comp", "left")
    gains = F.col("path") & F.col("t_leaves").isNotNull()
    out = mine.select(
        *[c for c in state.columns if c not in ("comp", "weight", "leaves", "saved")],
        F.when(F.col("below"), F.col("branch")).otherwise(F.col("comp")).alias("comp"),
        (F.col("weight") - F.when(gains, F.col("centre_weight")).otherwise(0)).alias("weight"),
        (F.col("leaves") + F.when(gains, F.col("t_leaves")).otherwise(0)).alias("leaves"),
        (F.col("saved") + F.when(gains, F.col("t_saved")).otherwise(0)).alias("saved"), "is_centre")
    out = saved(spark, out, "trie-state")
    return out.where("not is_centre").drop("is_centre"), out.where("is_centre").drop("is_centre")


def roll_up(parent: list[int], own: list[list[int]], trees: list[list[int]]) -> list[list[int]]:
    """Sums of each column of ``own`` over the subtrees of all ``trees``, by centroid
    decomposition. A tree lists its nodes, parents before their children."""
    n, columns = len(parent), range(len(own))
    total = [[0] * n for _ in columns]  # contributions so far
    size, part, at = [0] * n, [[0] * n for _ in columns], [0] * n
    todo = list(trees)
    while todo:
        members = todo.pop()
        top = members[0]
        for u in members:
            size[u] = 1
            for j in columns:
                part[j][u] = own[j][u]
        for u in reversed(members[1:]):
            p = parent[u]
            size[p] += size[u]
            for j in columns:
                part[j][p] += part[j][u]
        centre = next(u for u in reversed(members) if 2 * size[u] >= len(members))
        u = centre
        while True:  # from the centroid to the top of its component
            for j in columns:
                total[j][u] += part[j][centre]
            if u == top:
                break
            u = parent[u]
        parts: dict[int, list[int]] = {}
        for u in members:
            if u != centre:
                at[u] = u if u == top or parent[u] == centre else at[parent[u]]
                parts.setdefault(at[u], []).append(u)
        todo += parts.values()
    return total


TOGETHER = 8192  # rows of small components that are finished at once


def _finisher(batches):
    """Components lie together, ordered by depth; sums are added to what they have."""
    def finish(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        keys, ups, comps = ([(k["a"], k["b"]) for k in table.column(c).to_pylist()]
                            for c in ("node", "parent", "comp"))
        # a top's parent is in another component, so it is never looked up
        index = {k: i for i, k in enumerate(keys)}
        parent = [index.get(u, -1) for u in ups]
        trees: dict[tuple, list[int]] = {}
        for i, c in enumerate(comps):
            trees.setdefault(c, []).append(i)
        sums = roll_up(parent, [table.column(c).to_pylist() for c in ("own_leaves", "own_saved")],
                       list(trees.values()))
        for name, new in zip(("leaves", "saved"), sums):
            old = table.column(name).to_pylist()
            table = table.set_column(table.schema.get_field_index(name), name,
                                     pa.array([x + y for x, y in zip(new, old)], pa.int64()))
        return table.to_batches()[0]

    held, n = [], 0
    for batch in batches:
        comps = batch.column("comp")
        a, b = (comps.field(c).to_numpy() for c in ("a", "b"))
        starts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
        if held and len(batch):
            end = held[-1].column("comp")[-1].as_py()
            if (end["a"], end["b"]) != (a[0], b[0]):
                starts = np.concatenate([[0], starts])
        # the last place where no component is cut
        if n + len(batch) > TOGETHER and len(starts):
            cut = int(starts[-1])
            if cut:
                held.append(batch.slice(0, cut))
            yield finish(pa.Table.from_batches(held))
            held, n, batch = [], 0, batch.slice(cut)
        if len(batch):
            held.append(batch)
            n += len(batch)
    if held:
        yield finish(pa.Table.from_batches(held))


def subtree_sums(spark: SparkSession, nodes: DataFrame, rows: DataFrame, limit: int) -> DataFrame:
    """``nodes`` with ``leaves`` and ``saved``: own_leaves and own_saved summed over
    each node's subtree. Nodes have node, parent, depth, conv_id (a member), weight
    and comp (their tree's first node); ``rows`` says which conversation takes which
    node."""
    total = rows.count()
    limit = max(limit, total // CENTROIDS)
    zero = F.lit(0).cast("long")
    state = saved(spark, nodes.withColumn("leaves", zero).withColumn("saved", zero), "trie-state")
    done = []
    while step := split_round(spark, state, rows, limit):
        state, finished = step
        done.append(finished)
    ordered = state.repartition("comp").sortWithinPartitions("comp", "depth")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ordered.schema)
    out = map_arrow(ordered, _finisher, schema)
    for finished in done:
        out = out.unionByName(finished)
    return out


# --- member lists --------------------------------------------------------------


def _digester(batches):
    """SHA-256 of each node's ids; its pieces lie together, in order."""
    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        for node, text in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if node != key:
                if key is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(text.encode())
        yield _digests(keys, digests)
    if key is not None:
        yield _digests([key], [state.hexdigest()])


def _digests(keys: list[dict], digests: list[str]) -> pa.RecordBatch:
    kind = pa.struct([("a", pa.int64()), ("b", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(digests, pa.string())],
                                      names=["node", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): each id once, ascending."""
    pieces = ends.groupBy("node", F.floor(F.col("conv_id") / RANGE).alias("range")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    ordered = pieces.repartition("node").sortWithinPartitions("node", "range")
    return map_arrow(ordered.select("node", "ids"), _digester, f"node {KEY}, ends_sha256 string")


def prefix_trie(spark: SparkSession, conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """One row for each node: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256."""
    with scratch(spark):
        rows, convs = rebuild(spark, conversations)
        def same(key: str) -> Column:  # equal in all rows of a node
            return F.struct(F.max(f"{key}.a").alias("a"), F.max(f"{key}.b").alias("b")).alias(key)

        nodes = saved(spark, rows.groupBy("node").agg(
            F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), same("parent"),
            same("top"), F.max("chars").alias("chars"), F.count("*").alias("n_convs"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("weight"))
            .withColumnRenamed("top", "comp"), "trie-nodes")
        children = nodes.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
        nodes = nodes.join(children, "node", "left").withColumn(
            "n_children", F.coalesce("n_children", F.lit(0).cast("long")))
        nodes = saved(spark, nodes.withColumn("own_leaves", (F.col("n_children") == 0).cast("long"))
                      .withColumn("own_saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-valued")
        parents = nodes.where("n_children > 0").select(
            F.col("node").alias("parent"), "n_children", F.col("conv_id").alias("parent_conv_id"))
        summed = subtree_sums(spark, lookup(nodes, parents, "parent", "n_children", "conv_id"), rows, limit)

        ends = rows.where("depth = length").select("node", "conv_id").unionByName(
            convs.where("length = 0").select(_root().alias("node"), "conv_id"))
        ends = saved(spark, end_digests(ends), "trie-ends")
        all_convs = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
        whole = nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"),
                          F.sum("own_leaves").alias("leaves"), F.sum("own_saved").alias("saved")).first()
        summed = summed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", F.lit(all_convs.least)))
        root = spark.range(1 if all_convs.n else 0).select(
            _root().alias("node"), F.lit(all_convs.least).cast("long").alias("conv_id"),
            F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
            F.lit(all_convs.n).alias("n_convs"), F.lit(whole.n_children).alias("n_children"),
            F.lit(1 if whole.leaves is None else whole.leaves).cast("long").alias("leaves"),
            F.lit(whole.saved or 0).cast("long").alias("saved"))
        every = summed.select(*root.columns).unionByName(root).join(ends, "node", "left")
        out = every.select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
            F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
        return saved(spark, out, "trie", keep=True)
