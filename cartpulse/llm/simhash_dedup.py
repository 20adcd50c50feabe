r"""Near-duplicate documents by SimHash fingerprints and vantage-point trees.

A text's ASCII letters are lower-cased; its words ``[^\x20\x09-\x0D]+`` give
4-word shingles, repeats included. Bit i of the 64-bit fingerprint is set if it is
set in over half of the shingles' XXH64 values (seed 42). Documents whose
fingerprints differ in 4 bits or fewer are linked.

1. Equal fingerprints are one point; only distinct points are searched.
2. The 64 bits are dealt into three parts. Two points that differ in 4 bits or
   fewer differ in at most one bit of some part, so three trees, each over the
   Hamming distance of its part, find every pair with a search radius of 1 (on
   all 64 bits a radius of 4 would leave nearly every branch open).
3. The top of each tree is grown on a bounded sample of points (``SAMPLE``) and
   sent to the tasks. A node has a vantage point v and a radius m: points within m
   go inside, others outside, down to a home shard. By the triangle inequality
   only points at a distance of exactly m can have partners outside; these visit
   the outer branch as guests. A guest visits every branch that its search ball
   overlaps. Every pair meets once: in the shards of one of the two.
4. A shard's task goes on splitting its points the same way and compares the rest
   by all 64 bits. Where a crowd does not split, a hub takes its near points out of
   the search: they are linked to it, so their own pairs say nothing new, and they
   stay as targets. Each shard emits a spanning forest of its links, not all pairs.
5. A shard over ``GROUP`` points is searched in blocks, after a hub has taken its
   near points out in the same way.
6. Components by alternating star contraction of the forests' edges. A node carries
   its smallest document id, so the component's least node names it.

Defined results: null, empty and white-space texts have fingerprint zero and link
like any other; fewer than four words are one shingle; rows that repeat an id are
linked by their texts alone; a null id never names a component unless all its
documents lack one; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.llm.common import lookup, map_arrow, saved, scratch
from cartpulse.llm.minhash_dedup import components

SHINGLE = 4
SEED = 42
BITS = 4
# At most BITS // 3 = 1 bits differ in one of three parts.
PARTS = [np.uint64((1 << 22) - 1), np.uint64(((1 << 21) - 1) << 22), np.uint64(((1 << 21) - 1) << 43)]
NEAR = BITS // len(PARTS)
SAMPLE = 1 << 16  # points that the tops of the trees are grown on
SHARD = 8192  # points that a shard should be home to
GROUP = 1 << 21  # rows of a shard that one task takes
PAIRS = 1 << 21  # comparisons that a task does not divide further
COMPARED = 1 << 18  # of them at once
BLOCK = 1 << 20  # bytes of a text that are hashed at once
ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)
LONGEST = (1 << 63) - 1

_GAP = re.compile(rb"[\x20\x09-\x0D]")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: bytes | None) -> int:
    """The fingerprint of a UTF-8 text; works through it block by block."""
    text = text or b""
    ones, n, at, carry = np.zeros(64, np.int64), 0, 0, []
    while at < len(text):
        gap = _GAP.search(text, at + BLOCK)
        end = gap.start() if gap else len(text)
        words = carry + text[at:end].lower().split()
        at, last = end, not gap
        if last and not n and 0 < len(words) < SHINGLE:
            shingles = [b" ".join(words)]
        else:
            joined = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]) - 1
            starts = np.concatenate([[0], ends[:-1] + 1]) if words else ends
            spans = zip(starts.tolist(), ends[SHINGLE - 1:].tolist())
            shingles = [joined[a:b] for a, b in spans]
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(s, SEED) for s in shingles], np.uint64)
        rows = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
        for i in range(8):
            ones[8 * i:8 * i + 8] += np.bincount(rows[:, i], minlength=256) @ _BYTE_BITS
        n += len(hashes)
        carry = words[-(SHINGLE - 1):]
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def _printer(batches):
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(prints.view(np.int64))], names=["doc_id", "point"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, point) of every document, the point as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").cast("binary"))
    return map_arrow(rows, _printer, "doc_id long, point long")


def distance(points: np.ndarray, other: np.uint64, mask: np.uint64) -> np.ndarray:
    return np.bitwise_count((points ^ other) & mask)


def best_split(homes: np.ndarray, guests: np.ndarray, mask: np.uint64,
               rng: np.random.Generator) -> tuple[np.uint64, int, float]:
    """(vantage point, radius, share of the comparisons that are left): the best of
    a few vantage points, by samples of both kinds of points."""
    def some(points):
        return points if len(points) <= 1024 else rng.choice(points, 1024)

    h, g = some(homes), some(guests)
    nh, ng = len(homes), len(guests)
    best = (np.uint64(0), 0, 1.0)
    for v in [np.uint64(0), *rng.choice(h, 7)]:
        inside = np.cumsum(np.bincount(distance(h, v, mask), minlength=66)) * (nh / len(h))
        at = np.arange(65)
        ins, out = inside[at], nh - inside[at]
        edge = ins - np.where(at >= NEAR, inside[at - NEAR], 0)  # at -1 where masked
        near_in = near_out = 0.0
        if ng:
            cum = np.cumsum(np.bincount(distance(g, v, mask), minlength=66)) * (ng / len(g))
            near_in = cum[np.minimum(at + NEAR, 65)]
            near_out = ng - np.where(at >= NEAR, cum[at - NEAR], 0)
        left = ins * (ins / 2 + near_in) + out * (out / 2 + near_out + edge)
        m = int(left.argmin())
        share = float(left[m]) / (nh * (nh / 2 + ng))
        if share < best[2]:
            best = (np.uint64(v), m, share)
    return best


def divide(points: np.ndarray, homes: np.ndarray, guests: np.ndarray, vantage: np.uint64,
           radius: int, mask: np.uint64) -> list[tuple[np.ndarray, np.ndarray]]:
    """Homes and guests of the inner and of the outer branch, as indices."""
    dh, dg = (distance(points[i], vantage, mask) for i in (homes, guests))
    inside = dh <= radius
    edge = inside & (dh > radius - NEAR)
    return [(homes[inside], guests[dg <= radius + NEAR]),
            (homes[~inside], np.concatenate([guests[dg > radius - NEAR], homes[edge]]))]


class Tree:
    """The top of a vantage-point tree: nodes (vantage, radius, inner, outer); a
    branch is a node's number or ``~shard``."""

    def __init__(self, mask: np.uint64) -> None:
        self.mask, self.nodes, self.shards, self.root = mask, [], 0, 0

    def grow(self, sample: np.ndarray, total: int, shard: int, seed: int = 3) -> Tree:
        rng = np.random.default_rng(seed)

        def branch(points: np.ndarray) -> int:
            if len(points) * total > shard * len(sample) and len(points) >= 16:
                v, m, share = best_split(points, points[:0], self.mask, rng)
                inside = distance(points, v, self.mask) <= m
                if share < 0.95 and 0 < inside.sum() < len(points):
                    at = len(self.nodes)
                    self.nodes.append(None)
                    self.nodes[at] = (v, m, branch(points[inside]), branch(points[~inside]))
                    return at
            self.shards += 1
            return ~(self.shards - 1)

        self.root = branch(sample)
        return self

    def route(self, points: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(shard, its homes, its guests) for the shards that ``points`` meet."""
        out, todo = [], [(self.root, np.arange(len(points)), np.empty(0, np.int64))]
        while todo:
            at, homes, guests = todo.pop()
            if not len(homes) and not len(guests):
                continue
            if at < 0:
                out.append((~at, homes, guests))
                continue
            v, m, inner, outer = self.nodes[at]
            parts = divide(points, homes, guests, v, m, self.mask)
            todo += [(inner, *parts[0]), (outer, *parts[1])]
        return out


class Forest:
    """Disjoint sets over the points of a task."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, i: np.ndarray) -> np.ndarray:
        r = self.parent[i]
        while True:
            up = self.parent[r]
            if (up == r).all():
                return r
            r = up

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.parent, np.maximum(a, b), np.minimum(a, b))


def link(points: np.ndarray, homes: np.ndarray, guests: np.ndarray, mask: np.uint64,
         forest: Forest, seed: int = 3) -> None:
    """Join in ``forest`` every home with the homes and guests it links to, but for
    links that only repeat what is joined already."""
    rng = np.random.default_rng(seed)
    todo = [(homes, guests, True, True)]
    while todo:
        # within: homes meet each other, too; divisible: not yet found to be a crowd
        homes, guests, within, divisible = todo.pop()
        if not len(homes) or len(homes) + len(guests) < 2:
            continue
        if divisible and len(homes) * (len(homes) / 2 + len(guests)) > PAIRS:
            if within:
                v, m, share = best_split(points[homes], points[guests], mask, rng)
                parts = divide(points, homes, guests, v, m, mask)
                if share < 0.9 and max(len(h) + len(g) for h, g in parts) < len(homes) + len(guests):
                    todo += [(h, g, True, True) for h, g in parts]
                    continue
            # a crowd: the hub with the most near points of a few
            near = max((distance(points[homes], h, ALL_BITS) <= BITS
                        for h in rng.choice(points[homes], 8)), key=lambda x: int(x.sum()))
            if near.sum() * 20 >= len(homes):
                hub = _hub(points[homes[near]], homes[near])
                close = distance(points[homes], points[hub], ALL_BITS) <= BITS
                away = distance(points[guests], points[hub], ALL_BITS)
                met = np.concatenate([homes[close], guests[away <= BITS]])
                forest.union(met, np.full(len(met), hub))
                near, far = homes[close], homes[~close]
                todo.append((far, np.concatenate([guests, near]) if within else guests, within, True))
                # guests that the hub does not link can link to what is near it
                todo.append((near, guests[(away > BITS) & (away <= 2 * BITS)], False, False))
                continue
        both = np.concatenate([homes, guests]) if within else guests
        if not len(both) or (forest.roots(np.concatenate([homes, both])) == forest.roots(homes[:1])).all():
            continue
        step = max(1, COMPARED // len(both))
        for a in range(0, len(homes), step):
            others = both[a:] if within else both
            d = np.bitwise_count(points[homes[a:a + step], None] ^ points[None, others])
            i, j = np.nonzero(d <= BITS)
            forest.union(homes[a + i], others[j])


def _hub(points: np.ndarray, index: np.ndarray) -> int:
    """The point of a crowd nearest to the majority of each of its bits."""
    bits = np.unpackbits(points.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                         bitorder="little").mean(0) > 0.5
    middle = np.packbits(bits, bitorder="little").view("<u8")[0]
    return int(index[np.bitwise_count(points ^ middle).argmin()])


def _router(cast):
    def run(batches):
        for batch in batches:
            points = batch.column("point").to_numpy().view(np.uint64)
            first = 0
            for tree in cast.value:
                for shard, homes, guests in tree.route(points):
                    at = pa.array(np.concatenate([homes, guests]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), first + shard, np.int64)),
                         batch.column("point").take(at), batch.column("low").take(at),
                         pa.array(np.arange(len(at)) < len(homes))],
                        names=["shard", "point", "low", "home"])
                first += tree.shards
    return run


def _linker(cast):
    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        for tree in cast.value:
            if shard < tree.shards:
                break
            shard -= tree.shards
        points = table.column("point").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy(zero_copy_only=False)
        # a block may hold a point both as home and as guest
        order = np.lexsort((~home, points))
        index = np.empty(len(points), np.int64)
        first = np.concatenate([[True], points[order][1:] != points[order][:-1]])
        index[order] = order[np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))]
        forest = Forest(len(points))
        alone = index == np.arange(len(points))
        link(points, np.flatnonzero(home & alone), np.flatnonzero(~home & alone), tree.mask, forest)
        root = forest.roots(np.arange(len(points)))
        linked = np.flatnonzero(root != np.arange(len(points)))
        low = table.column("low").combine_chunks()
        a, b = pa.array(linked), pa.array(root[linked])
        signed = pa.array(points.view(np.int64))
        return pa.table({"a_low": low.take(a), "a_point": signed.take(a),
                         "b_low": low.take(b), "b_point": signed.take(b)})
    return run


def _in_blocks(routed: DataFrame, group: int) -> tuple[DataFrame, DataFrame | None]:
    """``routed`` with the column ``block``: shards over ``group`` rows are dealt
    into blocks in which every point that a hub has not linked meets every other.
    Also the links to these hubs."""
    spark = routed.sparkSession
    # rows / group shards at most
    sizes = routed.groupBy("shard").count().where(F.col("count") > group).collect()
    if not sizes:
        return routed.withColumn("block", F.lit(0).cast("long")), None
    big = [r.shard for r in sizes]
    chances = spark.createDataFrame([(r.shard, 1024 * (1 << 20) // r["count"]) for r in sizes],
                                    "shard long, chance long")
    # about 1024 points of each, which stand near the others
    draw = F.when(F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < F.col("chance"), F.col("point"))
    drawn = routed.where("home").join(F.broadcast(chances), "shard").groupBy("shard").agg(
        F.collect_set(draw).alias("points"), F.max("point").alias("any"))
    hubs = []
    for r in drawn.collect():
        points = np.array(r.points or [r.any], np.int64).view(np.uint64)
        near = np.bitwise_count(points[:, None] ^ points[None, :]) <= BITS
        hubs.append((r.shard, int(points[near.sum(0).argmax()].view(np.int64))))
    hubs = spark.createDataFrame(hubs, "shard long, hub long")
    rows = routed.where(F.col("shard").isin(big)).join(F.broadcast(hubs), "shard")
    rows = rows.withColumn("away", F.bit_count(F.col("point").bitwiseXOR(F.col("hub"))))
    # guests beyond the hub's reach can link to homes near it
    rows = rows.withColumn("rest", (F.col("away") > BITS)
                           & (F.col("home") | (F.col("away") <= 2 * BITS)))
    counts = rows.groupBy("shard").agg(F.count_if("rest").alias("rests"), F.count("*").alias("n"),
                                       F.max(F.when(F.col("point") == F.col("hub"), F.col("low")))
                                       .alias("hub_low"))
    half = max(1, group // 2)
    counts = F.broadcast(counts.withColumn("across", F.ceil(F.col("rests") / half))
                         .withColumn("down", F.ceil(F.col("n") / half)))
    rows = rows.join(counts, "shard")
    slot = F.xxhash64("point")
    links = rows.where((F.col("away") <= BITS) & (F.col("point") != F.col("hub"))).select(
        F.col("low").alias("a_low"), F.col("point").alias("a_point"),
        F.col("hub_low").alias("b_low"), F.col("hub").alias("b_point"))

    def dealt(some: DataFrame, across, down, home: bool) -> DataFrame:
        return (some.withColumn("x", across).withColumn("y", down).withColumn("home", F.lit(home))
                .withColumn("block", F.col("x") * (1 << 31) + F.col("y") + 1)
                .select("shard", "point", "low", "home", "block"))

    def steps(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    rests = dealt(rows.where("rest"), F.pmod(slot, F.col("across")), steps("down"), True)
    others = dealt(rows.where("across > 0"), steps("across"), F.pmod(slot, F.col("down")), False)
    small = routed.where(~F.col("shard").isin(big)).withColumn("block", F.lit(0).cast("long"))
    return small.unionByName(rests).unionByName(others), links


def links(spark: SparkSession, nodes: DataFrame, sample: int = SAMPLE, shard: int = SHARD,
          group: int = GROUP) -> DataFrame:
    """(a, b): edges between nodes (low, point) whose components are those of all
    links; ``nodes`` must be stored."""
    n = nodes.count()
    chance = min(1.0, sample / max(n, 1))
    drawn = (nodes.where(F.pmod(F.xxhash64("point", F.lit(7)), F.lit(1 << 20)) < chance * (1 << 20))
             .select("point").limit(2 * sample).toArrow())
    points = drawn.column("point").to_numpy().view(np.uint64)
    trees = [Tree(mask).grow(points, n, shard) for mask in PARTS]
    cast = spark.sparkContext.broadcast(trees)
    routed = map_arrow(nodes.select("point", "low"), _router(cast),
                       "shard long, point long, low long, home boolean")
    routed, extra = _in_blocks(saved(spark, routed, "simhash-shards"), group)
    found = routed.groupBy("shard", "block").applyInArrow(
        _linker(cast), "a_low long, a_point long, b_low long, b_point long")
    if extra is not None:
        found = found.unionByName(extra)

    def node(side: str):
        return F.struct(F.col(f"{side}_low").alias("low"), F.col(f"{side}_point").alias("point")).alias(side)

    return found.select(node("a"), node("b"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE, shard: int = SHARD,
                    group: int = GROUP) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document."""
    with scratch(spark):
        # the result reads this table and the last
        prints = saved(spark, fingerprints(docs), "simhash-prints", keep=True)
        nodes = saved(spark, prints.groupBy("point").agg(
            F.coalesce(F.min("doc_id"), F.lit(LONGEST)).alias("low"),
            F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-nodes")
        edges = links(spark, nodes, sample, shard, group)
        comps = components(spark, edges).select(
            F.col("node.point").alias("point"), F.col("comp.low").alias("lowest"))
        lowest = F.when(F.col("lowest") < LONGEST, F.col("lowest"))
        named = saved(spark, nodes.join(comps, "point", "left").select(
            "point", "n", F.coalesce(lowest, "least").alias("component_id")),
            "simhash-named", keep=True)
    out = lookup(prints, named, "point", "n", "doc_id")
    return out.select("doc_id", F.lower(F.lpad(F.hex("point"), 16, "0")).alias("fingerprint"),
                      F.coalesce("component_id", "doc_id").alias("component_id"))
