r"""Near-duplicate documents by bottom-k sketches.

A document is the set of its distinct word shingles (ASCII letters lower-cased,
words ``[^\x20\x09-\x0D]+``). One hash function gives every shingle a value; a
document's sketch is its k smallest values.

1. Documents with equal sets form a class (equal digest); one node stands for it.
2. Inverted lists of retained values. With similarity t or more, two sketches
   share at least ``need`` values (exactly so if both sketches are whole sets,
   else but for a probability of 6e-7 at t = 0.8 and less above it). Hence, in any
   common order of values, they share one among their first
   ``size - need + 1`` values. The order is rarest first, so lists of common
   shingles are never opened.
3. Linking without all pairs of a list: every list's most typical member, its
   hub, is paired with the others. Pairs are filtered by set sizes and by the
   similarity that the union sketch estimates, then verified on the full sets;
   those of 0.6 or more keep what they lack of the hub's set and what they add to
   it. The verified links make components. Members near a hub but outside its
   component are compared with all near members by these two differences, from
   which the similarity follows exactly. Members far from the hub (below 0.6)
   cannot link to those linked with it, as Jaccard distance obeys the triangle
   inequality; they are compared with the list's other members inside the join,
   by sketches, and the pairs that pass are verified on the full sets.
   Pairs already in one component are left out.
4. Components by alternating star contraction, written out between steps.

Defined results: null, empty or white-space texts have no shingles, size 0 and
are their own component; texts of fewer words than the shingle length are one
shingle; rows that repeat an id are the same document if their sets are equal,
else they are linked by similarity alone; a null id never names a component
unless all members lack one; extra columns are ignored; an empty table gives no
rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.llm import textnum
from cartpulse.llm.common import lookup, map_arrow, saved, scratch, slices, unused

K = 64
NEED_TRUNCATED = 32  # of 64 union values 51 are expected in both at t = 0.8
THRESHOLD = (80, 100)
# Pairs with a hub are followed from this similarity on: below it, a member
# cannot link to one that is linked with the hub (0.4 - 0.2 = 1 - 0.8).
NEAR = (60, 100)
NEED_NEAR = 20  # of 64 union values 38 are expected in both at 0.6


def shingle_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    raw = [(t or "").encode().lower() for t in texts]
    out = []
    for a, b in textnum.chunks(raw, 1 << 18):
        words, bounds = textnum.word_hashes(raw[a:b])
        if len(words) >= n:
            rows = words[:len(words) - n + 1].copy()
            for j in range(1, n):
                rows = textnum.mix(rows * np.uint64(textnum.MULTIPLIER) + words[j:len(words) - n + 1 + j])
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            if hi - lo >= n:
                out.append(np.unique(rows[lo:hi - n + 1]))
            elif hi > lo:
                h = np.array([0x51ED270B], np.uint64)
                for i in range(lo, hi):
                    h = textnum.mix(h * np.uint64(3) + words[i:i + 1])
                out.append(h)
            else:
                out.append(np.empty(0, np.uint64))
    return out


def _sketcher(n: int, k: int):
    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(batch.column("text").to_pylist(), n)
            heads = [s[:k].view(np.int64) for s in sets]
            ends = np.cumsum([0] + [len(h) for h in heads]).astype(np.int32)
            flat = np.concatenate(heads) if heads else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("text_key"),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None
                          for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            ], names=["doc_id", "text_key", "n_shingles", "digest", "sketch"])
    return run


def sketches(docs: DataFrame, n: int, k: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    return map_arrow(rows, _sketcher(n, k), "doc_id long, text_key long, n_shingles long, "
                                            "digest binary, sketch array<bigint>")


def _need(n: Column, k: int, t: tuple[int, int]) -> Column:
    """Values that two sketches share at least, one of them of a set of n."""
    whole = k * t[0] // t[1]  # partners of smaller sets are whole, too
    return F.when(n <= whole, F.ceil(n * t[0] / t[1])).otherwise(NEED_TRUNCATED * k // K)


def postings(spark: SparkSession, nodes: DataFrame, k: int, t: tuple[int, int]) -> DataFrame:
    """(value, node, n, typical): the first values of each node, rarest first,
    without values that only one node has."""
    all_values = nodes.select("node", "n", F.explode("sketch").alias("value"))
    shared = all_values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    met = all_values.join(shared, "value")
    own = Window.partitionBy("node")
    kept = F.least("n", F.lit(k))
    met = (met.withColumn("n_met", F.count("*").over(own))
           .withColumn("common", F.sum(F.log("df")).over(own))
           .withColumn("rank", F.row_number().over(own.orderBy("df", "value"))))
    first = kept - _need(F.col("n"), k, t) + 1 - (kept - F.col("n_met"))
    return saved(spark, met.where(F.col("rank") <= first).select(
        "value", "node", "n", (F.col("common") / kept).alias("typical")), "minhash-postings")


def _sizes_fit(a: str, b: str, t: tuple[int, int]) -> Column:
    return (F.least(F.col(a), F.col(b)) * t[1] >= F.greatest(F.col(a), F.col(b)) * t[0])


def hub_pairs(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(value, hub) of every list, and distinct (a, b): hubs with their members."""
    hubs = lists.groupBy("value").agg(
        F.count("*").alias("members"),
        F.max(F.struct("typical", "n", "node")).alias("top")).where("members > 1")
    hubs = hubs.select("value", F.col("top.node").alias("hub"), F.col("top.n").alias("n_hub"))
    pairs = (lists.join(hubs, "value").where((F.col("node") != F.col("hub"))
                                             & _sizes_fit("n", "n_hub", NEAR))
             .select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct())
    return hubs.select("value", "hub"), pairs


def _alike(na: Column, nb: Column, sa: Column, sb: Column, k: int, t: tuple[int, int],
           need: int) -> Column:
    """Whether the union sketch leaves a pair: enough of its k values are in both.
    For sets that are whole in it the test is exact."""
    both = F.array_intersect(sa, sb)
    union = F.array_union(sa, sb)
    common = F.size(F.array_intersect(F.slice(F.array_sort(union), 1, k), both))
    whole = (na <= k) & (nb <= k)
    return F.when(whole, F.size(both) * t[1] >= F.size(union) * t[0]).otherwise(
        (F.size(both) >= need) & (common >= need))


def estimated(pairs: DataFrame, nodes: DataFrame, k: int, t: tuple[int, int],
              need: int) -> DataFrame:
    sk = nodes.select("node", "n", "sketch")
    both = (pairs.join(sk.toDF("a", "na", "sa"), "a").join(sk.toDF("b", "nb", "sb"), "b"))
    c = F.col
    return both.where(_alike(c("na"), c("nb"), c("sa"), c("sb"), k, t, need)).select("a", "b")


def _compare(n: int, t: tuple[int, int]):
    """Similarity test of pairs of texts; keeps b's differences from a's set."""
    def run(batches):
        for batch in slices(batches, 64):
            a, b = (shingle_sets(batch.column(c).to_pylist(), n) for c in ("ta", "tb"))
            rows, common, na, nb, extra, lacks = [], [], [], [], [], []
            for i, (x, y) in enumerate(zip(a, b)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if both * t[1] >= (len(x) + len(y) - both) * t[0]:
                    rows.append(i)
                    common.append(both)
                    na.append(len(x))
                    nb.append(len(y))
                    extra.append(np.setdiff1d(y, x, assume_unique=True).view(np.int64))
                    lacks.append(np.setdiff1d(x, y, assume_unique=True).view(np.int64))
            at = pa.array(rows, pa.int64())
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(at), batch.column("b").take(at), pa.array(common, pa.int64()),
                 pa.array(na, pa.int64()), pa.array(nb, pa.int64()),
                 pa.array(extra, longs), pa.array(lacks, longs)],
                names=["a", "b", "common", "na", "nb", "extra", "lacks"])
    return run


def verified(spark: SparkSession, pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int,
             t: tuple[int, int]) -> DataFrame:
    """Pairs whose full sets reach ``t``: a, b, common, na, nb, extra, lacks."""
    wanted = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
    keyed = nodes.join(wanted, "node").select("node", F.col("rep").alias("doc_id"), "text_key")
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    texts = rows.join(keyed, rows.doc_id.eqNullSafe(keyed.doc_id)
                      & (rows.text_key == keyed.text_key)).select("node", "text")
    # rows that repeat an id and a text would repeat their pairs
    texts = saved(spark, texts.dropDuplicates(["node"]), "minhash-texts")
    joined = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b"))
    return saved(spark, map_arrow(
        joined.select("a", "b", "ta", "tb"), _compare(n, t),
        "a long, b long, common long, na long, nb long, extra array<bigint>, lacks array<bigint>"),
        "minhash-verified")


def _reaches(common: Column, na: Column, nb: Column, t: tuple[int, int]) -> Column:
    return common * t[1] >= (na + nb - common) * t[0]


def near_links(near: DataFrame, comps: DataFrame, t: tuple[int, int]) -> DataFrame:
    """(a, b): links between members near one hub (a) of which one is outside the
    hub's component; exact, from the members' differences to the hub."""
    hub = comps.toDF("a", "hub_comp")
    own = comps.toDF("b", "comp")
    rows = (near.join(hub, "a", "left").join(own, "b", "left")
            .withColumn("comp", F.coalesce("comp", "b"))
            .withColumn("hub_comp", F.coalesce("hub_comp", "a")))
    outside = rows.where("comp <> hub_comp")
    # the groups that have members outside
    rows = rows.join(outside.select("a").distinct(), "a", "left_semi")
    x, y = outside.alias("x"), rows.alias("y")
    c = F.col
    common = (c("x.na") - F.size("x.lacks") - F.size("y.lacks")
              + F.size(F.array_intersect("x.lacks", "y.lacks"))
              + F.size(F.array_intersect("x.extra", "y.extra")))
    sizes = (F.least(c("x.nb"), c("y.nb")) * t[1] >= F.greatest(c("x.nb"), c("y.nb")) * t[0])
    once = (c("y.comp") == c("y.hub_comp")) | (c("x.b") < c("y.b"))
    return (x.join(y, (c("x.a") == c("y.a")) & (c("x.comp") != c("y.comp")) & once & sizes
                   & _reaches(common, c("x.nb"), c("y.nb"), t))
            .select(c("x.b").alias("a"), c("y.b").alias("b")).distinct())


def far_pairs(lists: DataFrame, hubs: DataFrame, near: DataFrame, comps: DataFrame,
              nodes: DataFrame, k: int, t: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of a list, one far from its hub and the other not linked with
    it, of different components and alike by their sketches. What one list says of
    a pair is enough, so each pair is looked at in the first list both are in."""
    status = near.select(F.col("a").alias("hub"), F.col("b").alias("node"),
                         _reaches(F.col("common"), F.col("na"), F.col("nb"), t).alias("linked"))
    rows = (lists.select("value", "node", "n").join(hubs, "value").where("node <> hub")
            .join(status, ["hub", "node"], "left").where("linked is null or not linked")
            .withColumn("far", F.col("linked").isNull()).select("value", "node", "n", "far"))
    rows = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    open_lists = (rows.groupBy("value").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                            F.max("far").alias("any_far"))
                  .where("any_far and lo < hi").select("value"))
    all_lists = lists.groupBy("node").agg(F.collect_list("value").alias("in_lists"))
    rows = (rows.join(open_lists, "value").join(nodes.select("node", "sketch"), "node")
            .join(all_lists, "node"))
    x, y = rows.where("far").alias("x"), rows.alias("y")
    c = F.col
    first = F.array_min(F.array_intersect("x.in_lists", "y.in_lists")) == c("x.value")
    once = (~c("y.far") | (c("x.node") < c("y.node"))) & first
    return (x.join(y, (c("x.value") == c("y.value")) & (c("x.comp") != c("y.comp")) & once
                   & _sizes_fit("x.n", "y.n", t)
                   & _alike(c("x.n"), c("y.n"), c("x.sketch"), c("y.sketch"), k, t,
                            NEED_TRUNCATED * k // K))
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b"))
            .distinct())


def _stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour, which has none itself."""
    ends = (edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionAll(edges.select("b", F.lit(0), F.lit(1))))
    return (ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .where("up > 1 or up = 1 and down = 1").isEmpty())


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node of each connected component, for all
    nodes of ``edges`` (a, b). Alternates large and small star contraction."""
    edges = saved(spark, edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .where("a <> b").distinct(), "minhash-stars")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where("b > a and b <> m")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # every edge now points from the larger node to the smaller
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = (small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select("a", F.col("m").alias("b"))).distinct())
        edges = saved(spark, small, "minhash-stars")
    return (edges.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            .union(edges.select("b", "b")).distinct())


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 5, k: int = K,
                    threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """(doc_id, text_key, n_shingles, component_id, kept) of every document;
    ``text_key`` is the hash of its text.

    ``threshold`` is the similarity as a fraction (80, 100).
    """
    with scratch(spark):
        sk = saved(spark, sketches(docs, shingle, k), "minhash-sketches")
        # one row for each set; ids are drawn once, when the table is written
        nodes = (sk.where("digest is not null").groupBy("digest").agg(
            F.min(F.struct("doc_id", "text_key")).alias("first"), F.min("doc_id").alias("low"),
            F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch"), F.count("*").alias("copies"))
            .select("digest", "low", "copies", F.col("first.doc_id").alias("rep"),
                    F.col("first.text_key").alias("text_key"), "n", "sketch",
                    F.monotonically_increasing_id().alias("node")))
        nodes = saved(spark, nodes, "minhash-nodes")
        lists = postings(spark, nodes, k, threshold)

        hubs, pairs = hub_pairs(lists)
        near = verified(spark, saved(spark, estimated(pairs, nodes, k, NEAR, NEED_NEAR * k // K),
                                     "minhash-pairs"), nodes, docs, shingle, NEAR)
        links = near.where(_reaches(F.col("common"), F.col("na"), F.col("nb"), threshold)).select("a", "b")
        comps = components(spark, links)
        links = saved(spark, links.union(near_links(near, comps, threshold)), "minhash-links")
        comps = components(spark, links)
        rest = saved(spark, far_pairs(lists, hubs, near, comps, nodes, k, threshold), "minhash-pairs")
        if not rest.isEmpty():
            more = verified(spark, rest, nodes, docs, shingle, threshold).select("a", "b")
            comps = components(spark, links.union(more))

        # a component, and a class of equal sets, may hold a third of all rows
        named = (nodes.select("digest", "copies", "node", "low").join(comps, "node", "left")
                 .withColumn("comp", F.coalesce("comp", "node")))
        least = saved(spark, named.groupBy("comp").agg(F.min("low").alias("component_id"),
                                                       F.count("*").alias("sets")), "minhash-least")
        named = saved(spark, lookup(named, least, "comp", "sets", "node").select(
            "digest", "copies", "component_id"), "minhash-named")
        out = lookup(sk.select("doc_id", "text_key", "n_shingles", "digest"), named, "digest", "copies",
                     "doc_id")
        component = F.coalesce("component_id", "doc_id")
        return saved(spark, out.select(
            "doc_id", "text_key", "n_shingles", component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept")), "minhash-result", keep=True)


def one_of_each(spark: SparkSession, docs: DataFrame, shingle: int = 5) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates; rows that
    repeat an id and a text count as one document."""
    id_, key = (unused(c, docs.columns) for c in ("_id", "_key"))
    with scratch(spark):
        gone = (near_duplicates(spark, docs, shingle).where("not kept")
                .select(F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct())
        gone = saved(spark, gone, "minhash-dropped", keep=True)
    out = docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[id_])
                    & F.xxhash64(docs["text"]).eqNullSafe(gone[key]), "left_anti")
    repeats = docs.groupBy("doc_id", F.xxhash64("text").alias(key)).count().where("count > 1")
    if repeats.isEmpty():
        return out
    return out.withColumn(key, F.xxhash64("text")).dropDuplicates(["doc_id", key]).drop(key)
