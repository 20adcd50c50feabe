"""Hard negatives of embedding rows by Fagin's threshold algorithm.

A component x counts as floor(256 * x), a score is the integer inner product of two
rows. Anchors are rows whose id is divisible by ``ANCHOR``. An anchor's positives
are its ``POSITIVES`` best other rows of its label; its hard negatives, for each
positive, are the ``NEGATIVES`` best rows of other labels whose score lies between
``LOW`` and ``HIGH`` hundredths of the positive's.

All rows are dealt into shards by a hash, and the anchors into blocks; every block
meets every shard in one group of bounded size (``SHARD`` rows, ``BLOCK`` anchors).
A group sorts each dimension once. For an anchor, the lists are read in step, from
the top where its component is positive and from the bottom where it is negative;
each row met is scored in full at once. No unread row scores more than the
threshold, the sum of the anchor's products with the values that the lists have
come to. A window is done when the threshold is strictly below its k-th score, so
that no tie is missed, or below its lower end. The best of each shard are merged.

Defined results: rows with a null id, label or vector, or a null or non-finite
component (also once scaled) take no part; rows that repeat id, label and vector
count once; rows that share an id only are rows of their own, and none is the
other's positive; vectors of different lengths are compared as if the shorter
ended in zeros; scores beyond 64 bits are shown as the nearest long; extra columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.llm.common import saved, scratch, ship

ANCHOR = 100
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
SHARD = 8192
BLOCK = 4096
EXACT = 1 << 46  # products below it, times 100, are exact as doubles
LONGEST = (1 << 63) - 1

ROW = "vec_id long, key long, label long, v array<double>"
FOUND = "anchor_id long, anchor_key long, near_id long, near_key long, near_score long, " \
        "negative_id long, negative_score long"


class Lists:
    """Rows with one list of them for each dimension, sorted by that component."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, keys: np.ndarray) -> None:
        self.x, self.ids, self.keys = x, ids, keys
        columns = np.ascontiguousarray(x.T)
        self.order = np.argsort(columns, axis=1, kind="stable")
        self.values = np.take_along_axis(columns, self.order, axis=1)

    def best(self, anchor: np.ndarray, valid: np.ndarray, windows: list[tuple], k: int) -> list[np.ndarray]:
        """Indices of the first ``k`` valid rows of each window (from, to), in
        hundredths of a score; higher scores first, ties by id."""
        n = len(self.x)
        used = np.flatnonzero(anchor != 0)
        up, down = used[anchor[used] > 0], used[anchor[used] < 0]
        seen = np.zeros(n, bool)
        scores = np.zeros(n, self.x.dtype)
        best = [np.empty(0, np.int64) for _ in windows]
        todo = list(range(len(windows)))
        depth, upto = 0, min(n, max(64, n // 32))
        while todo:
            # sorted access to the entries depth .. upto - 1 of every list
            met = np.zeros(n, bool)
            met[self.order[up, n - upto:n - depth].ravel()] = True
            met[self.order[down, depth:upto].ravel()] = True
            if upto == n:  # a list has been read to its end, or no list is needed
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen[new] = True
            scores[new] = self.x[new] @ anchor  # random access
            threshold = 100 * ((anchor[up] * self.values[up, n - upto]).sum()
                               + (anchor[down] * self.values[down, upto - 1]).sum())
            new = new[valid[new]]
            for w in list(todo):
                low, high = windows[w]
                s = 100 * scores[new]
                some = np.concatenate([best[w], new[(s >= low) & (s <= high)]])
                best[w] = some = some[np.lexsort((self.ids[some], -scores[some]))[:k]]
                if upto == n or threshold < low or (len(some) == k and threshold < 100 * scores[some[-1]]):
                    todo.remove(w)
            depth, upto = upto, min(n, 2 * upto)
        self.scores = scores
        return best


def _matrix(vectors: pa.Array) -> np.ndarray:
    """floor(256 * x) of all vectors, padded with zeros; exact integers."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1]) < sizes[:, None]] = np.floor(256 * flat)
    return out


def _exact(x: np.ndarray) -> np.ndarray:
    """``x`` as it is if all products of its rows are exact, else as Python integers."""
    if x.shape[1] * float(np.abs(x).max(initial=0)) ** 2 < EXACT:
        return x
    return np.array([[int(v) for v in row] for row in x], object).reshape(x.shape)


def _long(score) -> int:
    return max(-LONGEST - 1, min(LONGEST, int(score)))


def _miner(table: pa.Table) -> pa.Table:
    """Positives of the anchors without windows, hard negatives of those with any,
    among the rows of one shard."""
    table = table.combine_chunks()
    x = _exact(_matrix(table.column("v")))
    ids, keys, labels = (table.column(c).to_numpy() for c in ("vec_id", "key", "label"))
    near = table.column("near").to_pylist()
    anchors = np.flatnonzero(table.column("anchor").to_numpy(zero_copy_only=False))
    rows = np.flatnonzero(~table.column("anchor").to_numpy(zero_copy_only=False))
    out: list[tuple] = []
    lists: dict = {}

    def of(key, index):
        if key not in lists:
            lists[key] = Lists(x[index], ids[index], keys[index])
        return lists[key]

    for a in anchors[np.argsort(labels[anchors], kind="stable")]:
        name = (ids[a], keys[a])
        if near[a] is None:
            same = rows[labels[rows] == labels[a]]
            if len(same):
                found = of(labels[a], same)
                best, = found.best(x[a], found.ids != ids[a], [(-math.inf, math.inf)], POSITIVES)
                out += [(*name, found.ids[i], found.keys[i], _long(found.scores[i]), None, None) for i in best]
        elif len(rows):
            found = of(None, rows)
            windows = [(LOW * p["near_score"], HIGH * p["near_score"]) for p in near[a]]
            for p, best in zip(near[a], found.best(x[a], labels[rows] != labels[a], windows, NEGATIVES)):
                out += [(*name, p["near_id"], p["near_key"], p["near_score"], found.ids[i],
                         _long(found.scores[i])) for i in best]
    names = [c.split()[0] for c in FOUND.split(", ")]
    columns = list(zip(*out)) if out else [()] * len(names)
    return pa.table({c: pa.array([None if v is None else int(v) for v in col], pa.int64())
                     for c, col in zip(names, columns)})


def mined(rows: DataFrame, anchors: DataFrame, shards: int, blocks: int) -> DataFrame:
    """What every anchor finds in every shard."""
    ship(rows.sparkSession)

    def dealt(some: DataFrame, shard, block, anchor: bool) -> DataFrame:
        return some.select(shard.alias("shard"), block.alias("block"), F.lit(anchor).alias("anchor"),
                           "vec_id", "key", "label", "v", "near")

    def all_of(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def one_of(n: int):
        return F.pmod(F.xxhash64("vec_id", "key"), F.lit(n)).cast("int")

    none = F.lit(None).cast("array<struct<near_id: long, near_key: long, near_score: long>>")
    both = dealt(rows.withColumn("near", none), one_of(shards), all_of(blocks), False).unionByName(
        dealt(anchors, all_of(shards), one_of(blocks), True))
    return both.groupBy("shard", "block").applyInArrow(_miner, FOUND)


def hard_negatives(spark: SparkSession, embeddings: DataFrame, shard: int = SHARD,
                   block: int = BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    vector = F.col("embedding").cast("array<double>")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x * 256) == float("inf")))
    label = F.col("label").cast("long")
    with scratch(spark):
        rows = (embeddings.where(F.col("vec_id").isNotNull() & label.isNotNull() & vector.isNotNull())
                .where(~odd).select(
                    F.col("vec_id").cast("long"),
                    F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
                    vector.alias("v"))
                .withColumn("key", F.xxhash64("label", "v")).dropDuplicates(["vec_id", "key"]))
        rows = saved(spark, rows, "negatives-rows")
        anchors = rows.where(F.col("vec_id") % ANCHOR == 0)
        shards = max(1, math.ceil(rows.count() / shard))
        blocks = max(1, math.ceil(anchors.count() / block))
        none = F.lit(None).cast("array<struct<near_id: long, near_key: long, near_score: long>>")
        order = Window.partitionBy("anchor_id", "anchor_key").orderBy(F.desc("near_score"), "near_id", "near_key")
        first = mined(rows, anchors.withColumn("near", none), shards, blocks)
        near = (first.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= POSITIVES)
                .groupBy("anchor_id", "anchor_key").agg(
                    F.collect_list(F.struct("near_id", "near_key", "near_score")).alias("near")))
        near = anchors.join(near.withColumnsRenamed({"anchor_id": "vec_id", "anchor_key": "key"}),
                            ["vec_id", "key"])
        near = saved(spark, near, "negatives-near")
        found = mined(rows, near, shards, blocks)
        order = Window.partitionBy("anchor_id", "anchor_key", "near_id", "near_key").orderBy(
            F.desc("negative_score"), "negative_id")
        out = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEGATIVES)
        return saved(spark, out.select(
            "anchor_id", F.col("near_id").alias("positive_id"), "rank", "negative_id",
            F.col("near_score").alias("positive_score"), "negative_score"), "negatives", keep=True)
