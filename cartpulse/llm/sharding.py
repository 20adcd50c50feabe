"""Uniform shuffle into shards of exact size by a hypergeometric
communication matrix.

Rows are split into parts by a hash. From the part sizes and the wanted shard
sizes the number of rows that goes from every part to every shard is drawn
exactly as a uniform permutation would deal them: each matrix row is a
multivariate hypergeometric draw from the shard places still free. Each part
permutes its rows and deals them out by its matrix row, the rows are exchanged,
and every shard permutes what it received. Sizes are therefore exact (counts at
most one apart) and every arrangement is equally likely, also of rows that repeat:
the random keys hold a number that tells all rows of the table apart.

Only part sizes and the matrix (parts x shards integers) pass through the
driver. Shards are permuted in slices of a random key, so no task sorts more
than a slice.

Defined results: null text counts as no bytes (size 16, crc 0); rows with null
or repeated ids, and fully equal rows, are dealt like any other; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartpulse.llm.common import crc32_unsigned, saved, scratch

ROW_OVERHEAD = 16


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Exact draw for totals of any size, by inversion around the mode.

    Probabilities come from the ratio of neighbouring terms; terms further than
    12 standard deviations from the mode are below double precision.
    """
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((draws + 1) * (good + 1) // (total + 2), low), high)
    sd = math.sqrt(draws * (good / total) * (bad / total) * (total - draws) / (total - 1))
    first, last = max(low, mode - int(12 * sd) - 30), min(high, mode + int(12 * sd) + 30)
    k = np.arange(first, last, dtype=np.float64)
    ratio = (np.log(good - k) + np.log(draws - k) - np.log(k + 1)
             - np.log(bad - draws + k + 1))
    log_p = np.concatenate([[0.0], np.cumsum(ratio)])
    cdf = np.cumsum(np.exp(log_p - log_p.max()))
    return first + int(np.searchsorted(cdf, rng.random() * cdf[-1], side="right"))


def communication_matrix(part_sizes: list[int], n_shards: int, seed: int) -> list[list[int]]:
    """Rows sent from each part to each shard; column sums differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(part_sizes)
    free = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    rng.shuffle(free)
    matrix = []
    for size in part_sizes:
        left, rest, row = size, sum(free), []
        for s in range(n_shards):
            rest -= free[s]
            n = hypergeometric(rng, free[s], rest, left)
            row.append(n)
            left -= n
        free = [f - n for f, n in zip(free, row)]
        matrix.append(row)
    return matrix


def shuffle_into_shards(spark: SparkSession, rows: DataFrame, key: list[str], n_shards: int,
                        seed: int = 20260, rows_per_task: int = 1_000_000) -> DataFrame:
    """``rows`` plus ``shard`` (0 to n_shards - 1) and ``slot`` (gapless from 0).

    ``key`` names columns that seed the two random orders, with a number drawn once
    for each row, so that equal rows are dealt apart like any others.
    ``rows_per_task`` sets how many parts and slices are used.
    """
    with scratch(spark):
        rows = saved(spark, rows.withColumn("_row", F.monotonically_increasing_id()), "sharding-rows")
        placed = _placed(spark, rows, [*key, "_row"], n_shards, seed, rows_per_task)
        return saved(spark, placed.drop("_row"), "sharding-placed", keep=True)


def _placed(spark: SparkSession, rows: DataFrame, key: list[str], n_shards: int, seed: int,
            rows_per_task: int) -> DataFrame:
    def rand(step: str):
        return F.xxhash64(F.lit(seed), F.lit(step), *key)

    n_rows = rows.count()
    n_parts = max(64, math.ceil(n_rows / rows_per_task))
    n_slices = max(1, math.ceil(n_rows / n_shards / rows_per_task))
    keyed = rows.withColumn("_part", F.pmod(rand("part"), F.lit(n_parts)).cast("int"))
    sizes = dict(keyed.groupBy("_part").count().collect())
    matrix = communication_matrix([sizes.get(p, 0) for p in range(n_parts)], n_shards,
                                  zlib.crc32(f"{seed}/{n_rows}".encode()))
    sent = spark.createDataFrame(
        [(p, np.cumsum(row).tolist()) for p, row in enumerate(matrix)],
        "_part int, _upto array<bigint>")

    local = Window.partitionBy("_part").orderBy(rand("local"), *key)
    dealt = (keyed.withColumn("_k", F.row_number().over(local) - 1)
             .join(sent, "_part")
             .withColumn("shard", F.size(F.filter("_upto", lambda u: u <= F.col("_k"))))
             .withColumn("_slice", F.pmod(rand("slice"), F.lit(n_slices)).cast("int"))
             .drop("_part", "_upto", "_k"))
    dealt = saved(spark, dealt, "sharding-dealt")

    before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = (dealt.groupBy("shard", "_slice").count()
               .withColumn("_offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
               .drop("count"))
    within = Window.partitionBy("shard", "_slice").orderBy(rand("slot"), *key)
    return (dealt.withColumn("_r", F.row_number().over(within) - 1)
            .join(offsets, ["shard", "_slice"])
            .withColumn("slot", (F.col("_offset") + F.col("_r")).cast("long"))
            .drop("_offset", "_r", "_slice"))


def shard_documents(spark: SparkSession, docs: DataFrame, n_shards: int = 40) -> DataFrame:
    """Every document's size, checksum, shard and slot, under the law ``rows``."""
    text = F.col("text")
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_OVERHEAD).cast("long").alias("size"),
        crc32_unsigned(text).alias("text_crc32"))
    placed = shuffle_into_shards(spark, rows, ["doc_id", "size", "text_crc32"], n_shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                         "slot", F.lit(None).cast("int").alias("grown_shard"))
