"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import cartpulse
from cartpulse.session import work_path

# White space of the word rule, in Java's regular expressions.
SPACE = r"[\x20\x09-\x0D]"
NOT_SPACE = r"[^\x20\x09-\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``saved`` writes inside are removed at the end; those written with
    ``keep`` are left to the scratch around, if there is one."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        jvm = spark.sparkContext._jvm
        for path in _SCRATCH.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def saved(spark: SparkSession, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared working folder and read it back.

    This cuts the lineage: a lost executor re-reads the files instead of
    recomputing the steps before, and later steps prune columns at the scan.
    """
    path = work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    owner = len(_SCRATCH) - (2 if keep else 1)
    if owner >= 0:
        _SCRATCH[owner].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def unused(name: str, columns: list[str]) -> str:
    """``name``, made longer until no column has it (in any letter case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, so that
    tasks import it wherever the driver found it."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(cartpulse.__file__))
    # Spark's file server hands the driver's copy to every executor
    archive = os.path.join(tempfile.mkdtemp(prefix="cartpulse-"), "cartpulse.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


HEAVY = 1000


def lookup(rows: DataFrame, table: DataFrame, key: str, counted: str, spread: str) -> DataFrame:
    """``rows`` left-joined with ``table``, which has one row for each ``key`` and
    is stored; ``counted`` is its number of ``rows`` with that key.

    Keys with more than a thousandth of all rows, fewer than a thousand, are sent
    to every task; the rows that they serve, and rows without a key, are spread by
    ``spread`` over the shuffle of the others, where they meet nothing.
    """
    total = table.agg(F.sum(counted)).first()[0] or 0
    values = [c for c in table.columns if c not in (key, counted)]
    found = table.select(F.col(key).alias("_key"), F.struct(*values).alias("_value"), counted)
    heavy = found.where(F.col(counted) * HEAVY > total).select(
        F.col("_key").alias("_heavy_key"), F.col("_value").alias("_heavy"))
    out = rows.join(F.broadcast(heavy), F.col(key) == F.col("_heavy_key"), "left")
    alone = F.col("_heavy").isNotNull() | F.col(key).isNull()
    out = out.withColumn("_slot", F.when(alone, F.pmod(
        F.xxhash64(spread), F.lit(1 << 16)) + 1).otherwise(0))
    rest = found.select("_key", "_value", F.lit(0).cast("long").alias("_own_slot"))
    out = out.join(rest, (F.col(key) == F.col("_key")) & (F.col("_slot") == F.col("_own_slot")), "left")
    value = F.coalesce("_heavy", "_value")
    return out.select(*rows.columns, *[value[c].alias(c) for c in values])


def slices(batches, rows: int = 256):
    """The batches in pieces of at most ``rows`` rows: what a task holds beside a batch
    stays small, and so does what its Python process keeps afterwards."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def crc32_unsigned(text: Column) -> Column:
    """Unsigned CRC-32 of the UTF-8 bytes; 0 for null."""
    return F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long")


def fold(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``: the held-out rule."""
    return F.pmod(crc32_unsigned(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus))
