"""C2, exact with bounded state: events accepted once, however late their id returns.

A stream's own de-duplication keeps every id (``exact``) or forgets ids behind the
watermark (``bounded``). Here ids lie in an index on the shared file system and the
state of the alert query is that of its open windows only:

1. ``accept_sink`` (``foreachBatch``) keeps one row for each id of the batch and
   drops those whose id the index has from an earlier batch.
2. The rest are written aside and published by one rename of their folder to the
   table of accepted events; a batch that runs again finds its folder there and
   leaves it. The alert query streams from that table (``dedup="accepted"``).
3. The index (``AcceptedIds``) is an upsert log: the deltas of recent batches are
   joined as they are; older ids lie in a base by day, with a Bloom filter for each
   day (rows of 64-bit words, one word for an id). A batch's ids are joined with the
   words of all days, and only days that some id may be in are read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartpulse.operators.cleanse import deduplicate
from cartpulse.schema import CLEAN_EVENT_SCHEMA
from cartpulse.sinks.upsert_log import LOG_COLUMNS, UpsertLog

ID_SCHEMA = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("event_date", T.DateType())])
WORDS = 1 << 20  # 64-bit words of a day's filter; some 8 ids a word keep it sharp
BITS = 4


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(words)).cast("int")


def _bits() -> Column:
    """Bits of an id in its word, drawn from another hash."""
    h = F.xxhash64(F.lit(1), "event_id")
    out = F.lit(0).cast("long")
    for k in range(BITS):
        at = F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63))
        out = out.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at.cast("int")))
    return out


class AcceptedIds(UpsertLog):
    """Ids by the day of their event, with a Bloom filter for each day of the base."""

    roots = ("base", "bloom")

    def __init__(self, spark: SparkSession, path: str, words: int = WORDS) -> None:
        super().__init__(spark, path, ID_SCHEMA, ["event_id"], "event_date")
        self.words = words

    def _write_base(self, rows: DataFrame, generation: str) -> None:
        super()._write_base(rows, generation)
        ids = self.spark.read.parquet(f"{self.path}/base/{generation}")
        # the day is kept in the files, too: leaf folders are read as they are
        filters = (ids.groupBy(F.col("log_day").cast("string").alias("day"), _word(self.words).alias("word"))
                   .agg(F.bit_or(_bits()).alias("bits")).withColumn("log_day", F.col("day")))
        filters.write.partitionBy("log_day").parquet(f"{self.path}/bloom/{generation}")

    def known(self, ids: DataFrame, run: int, batch: int) -> DataFrame:
        """Those of ``ids`` (event_id) that batches before (run, batch) have accepted."""
        manifest = self.manifest()
        ids = ids.select("event_id").distinct()
        before = (F.col("run_started") < run) | ((F.col("run_started") == run) & (F.col("batch_id") < batch))
        out = [ids.join(part.where(before).select("event_id"), "event_id", "left_semi")
               for part in self._rows_of(manifest, {})]
        if manifest.days:
            schema = "day string, word int, bits long"
            filters = self.spark.read.schema(schema).parquet(
                *[f"{self.path}/bloom/{g}/log_day={d}" for d, g in sorted(manifest.days.items())])
            maybe = (ids.withColumn("word", _word(self.words)).withColumn("mask", _bits())
                     .join(filters, "word").where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
                     .select("event_id", "day"))
            days = [r.day for r in maybe.select("day").distinct().collect()]  # days of the table at most
            if days:
                base = self.spark.read.schema(self.schema).parquet(
                    *[f"{self.path}/base/{manifest.days[d]}/log_day={d}" for d in sorted(days)])
                out.append(maybe.select("event_id").distinct()
                           .join(base.select("event_id"), "event_id", "left_semi"))
        if not out:
            return ids.where("false")
        return out[0] if len(out) == 1 else out[0].unionByName(out[1]).distinct()


def accept_sink(path: str, run: int = 0, compact_every: int = 20,
                words: int = WORDS) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` over valid events: accepted ones go to ``path/events``, their
    ids to ``path/ids``."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        index = AcceptedIds(spark, f"{path}/ids", words)
        rows = deduplicate(batch.select(*CLEAN_EVENT_SCHEMA.fieldNames())).persist()
        try:
            fresh = rows.join(index.known(rows, run, batch_id), "event_id", "left_anti").persist()
            try:
                index.append(fresh.select("event_id", "event_date"), run, batch_id)
                _publish(spark, fresh.select(*CLEAN_EVENT_SCHEMA.fieldNames()), path, run, batch_id)
            finally:
                fresh.unpersist()
        finally:
            rows.unpersist()
        manifest = index.manifest()
        done = [d for d in index.deltas() if (manifest.run, manifest.batch) < d < (run, batch_id)]
        if len(done) >= compact_every:
            index.compact(*done[-1])
    return handle


def _publish(spark: SparkSession, rows: DataFrame, path: str, run: int, batch_id: int) -> None:
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path
    final = hadoop(f"{path}/events/run_started={run}/batch_id={batch_id}")
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(final):  # published before the batch was committed
        return
    aside = hadoop(f"{path}/_aside/{uuid.uuid4().hex}")
    rows.write.parquet(aside.toString())
    fs.mkdirs(final.getParent())
    if not fs.rename(aside, final):
        raise RuntimeError(f"cannot publish {final}")


def start_accept_query(events: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                       run: int = 0, compact_every: int = 20, words: int = WORDS) -> StreamingQuery:
    """Accept the valid events of a stream, each id once."""
    return (events.writeStream.outputMode("append")
            .foreachBatch(accept_sink(path, run, compact_every, words))
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"})).start())


def read_accepted_stream(spark: SparkSession, path: str) -> DataFrame:
    """The accepted events as a stream, batch by batch."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/events")
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    schema = T.StructType(CLEAN_EVENT_SCHEMA.fields + LOG_COLUMNS)
    return spark.readStream.schema(schema).parquet(f"{path}/events").drop("run_started", "batch_id")
