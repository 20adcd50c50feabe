"""File replay of a message table, the offline stand-in for the bus.

The file stream source takes new files in modification-time order. Messages
are written one folder per event day by a single distributed write; the
files then get modification times that increase with the day, so a replay
delivers days in order. Rows are range-partitioned by arrival time, so the files
of a day are in time order, too, and the watermark never overtakes unread data
wherever a trigger ends.
Only file metadata passes through the driver, never rows. Setting file times
needs a file system that supports it (HDFS, local disk); object stores keep
upload times, so replays there should come from the bus instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a file that holds a part of a period; a message has some 400 bytes when it
# is sorted, and a task gets several parts at times.
ROWS_PER_FILE = 250_000


def write_replay(spark: SparkSession, messages: DataFrame, path: str,
                 mode: str = "overwrite", folder_format: str = "yyyy-MM-dd",
                 base_mtime_ms: int = 1_000_000_000_000, n_files: int | None = None,
                 in_order: bool = False) -> int:
    """Write ``messages`` under ``path``, one folder per arrival day (or per
    ``folder_format`` period), and order the file times by folder.

    ``n_files`` is the number of time ranges (default: the shuffle partitions).
    Messages that are ``in_order`` (made of ``in_time_order`` events) are written as they
    are dealt.
    Folders sort by name in time order; a file's time is ``base`` plus its
    folder's rank times 100 seconds plus its rank within the folder in milliseconds.
    A later ``append`` of newer periods therefore queues behind what is
    already there (a restart test). Returns the number of data files.
    """
    ranges = (n_files,) if n_files else ()
    dealt = messages if in_order else messages.repartitionByRange(*ranges, "timestamp")
    (dealt.withColumn("replay_period", F.date_format("timestamp", folder_format))
     .write.mode(mode).partitionBy("replay_period").parquet(path))
    return _order_files(spark, path, base_mtime_ms)


def in_time_order(events: DataFrame, rows: int, rows_per_range: int = 2 * ROWS_PER_FILE) -> DataFrame:
    """Events (``rows`` of them) dealt over ranges of their time, to be made into messages
    afterwards: neither the ranges' bounds nor the shuffle then need a payload, and a
    range has some ``rows_per_range`` rows however many there are."""
    ranges = max(events.sparkSession.sparkContext.defaultParallelism, -(-rows // rows_per_range))
    return events.repartitionByRange(ranges, "event_timestamp")


def write_periods(spark: SparkSession, messages: DataFrame, path: str, folder_format: str = "yyyy-MM-dd",
                  rows_per_file: int = ROWS_PER_FILE, base_mtime_ms: int = 1_000_000_000_000) -> int:
    """Write ``messages`` so that a trigger of as many files as this returns reads one
    arrival period whole: every period gets that number of files, of some
    ``rows_per_file`` rows in the largest one. A period's rows are dealt by a hash (the
    order within a batch is free), so no task holds a period; files that a small period
    lacks are copies of an empty one."""
    period = F.date_format("timestamp", folder_format)
    sizes = messages.groupBy(period.alias("replay_period")).count().agg(F.max("count"), F.sum("count")).first()
    files = max(1, -(-(sizes[0] or 0) // rows_per_file))
    tasks = max(1, -(-(sizes[1] or 0) // rows_per_file))
    slot = F.pmod(F.xxhash64("partition", "offset", "timestamp"), F.lit(files)).cast("int")
    (messages.withColumn("replay_period", period).withColumn("replay_slot", slot)
     .repartition(tasks, "replay_period", "replay_slot")
     .write.mode("overwrite").partitionBy("replay_period", "replay_slot").parquet(path))
    if files > 1:
        _fill_slots(spark, messages, path, files)
    _order_files(spark, path, base_mtime_ms)
    return files


def _fill_slots(spark: SparkSession, messages: DataFrame, path: str, files: int) -> None:
    """An empty file for every slot without rows."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.hadoop.fs.Path
    root = hadoop(path)
    fs = root.getFileSystem(conf)
    empty = None
    for folder in [s.getPath() for s in fs.listStatus(root) if s.isDirectory()]:
        for slot in range(files):
            target = hadoop(folder, f"replay_slot={slot}")
            if fs.exists(target):
                continue
            if empty is None:
                aside = f"{path}_empty"
                messages.limit(0).coalesce(1).write.mode("overwrite").parquet(aside)
                empty = next(s.getPath() for s in fs.listStatus(hadoop(aside))
                             if s.getPath().getName().endswith(".parquet"))
            fs.mkdirs(target)
            jvm.org.apache.hadoop.fs.FileUtil.copy(fs, empty, fs, hadoop(target, empty.getName()), False, conf)


def _order_files(spark: SparkSession, path: str, base_mtime_ms: int) -> int:
    """File times that increase with the period's folder, then the slot and the name."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    by_folder: dict[str, list] = {}
    it = fs.listFiles(root, True)
    while it.hasNext():
        p = it.next().getPath()
        if p.getName().endswith(".parquet"):
            folder = p.getParent()
            if folder.getName().startswith("replay_slot="):
                folder = folder.getParent()
            by_folder.setdefault(folder.getName(), []).append(p)
    n = 0
    for rank, folder in enumerate(sorted(by_folder)):
        for i, p in enumerate(sorted(by_folder[folder], key=lambda f: f.getName())):
            fs.setTimes(p, base_mtime_ms + rank * 100_000 + i, -1)
            n += 1
    return n
