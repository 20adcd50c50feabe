"""Session settings and the shared working folder.

Every job in the package assumes a UTC session: ``event_date`` and
``event_hour`` depend on the session time zone, and the oracle side
(DuckDB) works on UTC-naive timestamps.
"""

from __future__ import annotations

import hashlib
import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings the engine relies on. AQE re-plans joins and coalesces shuffle
# partitions at runtime; skew-join splitting absorbs hot keys in the few
# shuffles that cannot pre-aggregate.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Small aggregates are checkpointed to the shared folder; remove those
    # files once nothing references the checkpointed data.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # RocksDB commits upload only a changelog per micro-batch (snapshots run
    # in the background), instead of a full checkpoint of every store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings that results and state depend on; a live session must take them. The
# rest is tuning, set when a session is built and otherwise left to the launcher.
RUNTIME_CONF = ["spark.sql.session.timeZone", "spark.sql.sources.partitionOverwriteMode",
                "spark.sql.streaming.stateStore.providerClass",
                "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"]


def build_session(master: str | None = "local[8]", shuffle_partitions: int | None = 8,
                  app_name: str = "cartpulse", extra: dict | None = None) -> SparkSession:
    """A session with the engine's settings. ``master`` and the partition count
    are left to the launcher if None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def job_session(app_name: str) -> SparkSession:
    """The session of every command line job: the launcher's master and sizes,
    the engine's settings."""
    return build_session(None, None, app_name)


def apply_runtime_conf(spark: SparkSession) -> None:
    """Put RUNTIME_CONF on a live session and fail if a setting is not taken."""
    for key in RUNTIME_CONF:
        spark.conf.set(key, SESSION_CONF[key])
        if spark.conf.get(key) != SESSION_CONF[key]:
            raise RuntimeError(f"the session does not take {key}={SESSION_CONF[key]}")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests, trial runs) gets a folder of its own where none
    is set: on a cluster, executors would each write to their own disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set: with master {master} it must name a folder "
                "that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cartpulse-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir() or root
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_root(spark), "cartpulse", *parts])


def input_key(sf_dir: str) -> str:
    """Short stable name for one input folder (keeps result tables apart)."""
    base = os.path.basename(os.path.normpath(sf_dir)).replace(".", "_")
    digest = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:8]
    return f"{base}_{digest}"
