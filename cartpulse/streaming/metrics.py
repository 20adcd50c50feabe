"""C14: what every micro-batch of the alert query did, kept by a query listener.

The listener turns each progress report into one row: input rows, the observed
``alert_batch`` metrics, rows dropped as late and rows of state. A row is a small
JSON file named after run and batch, made under another name and renamed, so a
batch that runs again replaces its row.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

METRICS_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in (
    "run_started", "batch_id", "input_rows", "changed_windows", "alerts", "alert_views",
    "alert_purchases", "rows_dropped_late", "state_rows")])


class BatchMetrics(StreamingQueryListener):
    """Writes the progress of the query ``name`` (any query if None) under ``path``."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None, run: int = 0) -> None:
        self.spark, self.path, self.name, self.run = spark, path.rstrip("/"), name, run

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if self.name is not None and p.name != self.name:
            return
        observed = p.observedMetrics.get("alert_batch")
        if observed is None:  # another query of the session, or a report without a batch
            return
        state = p.stateOperators
        self._write({
            "run_started": self.run, "batch_id": p.batchId, "input_rows": p.numInputRows,
            **{c: observed[c] for c in ("changed_windows", "alerts", "alert_views", "alert_purchases")},
            "rows_dropped_late": sum(s.numRowsDroppedByWatermark for s in state),
            "state_rows": sum(s.numRowsTotal for s in state)})

    def _write(self, row: dict) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_{uuid.uuid4().hex}")
        final = jvm.org.apache.hadoop.fs.Path(
            f"{self.path}/{row['run_started']:015d}-{row['batch_id']:012d}.json")
        fs = draft.getFileSystem(conf)
        out = fs.create(draft)
        try:
            out.write(bytearray(json.dumps(row).encode()))
        finally:
            out.close()
        fs.delete(final, False)
        fs.rename(draft, final)


def reports_written(spark: SparkSession, seconds: int = 60) -> None:
    """Wait until the listeners have seen every report of queries that have ended."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(seconds * 1000)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """One row for each batch; empty (with its schema) before the first."""
    from cartpulse.sinks.tables import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], METRICS_SCHEMA)
    return spark.read.schema(METRICS_SCHEMA).json(path)
