"""The streaming flash-sale alert query.

Source (bus or file replay) -> decode -> validate -> de-duplicate ->
watermark -> sliding-window counts -> alert updates -> one ``foreachBatch``
that persists the micro-batch once and feeds every sink.

De-duplication modes (the lateness trap):

* ``bounded`` (default): one watermark of *delay + window length*, then
  ``dropDuplicatesWithinWatermark``. State is bounded, and no row that the
  unbounded shape would count is dropped, because a row only matters while
  its last window is open, which ends at most one window length after it.
* ``exact``: ``dropDuplicates`` before the watermark, as the source does.
  Its state never expires; for finite replays only.

Sink semantics: update mode re-emits a window each time it changes. The
emission keeps every changed window with views over the threshold and sets
``alert_triggered = purchases < limit``; the log is keyed by
(product_id, window_start, run, batch_id). ``current_alerts`` takes the last row
per key and keeps the triggered ones, so an alert that stops qualifying is
retracted instead of left stale. The log is compacted every few batches
(``cartpulse.sinks.upsert_log``), so its folders do not grow with the batches.

Append mode emits final windows only (``final_alert_stream``): when the watermark
passes a window's end, its counts leave the state and the row is written once, with
nothing to upsert or retract.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartpulse.operators.cleanse import decode, validate
from cartpulse.operators.windows import (_seconds, alert_rule, alert_updates, stamp_alerts,
                                         window_counts)
from cartpulse.schema import ALERT_SCHEMA, CLEAN_EVENT_SCHEMA, ENVELOPE_SCHEMA, AlertParams
from cartpulse.session import apply_runtime_conf
from cartpulse.sinks.upsert_log import UpsertLog

BatchSink = Callable[[DataFrame, int], None]


def read_events(spark: SparkSession, source: str = "kafka", path: str | None = None,
                topic: str | None = None, bootstrap: str | None = None,
                max_files_per_trigger: int | None = None,
                max_offsets_per_trigger: int | None = None,
                options: dict | None = None) -> DataFrame:
    """A1: the message stream.

    ``kafka`` subscribes to ``topic`` from the earliest offset and tolerates
    lost offsets (needs the Kafka connector on the classpath). ``text`` reads
    JSON lines, one event payload per line. Any other file format
    (``parquet``, ``json``) replays envelope rows from ``path``.
    """
    reader = spark.readStream
    opts = dict(options or {})
    if source == "kafka":
        if max_offsets_per_trigger:  # bounds a micro-batch after downtime
            opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
        reader = reader.format("kafka").option("kafka.bootstrap.servers", bootstrap) \
            .option("subscribe", topic).option("startingOffsets", "earliest") \
            .option("failOnDataLoss", "false")
        try:
            return reader.options(**opts).load()
        except Exception as e:  # the connector jar is not on the classpath
            if "kafka" not in str(e).lower():
                raise
            raise RuntimeError(
                "the Kafka source needs the spark-sql-kafka-0-10 connector matching this "
                f"Spark ({spark.version}) on the classpath, e.g. spark.jars.packages="
                f"org.apache.spark:spark-sql-kafka-0-10_2.13:{spark.version}") from e
    if max_files_per_trigger:
        opts["maxFilesPerTrigger"] = str(max_files_per_trigger)
    if source == "text":  # JSON lines: one event payload per line, no envelope
        lines = reader.format("text").options(**opts).load(path)
        return lines.select(
            F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
            F.lit(None).cast("int").alias("partition"), F.lit(None).cast("long").alias("offset"),
            F.lit(None).cast("timestamp").alias("timestamp"))
    return reader.schema(ENVELOPE_SCHEMA).format(source).options(**opts).load(path)


def clean_stream(messages: DataFrame, params: AlertParams = AlertParams(),
                 dedup: str = "bounded") -> DataFrame:
    """B1-B10 and C1-C2 on a stream: decoded, valid, de-duplicated, watermarked."""
    return dedup_stream(valid_stream(messages), params, dedup)


def dedup_stream(events: DataFrame, params: AlertParams = AlertParams(),
                 dedup: str = "bounded") -> DataFrame:
    """C1-C2 on valid events. ``accepted`` events have been de-duplicated before
    (``cartpulse.streaming.accepted``): they only get the watermark."""
    if dedup == "accepted":
        return events.withWatermark("event_timestamp", params.watermark)
    if dedup == "exact":
        return events.dropDuplicates(["event_id"]) \
            .withWatermark("event_timestamp", params.watermark)
    if dedup != "bounded":
        raise ValueError(f"dedup must be 'bounded', 'exact' or 'accepted', not {dedup!r}")
    horizon = _seconds(params.watermark) + _seconds(params.window)
    return events.withWatermark("event_timestamp", f"{horizon} seconds") \
        .dropDuplicatesWithinWatermark(["event_id"])


def valid_stream(messages: DataFrame) -> DataFrame:
    """B1-B8 on a stream, for the cleaned-event table (H1): every valid row, with no
    watermark, so that a late row is never lost; copies go when the table is read."""
    return validate(decode(messages))


def alert_stream(messages: DataFrame, params: AlertParams = AlertParams(),
                 dedup: str = "bounded") -> DataFrame:
    """The alert update stream (run in update output mode)."""
    return event_alerts(valid_stream(messages), params, dedup)


def event_alerts(events: DataFrame, params: AlertParams = AlertParams(),
                 dedup: str = "bounded") -> DataFrame:
    """``alert_stream`` over valid events, such as the cleaned-event table's.

    C14 rides along as an observation: every micro-batch's progress report
    carries ``observedMetrics["alert_batch"]`` (changed windows, alerts, and
    their views and purchases), computed in the same pass.
    """
    updates = alert_updates(window_counts(dedup_stream(events, params, dedup), params), params)
    trig = F.col("alert_triggered")
    return updates.observe(
        "alert_batch",
        F.count(F.lit(1)).alias("changed_windows"),
        F.count_if(trig).alias("alerts"),
        F.sum(F.when(trig, F.col("total_views"))).alias("alert_views"),
        F.sum(F.when(trig, F.col("total_purchases"))).alias("alert_purchases"))


def read_clean_stream(spark: SparkSession, path: str) -> DataFrame:
    """The cleaned-event table as a stream, so that messages are decoded by the
    query that writes it only. The source follows the file sink's commit log: it
    sees whole micro-batches, each file once. A trigger takes all that is committed,
    since the files of one batch are in no order of time."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    return spark.readStream.schema(CLEAN_EVENT_SCHEMA).parquet(path)


def run_started(spark: SparkSession, checkpoint: str) -> int:
    """When the checkpoint's run began (ms). The mark lies in the checkpoint: batch
    numbers and mark begin anew together."""
    import time

    from cartpulse.sinks.tables import path_exists
    mark = f"{checkpoint}/run_started"
    if not path_exists(spark, f"{mark}/_SUCCESS"):  # a mark half written is written anew
        (spark.range(1).select(F.lit(time.time_ns() // 10 ** 6).alias("ms"))
         .write.mode("overwrite").parquet(mark))
    return spark.read.parquet(mark).first()["ms"]


def alert_log(spark: SparkSession, path: str) -> UpsertLog:
    return UpsertLog(spark, path, ALERT_SCHEMA, ["product_id", "window_start"], "window_start")


def log_sink(log_path: str, extra: Sequence[BatchSink] = (), run: int = 0,
             compact_every: int | None = None) -> BatchSink:
    """The ``foreachBatch`` handler.

    A batch is one delta of the alert log, keyed by run (see ``run_started``) and
    batch_id; a re-executed batch (after a failure between the write and the
    checkpoint commit) replaces its own rows: the sink is idempotent. With
    ``compact_every``, so many deltas of batches before this one are folded into the
    log's base; intermediate rows of a key go then, its last row stays. With extra
    sinks (console, JDBC) the batch is persisted once
    and every sink reads the cached rows instead of re-running the stateful
    plan. Errors propagate: a failed write fails the batch, never commits it.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        log = alert_log(batch.sparkSession, log_path)
        rows = (batch.withColumn("run_started", F.lit(run).cast("long"))
                .withColumn("batch_id", F.lit(batch_id).cast("long")))
        if extra:
            rows = rows.persist()
        try:
            log.append(rows, run, batch_id)
            for sink in extra:
                sink(rows, batch_id)
        finally:
            if extra:
                rows.unpersist()
        if compact_every:
            manifest = log.manifest()
            done = [d for d in log.deltas() if (manifest.run, manifest.batch) < d < (run, batch_id)]
            if len(done) >= compact_every:
                log.compact(*done[-1])
    return handle


def batch_metrics(log: DataFrame) -> DataFrame:
    """C14: per micro-batch, the changed windows, the alerts and their totals.

    Derived from the alert log (one small aggregate by batch_id) rather than
    computed inside every trigger.
    """
    trig = F.col("alert_triggered")
    return log.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("changed_windows"),
        F.count_if(trig).alias("alerts"),
        F.count_distinct(F.when(trig, F.col("product_id"))).alias("alert_products"),
        F.sum(F.when(trig, F.col("total_views"))).cast("bigint").alias("alert_views"),
        F.sum(F.when(trig, F.col("total_purchases"))).cast("bigint").alias("alert_purchases"),
        F.max(F.when(trig, F.col("conversion_rate"))).alias("max_alert_rate"),
    )


def console_sink(n: int = 20) -> BatchSink:
    """Monitoring output of the triggered alerts of each batch."""
    def show(rows: DataFrame, batch_id: int) -> None:
        rows.filter("alert_triggered").select(
            "product_id", "window_start", "total_views", "total_purchases",
            "conversion_rate").show(n, truncate=False)
    return show


def start_alert_query(alerts: DataFrame, handler: BatchSink, checkpoint: str,
                      trigger: dict | None = None, name: str | None = None) -> StreamingQuery:
    """Update mode, a trigger (default: every minute), a checkpoint."""
    trig = trigger or {"processingTime": "1 minute"}
    writer = alerts.writeStream.outputMode("update").foreachBatch(handler) \
        .option("checkpointLocation", checkpoint).trigger(**trig)
    if name:
        writer = writer.queryName(name)
    return writer.start()


def read_alert_log(spark: SparkSession, path: str) -> DataFrame:
    """The alert log; empty (with its schema) before the first alert batch."""
    return alert_log(spark, path).read()


def final_alert_stream(messages: DataFrame, params: AlertParams = AlertParams(),
                       dedup: str = "bounded") -> DataFrame:
    """C3-C9, append form: alerts of closed windows (run in append output mode)."""
    counts = window_counts(clean_stream(messages, params, dedup), params)
    return stamp_alerts(alert_rule(counts, params))


def start_final_query(alerts: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                      name: str | None = None) -> StreamingQuery:
    """C9-C12, append form: each alert is written once, when the watermark evicts its
    window, to a table of files by day; the file sink's commit log makes the append
    exactly-once."""
    writer = (alerts.withColumn("window_day", F.to_date("window_start")).writeStream
              .outputMode("append").format("parquet").partitionBy("window_day")
              .option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})))
    if name:
        writer = writer.queryName(name)
    return writer.start(path)


def read_final_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alerts of closed windows; empty (with its schema) before the first."""
    from cartpulse.sinks.tables import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], ALERT_SCHEMA)
    schema = T.StructType(ALERT_SCHEMA.fields + [T.StructField("window_day", T.DateType())])
    return spark.read.schema(schema).parquet(path).drop("window_day")


def start_clean_event_sink(clean: DataFrame, path: str, checkpoint: str,
                           trigger: dict | None = None) -> StreamingQuery:
    """H1 from the stream: the decoded, valid events (copies too) appended to
    a parquet table partitioned by event_date (the input of the daily jobs).
    The file sink's metadata log makes the append exactly-once."""
    writer = (clean.drop("processing_timestamp").writeStream.outputMode("append")
              .format("parquet").partitionBy("event_date")
              .option("checkpointLocation", checkpoint))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start(path)


def appended_alerts(log: DataFrame) -> DataFrame:
    """The alert history the source's sink would hold: every emitted row that
    passed the rule when emitted (append-only, so a key repeats each time it
    changes and an alert that later stops qualifying stays). Of a log that is not
    compacted."""
    return log.filter(F.col("alert_triggered")).drop("run_started", "batch_id")


def current_alerts(log: DataFrame) -> DataFrame:
    """flash_sale_alerts = last logged row per (product_id, window_start),
    kept when triggered."""
    last = alert_log(log.sparkSession, "").last_rows(log)
    return last.filter(F.col("alert_triggered")).drop("run_started", "batch_id")


def stop_all(spark: SparkSession) -> None:
    """Stop every active query (used on interrupt)."""
    for q in spark.streams.active:
        q.stop()


def replay_alerts(spark: SparkSession, messages: DataFrame | None, workdir: str,
                  params: AlertParams = AlertParams(), dedup: str = "bounded",
                  max_files_per_trigger: int = 1, state_partitions: int | None = None,
                  replay_path: str | None = None, final: bool = False,
                  compact_every: int | None = None, metrics: str | None = None,
                  in_order: bool = False) -> dict:
    """Replay a message table through the streaming alert query to the end.

    Writes the replay files (or reuses ``replay_path``; ``in_order``: see
    ``write_replay``), runs the query with
    an ``availableNow`` trigger and waits for it. State partitions (fixed by
    the first batch of a new checkpoint) default to the cluster's default
    parallelism, one state store per core. ``final`` runs the append form; ``metrics``
    names a folder for the progress of every batch. Returns
    the paths of the replay, checkpoint and alert log (or table of final alerts).
    """
    from cartpulse.streaming.metrics import BatchMetrics, reports_written
    from cartpulse.streaming.replay import write_replay
    paths = {k: f"{workdir}/{k}" for k in ("replay", "checkpoint", "alert_log")}
    if replay_path:
        paths["replay"] = replay_path
    else:
        write_replay(spark, messages, paths["replay"], in_order=in_order)
    # a session of its own, so that the partition count is nobody else's
    own = spark.newSession()
    apply_runtime_conf(own)
    own.conf.set("spark.sql.shuffle.partitions",
                 str(state_partitions or spark.sparkContext.defaultParallelism))
    # without a cache of the file list every trigger but the last takes its full number
    stream = read_events(own, source="parquet", path=paths["replay"],
                         max_files_per_trigger=max_files_per_trigger, options={"maxCachedFiles": "0"})
    stream = stream.select(*ENVELOPE_SCHEMA.fieldNames())
    trigger = {"availableNow": True}
    listener = BatchMetrics(own, metrics) if metrics else None
    if listener:
        own.streams.addListener(listener)
    if final:
        query = start_final_query(final_alert_stream(stream, params, dedup), paths["alert_log"],
                                  paths["checkpoint"], trigger)
    else:
        query = start_alert_query(alert_stream(stream, params, dedup),
                                  log_sink(paths["alert_log"], compact_every=compact_every),
                                  paths["checkpoint"], trigger)
    query.awaitTermination()
    if listener:
        reports_written(own)
        own.streams.removeListener(listener)
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return paths
