"""The long-running alert job (``python -m cartpulse.streaming.job``).

Starts one alert query whose ``foreachBatch`` feeds the idempotent alert log
(and, optionally, the console and a JDBC table from the same cached batch),
waits on all queries, and stops them on interrupt or when one ends. Checkpoint and log default
to folders under the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from cartpulse.schema import ENVELOPE_SCHEMA, AlertParams
from cartpulse.session import apply_runtime_conf, job_session, work_path
from cartpulse.sinks.tables import jdbc_upsert_sink
from cartpulse.streaming.alerts import (console_sink, event_alerts, final_alert_stream, log_sink,
                                        read_clean_stream, read_events, run_started,
                                        start_alert_query, start_clean_event_sink, start_final_query,
                                        valid_stream)
from cartpulse.streaming.metrics import BatchMetrics


def run_alert_job(spark: SparkSession, source: str = "kafka", path: str | None = None,
                  topic: str | None = None, bootstrap: str | None = None,
                  params: AlertParams = AlertParams(), dedup: str = "bounded",
                  trigger: dict | None = None, console: bool = False,
                  jdbc: dict | None = None, name: str = "flash_sale_alerts",
                  clean_table: str | None = None, max_offsets_per_trigger: int | None = None,
                  wait: bool = True, final_table: str | None = None, compact_every: int | None = 60,
                  decode_once: bool = False, metrics: str | None = None):
    """Start the alert query (with ``final_table`` in append form: only closed windows,
    each written once to that table; and, with ``clean_table``, a second query that
    appends the cleaned events to that table, partitioned by event_date; with
    ``decode_once`` the alert query then streams from that table, so that only the
    second query decodes). ``metrics`` names a folder for the progress of each batch.
    Returns the alert query; blocks until it ends unless ``wait`` is False."""
    if decode_once and (final_table or not clean_table):
        raise ValueError("decode_once needs the cleaned-event table and the update form")
    if final_table and (console or jdbc):
        raise ValueError("the append form writes its table only")
    apply_runtime_conf(spark)
    messages = read_events(spark, source=source, path=path, topic=topic, bootstrap=bootstrap,
                           max_offsets_per_trigger=max_offsets_per_trigger)
    if source != "kafka":
        messages = messages.select(*ENVELOPE_SCHEMA.fieldNames())
    extra = []
    if console:
        extra.append(console_sink())
    checkpoint = work_path(spark, "alerts", name, "checkpoint")
    run = run_started(spark, checkpoint)
    if jdbc:
        extra.append(jdbc_upsert_sink(jdbc["url"], jdbc["table"], jdbc.get("properties"), run))
    if final_table:
        queries = [start_final_query(final_alert_stream(messages, params, dedup), final_table,
                                     work_path(spark, "alerts", name, "final_checkpoint"), trigger, name)]
    else:
        handler = log_sink(work_path(spark, "alerts", name, "log"), extra, run, compact_every)
        if metrics:
            spark.streams.addListener(BatchMetrics(spark, metrics, name, run))
        events = read_clean_stream(spark, clean_table) if decode_once else valid_stream(messages)
        queries = [start_alert_query(event_alerts(events, params, dedup), handler, checkpoint,
                                     trigger, name)]
    if clean_table:
        queries.append(start_clean_event_sink(
            valid_stream(messages), clean_table,
            work_path(spark, "alerts", name, "clean_checkpoint"), trigger))
    if wait:
        wait_for_any(spark, queries)
    return queries[0]


def wait_for_any(spark: SparkSession, queries: list) -> None:
    """Wait until one of the queries ends, then stop the others; an error of any
    of them ends the job."""
    try:
        while all(q.isActive for q in queries):
            queries[0].awaitTermination(1)
    except KeyboardInterrupt:
        pass
    finally:
        for q in queries:
            q.stop()
    for q in queries:
        if q.exception() is not None:
            raise RuntimeError(f"query {q.name or q.id} failed: {q.exception()}")


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Sliding-window flash-sale alerts")
    ap.add_argument("--source", default="kafka")
    ap.add_argument("--path")
    ap.add_argument("--topic", default="clickstream_events")
    ap.add_argument("--bootstrap")
    ap.add_argument("--window", default=AlertParams.window)
    ap.add_argument("--slide", default=AlertParams.slide)
    ap.add_argument("--watermark", default=AlertParams.watermark)
    ap.add_argument("--min-views", type=int, default=AlertParams.min_views)
    ap.add_argument("--max-purchases", type=int, default=AlertParams.max_purchases)
    ap.add_argument("--dedup", default="bounded", choices=["bounded", "exact"])
    ap.add_argument("--trigger", default="1 minute")
    ap.add_argument("--console", action="store_true")
    ap.add_argument("--clean-table", help="also append cleaned events to this table (H1)")
    ap.add_argument("--final-table", help="append form: write only closed windows, to this table")
    ap.add_argument("--compact-every", type=int, default=60,
                    help="fold so many batches of the alert log at a time")
    ap.add_argument("--decode-once", action="store_true",
                    help="stream the alerts from the cleaned-event table")
    ap.add_argument("--metrics", help="folder for the progress of every batch")
    ap.add_argument("--max-offsets-per-trigger", type=int,
                    help="Kafka: upper bound of messages per micro-batch")
    ap.add_argument("--jdbc-url", help="also write the alerts to a table over JDBC (H2)")
    ap.add_argument("--jdbc-table", default="flash_sale_alerts")
    ap.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE",
                    help="connection property (user, password, driver, ...)")
    a = ap.parse_args(argv)
    jdbc = None
    if a.jdbc_url:
        jdbc = {"url": a.jdbc_url, "table": a.jdbc_table,
                "properties": dict(p.split("=", 1) for p in a.jdbc_property)}
    spark = job_session("cartpulse-alerts")
    params = AlertParams(a.window, a.slide, a.watermark, a.min_views, a.max_purchases)
    run_alert_job(spark, a.source, a.path, a.topic, a.bootstrap, params, a.dedup,
                  {"processingTime": a.trigger}, a.console, jdbc, clean_table=a.clean_table,
                  max_offsets_per_trigger=a.max_offsets_per_trigger, final_table=a.final_table,
                  compact_every=a.compact_every, decode_once=a.decode_once, metrics=a.metrics)


if __name__ == "__main__":
    main()
