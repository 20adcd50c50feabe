"""Event emission (A7): events -> keyed JSON messages -> bus or files.

The source producer sends one blocking record at a time. Here emission is a
streaming query: rows become ``(key = user_id, value = JSON)`` messages in
parallel tasks and go to Kafka, or to files for offline replays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def to_messages(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Producer-side serializer: JSON payload of every column, keyed."""
    return events.select(F.col(key).cast("binary").alias("key"),
                         F.to_json(F.struct(*[F.col(c) for c in events.columns]))
                         .cast("binary").alias("value"))


def start_emitter(messages: DataFrame, checkpoint: str, sink: str = "kafka",
                  path: str | None = None, topic: str | None = None,
                  bootstrap: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    """Run the emission query (append mode) into Kafka or a file sink."""
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if sink == "kafka":
        writer = writer.format("kafka").option("kafka.bootstrap.servers", bootstrap) \
            .option("topic", topic)
        return writer.start()
    return writer.format(sink).start(path)


def run_producer(spark, events: DataFrame, duration_s: float | None = None,
                 sink: str = "kafka", path: str | None = None, topic: str | None = None,
                 bootstrap: str | None = None, checkpoint: str | None = None,
                 trigger: dict | None = None) -> StreamingQuery:
    """Emit a stream of events, keyed by user id, for ``duration_s`` seconds (or
    until it ends), then stop. Returns the stopped query."""
    from cartpulse.session import work_path
    query = start_emitter(to_messages(events), checkpoint or work_path(spark, "producer", "ck"),
                          sink=sink, path=path, topic=topic, bootstrap=bootstrap,
                          trigger=trigger or {"processingTime": "1 second"})
    try:
        query.awaitTermination(duration_s) if duration_s else query.awaitTermination()
    finally:
        query.stop()
    return query


def main(argv: list[str] | None = None) -> None:
    """``python -m cartpulse.streaming.emit --events <parquet folder> --sink kafka
    --topic T --bootstrap H:P`` (or ``--sink parquet --path P``): emit the rows of an
    event table, new files as they come, or with ``--once`` what is there."""
    import argparse

    from cartpulse.session import job_session
    ap = argparse.ArgumentParser(description="Emit the events of a table as keyed messages")
    ap.add_argument("--events", required=True)
    ap.add_argument("--duration", type=float, help="seconds; default: until stopped")
    ap.add_argument("--once", action="store_true", help="emit what is there and end")
    ap.add_argument("--sink", default="kafka")
    ap.add_argument("--path")
    ap.add_argument("--topic", default="clickstream_events")
    ap.add_argument("--bootstrap")
    ap.add_argument("--checkpoint")
    a = ap.parse_args(argv)
    spark = job_session("cartpulse-producer")
    events = spark.readStream.schema(spark.read.parquet(a.events).schema).parquet(a.events)
    run_producer(spark, events, a.duration, a.sink, a.path, a.topic, a.bootstrap, a.checkpoint,
                 {"availableNow": True} if a.once else None)


if __name__ == "__main__":
    main()
