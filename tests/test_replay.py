"""The replay's files: periods read whole by one trigger, ranges in time order."""

import os

from pyspark.sql import functions as F

from cartpulse.schema import ENVELOPE_SCHEMA
from cartpulse.sources import feed
from cartpulse.sources.tables import clicks
from cartpulse.streaming.replay import in_time_order, write_periods, write_replay

SMALL = "/root/testdata/sf0.001"


def test_a_trigger_reads_a_period_that_many_tasks_wrote(spark, workdir):
    """Days of very different sizes over several files each, one micro-batch a day."""
    messages = feed.faulty_feed(clicks(spark, SMALL))
    messages = messages.where((F.dayofmonth("timestamp") != 7) | (F.col("offset") % 20 == 0))
    files = write_periods(spark, messages, f"{workdir}/days", rows_per_file=20)
    assert files > 1
    folders = [d for d in os.listdir(f"{workdir}/days") if d.startswith("replay_period=")]
    for folder in folders:
        names = [n for _, _, ns in os.walk(f"{workdir}/days/{folder}") for n in ns if n.endswith(".parquet")]
        assert len(names) == files
    got = []
    query = (spark.readStream.schema(ENVELOPE_SCHEMA).option("maxFilesPerTrigger", files)
             .option("maxCachedFiles", 0).parquet(f"{workdir}/days").writeStream
             .foreachBatch(lambda rows, i: got.append(
                 [tuple(r) for r in rows.groupBy(F.to_date("timestamp")).count().collect()]))
             .option("checkpointLocation", f"{workdir}/ck").trigger(availableNow=True).start())
    query.awaitTermination()
    want = [[tuple(r)] for r in messages.groupBy(F.to_date("timestamp").alias("d")).count().orderBy("d").collect()]
    assert [b for b in got if b] == want


def test_messages_in_order_are_dealt_before_they_are_made(spark, workdir):
    """Files that follow each other in time, the same rows, no payload in a shuffle."""
    events = clicks(spark, SMALL)
    messages = feed.faulty_feed(in_time_order(events, events.count(), rows_per_range=50))
    plan = messages._jdf.queryExecution().executedPlan().toString()
    made, dealt = plan.split("Exchange rangepartitioning")
    assert "value_json" in made and "value_json" not in dealt
    write_replay(spark, messages, f"{workdir}/r", in_order=True)
    written = spark.read.schema(ENVELOPE_SCHEMA).parquet(f"{workdir}/r").drop("replay_period")
    columns = ENVELOPE_SCHEMA.fieldNames()
    assert written.select(columns).exceptAll(feed.faulty_feed(events).select(columns)).isEmpty()
    assert written.count() == 2 * events.count()
    spans = (written.groupBy(F.to_date("timestamp").alias("day"), F.input_file_name().alias("file"),
                             F.col("_metadata.file_modification_time").alias("at"))
             .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).orderBy("at").collect())
    assert len(spans) >= 20
    # a retry arrives a second after its event, so files overlap by that much
    assert all((a["last"] - b["first"]).total_seconds() <= 1 for a, b in zip(spans, spans[1:]))
