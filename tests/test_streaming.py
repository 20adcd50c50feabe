"""Streaming alert query: lateness and de-dup modes, retraction, restart."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse.schema import ENVELOPE_SCHEMA, AlertParams
from cartpulse.streaming import alerts as A
from cartpulse.streaming.replay import write_replay

ENV = T.StructType([T.StructField("value", T.StringType()),
                    T.StructField("partition", T.IntegerType()),
                    T.StructField("offset", T.LongType()),
                    T.StructField("timestamp", T.TimestampType())])


def msg(i, ts, product="p1", etype="view", day=0):
    payload = {"event_id": f"e{i}", "user_id": "u", "product_id": product, "event_type": etype,
               "timestamp": ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ"), "price": 10.0}
    # the arrival day puts each message in its own replay batch, in order
    return (json.dumps(payload), 0, i, datetime(2030, 1, 1) + timedelta(days=day))


def run(spark, workdir, batches, params, dedup="bounded", name="q"):
    rows = [m for b in batches for m in b]
    env = spark.createDataFrame(rows, ENV).coalesce(1)
    env = env.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"),
                     "partition", "offset", "timestamp")
    write_replay(spark, env, f"{workdir}/{name}/replay")
    stream = A.read_events(spark, source="parquet", path=f"{workdir}/{name}/replay",
                           max_files_per_trigger=1).select(*ENVELOPE_SCHEMA.fieldNames())
    q = A.start_alert_query(A.alert_stream(stream, params, dedup),
                            A.log_sink(f"{workdir}/{name}/log"), f"{workdir}/{name}/ck",
                            trigger={"availableNow": True})
    q.awaitTermination()
    run.progress = q.recentProgress
    return A.read_alert_log(spark, f"{workdir}/{name}/log")


T12 = datetime(2024, 3, 1, 12, 0, 0)


def late_row_windows(spark, workdir, dedup):
    params = AlertParams(min_views=0, max_purchases=5)
    batches = [[msg(1, T12, day=0)],
               [msg(2, T12 + timedelta(seconds=30), product="p2", day=1)],
               [msg(3, T12 - timedelta(minutes=10), day=2)]]
    cur = A.current_alerts(run(spark, workdir, batches, params, dedup, name=dedup))
    late = cur.filter((F.col("product_id") == "p1")
                      & (F.col("window_start") <= datetime(2024, 3, 1, 11, 50)))
    return late.count()


def test_exact_dedup_counts_late_row_in_open_windows_only(spark, workdir):
    assert late_row_windows(spark, workdir, "exact") == 5


def test_bounded_dedup_never_drops_a_row_exact_keeps(spark, workdir):
    assert late_row_windows(spark, workdir, "bounded") == 10


def test_alert_retracted_when_it_stops_qualifying(spark, workdir):
    params = AlertParams(min_views=1, max_purchases=1)
    batches = [[msg(1, T12, day=0), msg(2, T12 + timedelta(seconds=1), day=0)],
               [msg(3, T12 + timedelta(seconds=10), etype="purchase", day=1)]]
    log = run(spark, workdir, batches, params, name="retract")
    first = log.filter("batch_id = 0 AND alert_triggered").count()
    assert first == 10  # every window holding both views alerted
    assert A.current_alerts(log).count() == 0  # ... and all were retracted
    assert A.appended_alerts(log).count() == 10  # the append-only history keeps them
    observed = [p.observedMetrics.get("alert_batch") for p in run.progress]
    alerts = [m["alerts"] for m in observed if m is not None]
    assert alerts[:2] == [10, 0]  # C14 per batch, from the progress reports


def test_duplicates_across_batches_counted_once(spark, workdir):
    params = AlertParams(min_views=0, max_purchases=5)
    batches = [[msg(1, T12, day=0)], [msg(1, T12, day=1)]]
    cur = A.current_alerts(run(spark, workdir, batches, params, name="dups"))
    assert cur.agg(F.max("total_views")).first()[0] == 1


def test_restart_from_checkpoint_equals_one_run(spark, workdir):
    from cartpulse.sources.feed import faulty_feed
    from cartpulse.sources.tables import clicks
    params = AlertParams(window="2 hours", slide="30 minutes", min_views=0, max_purchases=2)
    messages = faulty_feed(clicks(spark, "/root/testdata/sf0.001"))
    day = F.to_date("timestamp")
    first = messages.filter(day < F.lit("2024-01-16"))
    second = messages.filter(day >= F.lit("2024-01-16"))

    def go(path, ck):
        s = A.read_events(spark, source="parquet", path=path, max_files_per_trigger=4)
        q = A.start_alert_query(A.alert_stream(s.select(*ENVELOPE_SCHEMA.fieldNames()), params),
                                A.log_sink(f"{workdir}/{ck}/log"), f"{workdir}/{ck}/ck",
                                trigger={"availableNow": True})
        q.awaitTermination()
        return A.read_alert_log(spark, f"{workdir}/{ck}/log")

    write_replay(spark, first, f"{workdir}/replay_split")
    go(f"{workdir}/replay_split", "split")
    write_replay(spark, second, f"{workdir}/replay_split", mode="append")
    split = A.current_alerts(go(f"{workdir}/replay_split", "split"))
    write_replay(spark, messages, f"{workdir}/replay_whole")
    whole = A.current_alerts(go(f"{workdir}/replay_whole", "whole"))
    cols = ["product_id", "window_start", "total_views", "total_purchases"]
    assert split.count() > 0
    assert sorted(split.select(cols).collect()) == sorted(whole.select(cols).collect())


def test_alert_job_with_console_fan_out(spark, workdir, capsys):
    from cartpulse.streaming.job import run_alert_job
    params = AlertParams(min_views=1, max_purchases=5)
    rows = [msg(i, T12 + timedelta(seconds=i)) for i in range(3)]
    env = spark.createDataFrame(rows, ENV).coalesce(1).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"),
        "partition", "offset", "timestamp")
    write_replay(spark, env, f"{workdir}/job_replay")
    q = run_alert_job(spark, source="parquet", path=f"{workdir}/job_replay", params=params,
                      trigger={"processingTime": "1 second"}, console=True,
                      name=f"job_{workdir.rsplit('/', 1)[-1]}",
                      clean_table=f"{workdir}/job_clean", wait=False)
    try:
        for active in spark.streams.active:
            active.processAllAvailable()
    finally:
        A.stop_all(spark)
    assert spark.read.parquet(f"{workdir}/job_clean").count() == 3
    # the state store that ran, from the query's own report
    state = q.lastProgress["stateOperators"]
    assert state and any("rocksdb" in k.lower() for s in state for k in s["customMetrics"])
    assert q.exception() is None
    assert q.lastProgress is not None and q.lastProgress["numInputRows"] >= 0


def test_kafka_source_without_connector_says_what_is_missing(spark):
    import pytest
    try:
        A.read_events(spark, source="kafka", topic="t", bootstrap="localhost:1")
    except RuntimeError as e:
        assert "spark-sql-kafka-0-10" in str(e)
    else:  # the connector is installed: nothing to check offline
        pytest.skip("Kafka connector present")


def test_json_lines_source(spark, workdir):
    import os
    os.makedirs(f"{workdir}/lines", exist_ok=True)
    with open(f"{workdir}/lines/part-0.json", "w") as fh:
        for i in range(5):
            fh.write(msg(i, T12 + timedelta(seconds=i))[0] + "\n")
        fh.write("{broken\n")
        fh.write(msg(0, T12)[0] + "\n")  # a duplicate of e0
    stream = A.read_events(spark, source="text", path=f"{workdir}/lines")
    q = A.start_alert_query(A.alert_stream(stream, AlertParams(min_views=0)),
                            A.log_sink(f"{workdir}/lines_log"), f"{workdir}/lines_ck",
                            trigger={"availableNow": True})
    q.awaitTermination()
    cur = A.current_alerts(A.read_alert_log(spark, f"{workdir}/lines_log"))
    assert cur.count() == 10 and cur.agg(F.max("total_views")).first()[0] == 5


def test_source_defaults_end_to_end_stream_equals_batch(spark, workdir):
    """Generated producer events at 5/s, the source's alert rule unchanged:
    only the hot product can pass 100 views in 10 minutes."""
    from cartpulse.operators import cleanse as cl
    from cartpulse.operators import windows as win
    from tools.generator import HOT_PRODUCT, PRODUCER, generate
    from cartpulse.streaming.emit import to_messages
    events = generate(spark, 9000, PRODUCER, seed=3, partitions=4)  # 30 minutes
    messages = to_messages(events).select(
        "key", "value", F.lit(0).alias("partition"),
        F.get_json_object(F.col("value").cast("string"), "$.event_id")
        .substr(5, 8).cast("long").alias("offset"),
        F.to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.timestamp"))
        .alias("timestamp"))
    write_replay(spark, messages, f"{workdir}/gen", folder_format="yyyy-MM-dd-HH-mm")
    stream = A.read_events(spark, source="parquet", path=f"{workdir}/gen",
                           max_files_per_trigger=5).select(*ENVELOPE_SCHEMA.fieldNames())
    q = A.start_alert_query(A.alert_stream(stream, AlertParams()), A.log_sink(f"{workdir}/gen_log"),
                            f"{workdir}/gen_ck", trigger={"availableNow": True})
    q.awaitTermination()
    cols = ["product_id", "window_start", "total_views", "total_purchases"]
    streamed = A.current_alerts(A.read_alert_log(spark, f"{workdir}/gen_log")).select(cols)
    batch = win.flash_sale_alerts(cl.cleanse(cl.decode(messages)), AlertParams()).select(cols)
    got = sorted(streamed.collect())
    assert got and {r.product_id for r in got} == {HOT_PRODUCT}
    assert got == sorted(batch.collect())


def test_row_later_than_every_open_window_is_dropped(spark, workdir):
    """A row 40 minutes behind the watermark: no window of its time is open in
    either mode (bounded keeps windows open 15 minutes behind the newest event)."""
    params = AlertParams(min_views=0, max_purchases=5)
    for mode in ("exact", "bounded"):
        batches = [[msg(1, T12, day=0)],
                   [msg(2, T12 + timedelta(seconds=30), product="p2", day=1)],
                   [msg(3, T12 - timedelta(minutes=40), product="p3", day=2)]]
        cur = A.current_alerts(run(spark, workdir, batches, params, mode, name=f"past_{mode}"))
        assert cur.filter(F.col("product_id") == "p3").count() == 0
        assert cur.filter(F.col("product_id") == "p1").count() == 10


def test_kafka_source_options_are_wired(spark, monkeypatch):
    """No broker and no connector: the stream reader calls are intercepted."""
    from pyspark.sql.streaming.readwriter import DataStreamReader
    seen = {}

    def fmt(self, source):
        seen["format"] = source
        return self

    def opt(self, key, value):
        seen[key] = value
        return self

    def opts(self, **kw):
        seen.update(kw)
        return self
    monkeypatch.setattr(DataStreamReader, "format", fmt)
    monkeypatch.setattr(DataStreamReader, "option", opt)
    monkeypatch.setattr(DataStreamReader, "options", opts)
    monkeypatch.setattr(DataStreamReader, "load", lambda self, *a, **k: "stream")
    assert A.read_events(spark, source="kafka", topic="t", bootstrap="h:1",
                         max_offsets_per_trigger=1000) == "stream"
    assert seen == {"format": "kafka", "kafka.bootstrap.servers": "h:1", "subscribe": "t",
                    "startingOffsets": "earliest", "failOnDataLoss": "false",
                    "maxOffsetsPerTrigger": "1000"}


def spread(spark, days="1, 2, 3, 4"):
    """Days 1-4 of the feed in arbitrary order over many tasks."""
    from cartpulse.sources.feed import faulty_feed
    from cartpulse.sources.tables import clicks
    feed = faulty_feed(clicks(spark, "/root/testdata/sf0.01"))
    return feed.filter(f"day(event_timestamp) IN ({days})").repartition(16, F.xxhash64("offset"))


def replayed(spark, workdir, messages, params, dedup):
    n_days = 4
    if not hasattr(replayed, "path") or not replayed.path.startswith(workdir):
        replayed.path = f"{workdir}/many"
        files = write_replay(spark, messages, replayed.path, n_files=40 * n_days)
        assert files >= 40 * n_days
    paths = A.replay_alerts(spark, None, f"{workdir}/{dedup}-{params.min_views}-{params.window[:2].strip()}",
                            params, dedup, max_files_per_trigger=8, state_partitions=4,
                            replay_path=replayed.path)
    return A.current_alerts(A.read_alert_log(spark, paths["alert_log"]))


def test_answers_do_not_depend_on_files_per_trigger(spark, workdir):
    """40 files per day, 8 per trigger: both modes equal the batch, with the
    fixture's windows and with the source's (views over 0)."""
    from cartpulse.operators import cleanse as cl
    from cartpulse.operators import windows as win
    messages = spread(spark)
    cols = ["product_id", "window_start", "total_views", "total_purchases"]
    clean = cl.cleanse(cl.decode(messages)).persist()
    for params in (AlertParams("1 day", "1 hour", "1 day", 1, 5), AlertParams(min_views=0)):
        want = sorted(win.flash_sale_alerts(clean, params).select(cols).collect())
        assert len(want) > 1000
        for dedup in ("exact", "bounded"):
            got = replayed(spark, workdir, messages, params, dedup)
            assert sorted(got.select(cols).collect()) == want, (params, dedup)


def test_clean_table_keeps_late_rows(spark, workdir):
    """Rows in arbitrary order with the source's five minute watermark: the cleaned
    table, read one row per id, equals the batch."""
    from cartpulse.operators import cleanse as cl
    from cartpulse.sinks.tables import read_clean_events
    messages = spread(spark).persist()
    messages.write.parquet(f"{workdir}/unordered")
    stream = A.read_events(spark, source="parquet", path=f"{workdir}/unordered",
                           max_files_per_trigger=2).select(*ENVELOPE_SCHEMA.fieldNames())
    A.start_clean_event_sink(A.valid_stream(stream), f"{workdir}/late", f"{workdir}/late_ck",
                             trigger={"availableNow": True}).awaitTermination()
    cols = ["event_id", "event_timestamp", "product_id", "price", "offset"]
    got = read_clean_events(spark, f"{workdir}/late").select(cols).collect()
    want = cl.cleanse(cl.decode(messages)).select(cols).collect()
    assert sorted(got) == sorted(want) and len(got) > 1000


def test_a_failing_query_ends_the_job(spark, workdir):
    import pytest

    from cartpulse.streaming.job import wait_for_any
    rows = [msg(i, T12 + timedelta(seconds=i)) for i in range(3)]
    env = spark.createDataFrame(rows, ENV).coalesce(1).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"),
        "partition", "offset", "timestamp")
    write_replay(spark, env, f"{workdir}/fail_replay")

    def stream():
        return A.read_events(spark, source="parquet", path=f"{workdir}/fail_replay").select(
            *ENVELOPE_SCHEMA.fieldNames())

    def broken(rows, batch_id):
        raise ValueError("sink is gone")

    good = A.start_alert_query(A.alert_stream(stream(), AlertParams(min_views=0)),
                               A.log_sink(f"{workdir}/ok_log"), f"{workdir}/ok_ck")
    bad = A.start_alert_query(A.alert_stream(stream(), AlertParams(min_views=0)), broken,
                              f"{workdir}/bad_ck")
    with pytest.raises(RuntimeError, match="sink is gone"):
        wait_for_any(spark, [good, bad])
    assert not good.isActive and not bad.isActive


def test_a_new_checkpoint_outranks_the_old_run(spark, workdir):
    from cartpulse.schema import ALERT_SCHEMA
    first = A.run_started(spark, f"{workdir}/ck1")
    assert A.run_started(spark, f"{workdir}/ck1") == first
    second = A.run_started(spark, f"{workdir}/ck2")
    assert second > first

    def batch(triggered):
        row = ("p", T12, T12 + timedelta(minutes=10), 9, 0, 0.0, T12, triggered)
        names = ["product_id", "window_start", "window_end", "total_views", "total_purchases",
                 "conversion_rate", "alert_timestamp", "alert_triggered"]
        schema = T.StructType([ALERT_SCHEMA[n] for n in names])
        return spark.createDataFrame([row], schema)

    A.log_sink(f"{workdir}/runs", run=first)(batch(True), 9)
    A.log_sink(f"{workdir}/runs", run=second)(batch(False), 0)
    log = A.read_alert_log(spark, f"{workdir}/runs")
    assert log.count() == 2 and A.current_alerts(log).count() == 0


def test_append_form_emits_closed_windows_once(spark, workdir):
    """Every window once, when the watermark passes its end; open ones not at all."""
    from cartpulse.operators import cleanse as cl
    from cartpulse.operators import windows as win
    params = AlertParams("1 day", "1 hour", "1 day", 1, 5)
    messages = spread(spark).persist()
    paths = A.replay_alerts(spark, messages, f"{workdir}/final", params, max_files_per_trigger=3,
                            state_partitions=4, final=True)
    cols = ["product_id", "window_start", "window_end", "total_views", "total_purchases"]
    clean = cl.cleanse(cl.decode(messages))
    closed = F.col("window_end") <= F.lit(clean.agg(F.max("event_timestamp")).first()[0] - timedelta(days=2))
    batch = win.flash_sale_alerts(clean, params).select(cols)
    got = sorted(A.read_final_alerts(spark, paths["alert_log"]).select(cols).collect())
    assert got == sorted(batch.filter(closed).collect())
    assert 100 < len(got) < batch.count() and len({r[:2] for r in got}) == len(got)


def test_alert_job_in_append_form(spark, workdir):
    from cartpulse.streaming.job import run_alert_job
    import pytest
    rows = [msg(0, T12), msg(1, T12 + timedelta(seconds=9)), msg(2, T12 + timedelta(hours=2), day=1)]
    env = spark.createDataFrame(rows, ENV).coalesce(1).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"),
        "partition", "offset", "timestamp")
    write_replay(spark, env, f"{workdir}/final_replay")
    name = f"final_{workdir.rsplit('/', 1)[-1]}"
    q = run_alert_job(spark, source="parquet", path=f"{workdir}/final_replay", params=AlertParams(min_views=1),
                      trigger={"availableNow": True}, name=name, final_table=f"{workdir}/final_table", wait=False)
    q.awaitTermination()
    got = A.read_final_alerts(spark, f"{workdir}/final_table")
    assert got.count() == 10 and got.agg(F.min("total_views")).first()[0] == 2
    with pytest.raises(ValueError, match="append form"):
        run_alert_job(spark, source="parquet", path="x", console=True, final_table="y")
