"""De-duplication by an index of accepted ids, and alerts streamed from tables."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from cartpulse.operators import cleanse as cl
from cartpulse.operators import windows as win
from cartpulse.schema import ENVELOPE_SCHEMA, AlertParams
from cartpulse.streaming import accepted as acc
from cartpulse.streaming import alerts as A
from cartpulse.streaming.replay import write_replay
from test_streaming import ENV, T12, msg, spread

COLS = ["product_id", "window_start", "total_views", "total_purchases"]


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "event_id string")


def test_index_knows_what_earlier_batches_accepted(spark, workdir):
    index = acc.AcceptedIds(spark, f"{workdir}/ids", words=64)
    for b in range(12):
        rows = ids(spark, [f"e{b}-{i}" for i in range(40)]).withColumn(
            "event_date", F.date_add(F.lit("2024-03-01"), b % 3))
        index.append(rows, 1, b)
        if b in (4, 9):
            index.compact(1, b)

    def known(names, run=1, batch=12):
        return sorted(r.event_id for r in index.known(ids(spark, names), run, batch).collect())

    assert known([f"e{b}-7" for b in range(20)]) == sorted(f"e{b}-7" for b in range(12))
    assert known(["other", "e3-40", None]) == [] == known([])
    assert known(["e11-1", "e10-1"], batch=11) == ["e10-1"]  # not the batch itself
    assert known(["e11-1"], run=2, batch=0) == ["e11-1"]
    assert len(index.deltas()) <= 7 and len(index.manifest().days) == 3
    # a filter never misses an id; most others are held back by it
    filters = spark.read.option("recursiveFileLookup", "true").parquet(f"{workdir}/ids/bloom")
    assert filters.groupBy("day", "word").count().where("count > 2").isEmpty()


def test_a_batch_that_runs_again_changes_nothing(spark, workdir):
    rows = [msg(i, T12 + timedelta(seconds=i)) for i in (1, 2, 2)]
    env = spark.createDataFrame(rows, ENV).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"), "partition", "offset",
        "timestamp")
    sink = acc.accept_sink(f"{workdir}/a", run=3)
    batch = cl.validate(cl.decode(env))
    sink(batch, 0)
    first = sorted(spark.read.parquet(f"{workdir}/a/events").collect())
    sink(batch, 0)  # killed before the commit: once more
    assert sorted(spark.read.parquet(f"{workdir}/a/events").collect()) == first and len(first) == 2
    sink(batch, 1)
    assert spark.read.parquet(f"{workdir}/a/events").count() == 2
    assert acc.AcceptedIds(spark, f"{workdir}/a/ids").read().count() == 2


def test_ids_used_again_after_days(spark, workdir):
    """Events sent again three days later under their old id, with another time: the
    bounded mode has forgotten the id, the index has not, and the state has no ids."""
    messages = spread(spark).persist()
    again = messages.join(messages.filter("offset % 10 = 3").select("offset"), "offset", "left_semi")
    later = F.col("timestamp") + F.expr("INTERVAL 3 DAYS")
    again = again.withColumn("v", F.col("value").cast("string"))
    for d in (4, 3, 2, 1):
        again = again.withColumn("v", F.replace("v", F.lit(f"2024-01-0{d}T"), F.lit(f"2024-01-0{d + 3}T")))
    again = again.select("key", F.col("v").cast("binary").alias("value"), "partition",
                         (F.col("offset") + 10 ** 9).alias("offset"), later.alias("timestamp"))
    both = messages.select(*ENVELOPE_SCHEMA.fieldNames()).unionByName(again).persist()
    params = AlertParams("1 day", "1 hour", "1 hour", 1, 5)
    clean = cl.cleanse(cl.decode(both))
    want = sorted(win.flash_sale_alerts(clean, params).select(COLS).collect())
    assert len(want) > 1000

    write_replay(spark, both, f"{workdir}/replay", n_files=40)
    now = {"availableNow": True}

    def stream():
        s = A.read_events(spark, source="parquet", path=f"{workdir}/replay", max_files_per_trigger=8)
        return A.valid_stream(s.select(*ENVELOPE_SCHEMA.fieldNames()))

    acc.start_accept_query(stream(), f"{workdir}/a", f"{workdir}/ck1", now, compact_every=2).awaitTermination()
    q = A.start_alert_query(A.event_alerts(acc.read_accepted_stream(spark, f"{workdir}/a"), params, "accepted"),
                            A.log_sink(f"{workdir}/log"), f"{workdir}/ck2", now)
    q.awaitTermination()
    got = A.current_alerts(A.read_alert_log(spark, f"{workdir}/log")).select(COLS)
    assert sorted(got.collect()) == want
    # one stateful operator, the windows: no id is kept
    assert {len(p.stateOperators) for p in q.recentProgress if p.numInputRows} == {1}
    paths = A.replay_alerts(spark, None, f"{workdir}/bounded", params, "bounded", 8, 4,
                            replay_path=f"{workdir}/replay")
    bounded = A.current_alerts(A.read_alert_log(spark, paths["alert_log"])).select(COLS)
    assert sorted(bounded.collect()) != want  # what the index is for


def test_alerts_follow_the_commit_log_of_the_cleaned_table(spark, workdir):
    """The table grows between the runs of the alert query: every committed batch is
    read once, and the alerts equal those decoded from the messages."""
    messages = spread(spark).persist()
    params = AlertParams("1 day", "1 hour", "1 day", 1, 5)
    now = {"availableNow": True}
    for part in ("day(timestamp) <= 2", "day(timestamp) > 2"):
        write_replay(spark, messages.filter(part), f"{workdir}/replay", mode="append")
        s = A.read_events(spark, source="parquet", path=f"{workdir}/replay", max_files_per_trigger=3)
        valid = A.valid_stream(s.select(*ENVELOPE_SCHEMA.fieldNames()))
        A.start_clean_event_sink(valid, f"{workdir}/clean", f"{workdir}/ck1", now).awaitTermination()
        events = A.read_clean_stream(spark, f"{workdir}/clean")
        A.start_alert_query(A.event_alerts(events, params), A.log_sink(f"{workdir}/log"), f"{workdir}/ck2",
                            now).awaitTermination()
    got = A.current_alerts(A.read_alert_log(spark, f"{workdir}/log")).select(COLS)
    want = win.flash_sale_alerts(cl.cleanse(cl.decode(messages)), params).select(COLS)
    assert sorted(got.collect()) == sorted(want.collect())


def test_only_the_table_query_decodes(spark, workdir):
    plan = A.read_clean_stream(spark, f"{workdir}/clean")
    plan = A.event_alerts(plan, AlertParams())._jdf.queryExecution().analyzed().toString()
    assert "from_json" not in plan.lower()


def test_job_with_one_decoded_stream_and_metrics(spark, workdir):
    from cartpulse.streaming.job import run_alert_job
    from cartpulse.streaming.metrics import read_metrics, reports_written
    rows = [msg(i, T12 + timedelta(seconds=i)) for i in range(3)]
    env = spark.createDataFrame(rows, ENV).coalesce(1).select(
        F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary"),
        "partition", "offset", "timestamp")
    write_replay(spark, env, f"{workdir}/job_replay")
    name = f"once_{workdir.rsplit('/', 1)[-1]}"
    q = run_alert_job(spark, source="parquet", path=f"{workdir}/job_replay", params=AlertParams(min_views=1),
                      trigger={"processingTime": "1 second"}, name=name, clean_table=f"{workdir}/job_clean",
                      decode_once=True, metrics=f"{workdir}/metrics", wait=False)
    try:
        clean, = (x for x in spark.streams.active if x.id != q.id)
        clean.processAllAvailable()
        q.processAllAvailable()
    finally:
        A.stop_all(spark)
    reports_written(spark)
    rows = read_metrics(spark, f"{workdir}/metrics").where("input_rows > 0").collect()
    assert [(r.input_rows, r.alerts, r.changed_windows, r.rows_dropped_late) for r in rows] == [(3, 10, 10, 0)]
    with pytest.raises(ValueError, match="cleaned-event table"):
        run_alert_job(spark, source="parquet", path="x", decode_once=True)
