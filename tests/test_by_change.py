"""Daily tables by change, viewer sketches for any range of days, counts from file
footers, and the report without a kept copy."""

import os

from pyspark.sql import functions as F

from cartpulse.plans import conversion as conv
from cartpulse.plans import products as prod
from cartpulse.plans import sketches as sk
from cartpulse.plans.daily import run_changed_days, run_daily_jobs
from cartpulse.plans.history import result_table_counts, result_table_presence
from cartpulse.schema import CLEAN_EVENT_SCHEMA, PRODUCT_VIEWERS, RESULT_TABLES
from cartpulse.sinks.tables import read_clean_events, read_result_table

DAILY = ["user_segmentation_daily", "top_products_daily", "conversion_rate_daily", PRODUCT_VIEWERS]


def events_of(spark, first, last, day, users=40):
    """Valid events number first .. last - 1 of one day, in the table's columns."""
    values = {"event_id": F.concat(F.lit("e"), "id"), "user_id": F.concat(F.lit("u"), F.col("id") % users),
              "product_id": F.concat(F.lit("p"), F.col("id") % 7),
              "event_type": F.element_at(F.array(*[F.lit(t) for t in ("view", "view", "add_to_cart", "purchase")]),
                                         (F.col("id") % 4 + 1).cast("int")),
              "event_timestamp": F.timestamp_seconds(F.unix_timestamp(F.lit(f"{day} 00:00:00")) + F.col("id")),
              "product_category": F.concat(F.lit("c"), F.col("id") % 3),
              "price": F.col("id") % 50 + 1, "event_date": F.lit(day)}
    return spark.range(first, last).select(*[
        values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CLEAN_EVENT_SCHEMA.fields])


def append(spark, events, workdir):
    """Through a file sink with a commit log, as the stream writes the table."""
    from cartpulse.streaming.alerts import start_clean_event_sink
    events.write.mode("append").parquet(f"{workdir}/arrived")
    rows = spark.readStream.schema(CLEAN_EVENT_SCHEMA).parquet(f"{workdir}/arrived")
    start_clean_event_sink(rows, f"{workdir}/clean", f"{workdir}/sink", {"availableNow": True}).awaitTermination()


def change(spark, workdir):
    return run_changed_days(spark, f"{workdir}/clean", f"{workdir}/tables", f"{workdir}/days",
                            viewer_sketches=True)


def files_by_day(workdir):
    found = {}
    for name in DAILY:
        for folder in os.listdir(f"{workdir}/tables/{name}"):
            if folder.startswith("analysis_date="):
                found[name, folder[14:]] = sorted(f for f in os.listdir(f"{workdir}/tables/{name}/{folder}")
                                                  if f.endswith(".parquet"))
    return found


def comparable(spark, root, name):
    rows = read_result_table(spark, root, name).drop("created_at")
    if "viewers" in rows.columns:
        rows = rows.withColumn("viewers", F.hll_sketch_estimate("viewers"))
    return sorted(map(str, rows.collect()))


def test_late_rows_rewrite_their_days_only(spark, workdir):
    workdir = workdir.removeprefix("file:")
    assert change(spark, workdir) == []  # nothing was ever written
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        append(spark, events_of(spark, 0, 300, day).withColumn(
            "event_id", F.concat("event_id", F.lit(day))), workdir)
    assert change(spark, workdir) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    before = files_by_day(workdir)
    assert change(spark, workdir) == []
    assert files_by_day(workdir) == before
    # late rows of one day, and copies of rows that are there
    late = events_of(spark, 250, 420, "2024-01-02").withColumn("event_id", F.concat("event_id", F.lit("2024-01-02")))
    append(spark, late, workdir)
    assert change(spark, workdir) == ["2024-01-02"]
    after = files_by_day(workdir)
    assert {key for key in after if after[key] != before[key]} == {(name, "2024-01-02") for name in DAILY}
    run_daily_jobs(read_clean_events(spark, f"{workdir}/clean"), f"{workdir}/whole", viewer_sketches=True)
    for name in DAILY:
        assert comparable(spark, f"{workdir}/tables", name) == comparable(spark, f"{workdir}/whole", name)


def test_a_run_that_dies_repeats_its_days(spark, workdir, monkeypatch):
    import pytest

    from cartpulse.plans import daily
    append(spark, events_of(spark, 0, 100, "2024-01-01"), workdir)
    real = daily.write_daily

    def dies(df, path, *rest):
        if path.endswith("top_products_daily"):
            raise OSError("disk")
        real(df, path, *rest)
    monkeypatch.setattr(daily, "write_daily", dies)
    with pytest.raises(Exception):
        change(spark, workdir)
    monkeypatch.setattr(daily, "write_daily", real)
    assert change(spark, workdir) == ["2024-01-01"]
    run_daily_jobs(read_clean_events(spark, f"{workdir}/clean"), f"{workdir}/whole", viewer_sketches=True)
    for name in DAILY:
        assert comparable(spark, f"{workdir}/tables", name) == comparable(spark, f"{workdir}/whole", name)


def test_copies_are_dropped_once_for_all_jobs(spark, workdir, monkeypatch):
    from cartpulse.plans import daily
    append(spark, events_of(spark, 0, 200, "2024-01-01"), workdir)
    append(spark, events_of(spark, 100, 300, "2024-01-01"), workdir)
    kept, real = [], daily.run_daily_jobs

    def jobs(events, *args, **options):
        kept.append(events)
        assert events.storageLevel.useDisk and set(events.columns) == set(daily.JOB_COLUMNS)
        real(events, *args, **options)
    monkeypatch.setattr(daily, "run_daily_jobs", jobs)
    assert change(spark, workdir) == ["2024-01-01"]
    assert len(kept) == 1 and not kept[0].storageLevel.useDisk  # freed
    real(read_clean_events(spark, f"{workdir}/clean"), f"{workdir}/whole", viewer_sketches=True)
    for name in DAILY:
        assert comparable(spark, f"{workdir}/tables", name) == comparable(spark, f"{workdir}/whole", name)


def test_viewers_of_a_range_are_within_the_stated_error(spark, workdir):
    """30 days, 50,000 users of one product who return every few days; one product with
    three users, one without any user id."""
    many = spark.range(0, 300_000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(50_000))).alias("user_id"),
        F.lit("hot").alias("product_id"), (F.col("id") % 30).alias("d"))
    few = spark.range(0, 90).select(F.concat(F.lit("u"), F.col("id") % 3), F.lit("few"), F.col("id") % 30)
    none = spark.range(0, 30).select(F.lit(None).cast("string"), F.lit("none"), F.col("id"))
    events = (many.union(few).union(none)
              .withColumn("event_date", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int")))
              .select("user_id", "product_id", "event_date", F.lit("view").alias("event_type"),
                      F.col("event_date").cast("timestamp").alias("event_timestamp"),
                      F.lit("e").alias("event_id"), F.lit("c").alias("product_category"), F.lit(2.5).alias("price")))
    run_daily_jobs(events, workdir, viewer_sketches=True)
    rows = read_result_table(spark, workdir, PRODUCT_VIEWERS)
    for first, last in ((None, None), ("2024-01-05", "2024-01-11"), ("2024-01-09", None)):
        stats = sk.range_view_stats(rows, first, last)
        plan = stats._jdf.queryExecution().executedPlan().toString()
        assert all(PRODUCT_VIEWERS in f for f in stats.inputFiles())  # no event is read
        assert ("PartitionFilters: [isnotnull(analysis_date" in plan) == bool(first)
        chosen = events.where(F.col("event_date").between(first, last or first)) if first else events
        exact = {r.product_id: r for r in prod.product_view_stats(chosen, by_day=False).collect()}
        got = {r.product_id: r for r in stats.collect()}
        assert got.keys() == exact.keys() == {"hot", "few", "none"}
        for key, row in got.items():
            assert abs(row.unique_viewers - exact[key].unique_viewers) <= \
                3 * sk.RELATIVE_ERROR * exact[key].unique_viewers
            assert row[:3] == exact[key][:3] and row.avg_price == exact[key].avg_price
    top = prod.top_products(sk.range_view_stats(rows), by_day=False).collect()
    assert [(r["rank"], r.product_id) for r in top] == [(1, "hot"), (2, "few"), (3, "none")]


def test_category_of_a_range_is_the_first_in_event_order(spark):
    frame = spark.createDataFrame(
        [("a", "u1", "2024-01-01 10:00:00", None, None), ("b", "u1", "2024-01-02 11:00:00", "late", 1.0),
         ("c", "u2", "2024-01-02 10:00:00", "early", 2.01), ("d", "u2", "2024-01-03 10:00:00", "next", 2.0)],
        "event_id string, user_id string, t string, product_category string, price double").select(
            "*", F.to_timestamp("t").alias("event_timestamp"), F.to_date("t").alias("event_date"),
            F.lit("view").alias("event_type"), F.lit("p").alias("product_id"))
    got = sk.range_view_stats(sk.product_viewers(frame)).collect()
    want = prod.product_view_stats(frame, by_day=False).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want] and got[0].category == "early"
    assert sk.range_view_stats(sk.product_viewers(frame.limit(0))).collect() == []


def test_table_counts_come_from_file_footers(spark, workdir):
    events = events_of(spark, 0, 200, "2024-01-01").union(events_of(spark, 0, 200, "2024-01-02"))
    run_daily_jobs(events, workdir)
    counts = result_table_counts(spark, workdir)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 3
    got = dict(map(tuple, counts.collect()))
    assert got == {name: read_result_table(spark, workdir, name).count() for name in RESULT_TABLES}
    assert got["flash_sale_alerts"] == 0 and got["top_products_daily"] == 10
    presence = {r.table_name: (r.present, r.row_count) for r in result_table_presence(spark, workdir).collect()}
    assert presence["flash_sale_alerts"] == (False, None) and presence["top_products_daily"] == (True, 10)
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was


def test_report_scans_once_and_keeps_nothing(spark, workdir):
    events_of(spark, 0, 500, "2024-01-01").write.parquet(f"{workdir}/events")
    counts = conv.funnel_counts(spark.read.parquet(f"{workdir}/events"), by_day=False)
    report = conv.conversion_report(counts)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "InMemoryTableScan" not in plan
    rows = report.collect()
    assert [sum(r.section == s for r in rows) for s in ("overall", "category", "top", "bottom")] == [1, 3, 5, 5]
    assert not spark._jsparkSession.sharedState().cacheManager().numCachedEntries()
    empty = conv.conversion_report(counts.limit(0)).collect()
    assert [tuple(r) for r in empty] == [("overall", 1, None, None, None, None, None, None)]
