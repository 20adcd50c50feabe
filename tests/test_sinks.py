"""Result tables and the cleaned-event table: idempotent writes, pruning."""

from pyspark.sql import functions as F

from conftest import MEDIUM
from cartpulse.operators import cleanse as cl
from cartpulse.operators import windows as win
from cartpulse.plans import segmentation as seg
from cartpulse.plans.daily import run_daily_jobs
from cartpulse.schema import AlertParams
from cartpulse.sinks.tables import read_result_table, write_clean_events
from cartpulse.sources.tables import click_events, day_events, product_categories


def _counts(spark, root):
    return {t: read_result_table(spark, root, t).count()
            for t in ("user_segmentation_daily", "top_products_daily", "conversion_rate_daily")}


def test_daily_rerun_replaces_its_days(spark, workdir):
    events = click_events(spark, MEDIUM)
    dims = product_categories(spark, MEDIUM)
    run_daily_jobs(events, workdir, dims)
    first = _counts(spark, workdir)
    days = events.filter("event_date BETWEEN DATE'2024-01-10' AND DATE'2024-01-12'")
    run_daily_jobs(days, workdir, dims, first="2024-01-10", last="2024-01-12")
    assert _counts(spark, workdir) == first  # re-run of 3 days: no duplicates, no loss
    top = read_result_table(spark, workdir, "top_products_daily")
    assert top.groupBy("analysis_date").count().agg(F.max("count")).first()[0] == 5


def test_clean_event_table_prunes_partitions(spark, workdir):
    clean = cl.cleanse(click_events(spark, MEDIUM))
    write_clean_events(clean, f"{workdir}/clean")
    table = spark.read.parquet(f"{workdir}/clean")
    day = day_events(table, "2024-01-30")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert day.count() == click_events(spark, MEDIUM, day="2024-01-30").count()


def test_invariants(spark):
    events = cl.cleanse(click_events(spark, MEDIUM))
    params = AlertParams(window="1 day", slide="1 hour", min_views=0)
    counts = win.window_counts(events, params)
    total = counts.agg(F.sum(F.col("total_views") + F.col("total_purchases"))).first()[0]
    vp = events.filter("event_type in ('view', 'purchase')").count()
    assert total == 24 * vp  # each event in exactly length / slide windows
    segs = seg.user_segments(events)
    dist = seg.segment_distribution(segs).agg(F.sum("user_count")).first()[0]
    assert dist == segs.count()
    assert segs.filter("view_count + cart_count + purchase_count > total_events").count() == 0


def test_daily_and_history_command_lines(spark, workdir, capsys):
    from cartpulse.plans import daily, history
    write_clean_events(cl.cleanse(click_events(spark, MEDIUM)), f"{workdir}/clean")
    product_categories(spark, MEDIUM).write.parquet(f"{workdir}/dim")
    daily.main(["--events", f"{workdir}/clean", "--tables", f"{workdir}/tables",
                "--first", "2024-01-29", "--last", "2024-01-30", "--categories", f"{workdir}/dim"])
    top = read_result_table(spark, f"{workdir}/tables", "top_products_daily")
    assert sorted(str(r[0]) for r in top.select("analysis_date").distinct().collect()) == [
        "2024-01-29", "2024-01-30"]
    history.main(["--tables", f"{workdir}/tables", "presence"])
    out = capsys.readouterr().out
    assert "user_segmentation_daily\tTrue" in out and "flash_sale_alerts\tFalse" in out
    history.main(["--tables", f"{workdir}/tables", "sql", "--sql",
                  "SELECT COUNT(*) AS row_count FROM top_products_daily"])
    assert capsys.readouterr().out.split() == ["row_count", "10"]


def test_history_sql_runs_unchanged_on_registered_views(spark, workdir):
    from cartpulse.plans.history import segment_history
    from cartpulse.sinks.tables import register_result_views
    run_daily_jobs(click_events(spark, MEDIUM), workdir, product_categories(spark, MEDIUM))
    assert register_result_views(spark, workdir) == [
        "user_segmentation_daily", "top_products_daily", "conversion_rate_daily"]
    assert spark.catalog.tableExists("top_products_daily")
    sql = spark.sql(
        "SELECT analysis_date, segment, COUNT(*) as user_count FROM user_segmentation_daily "
        "GROUP BY analysis_date, segment ORDER BY analysis_date DESC, segment LIMIT 10")
    ours = segment_history(read_result_table(spark, workdir, "user_segmentation_daily"))
    assert sql.collect() == ours.collect()


def test_jdbc_sink_writes_conformed_alert_rows(spark, monkeypatch):
    """No database is started: the JDBC calls are intercepted."""
    from datetime import datetime

    from pyspark.sql.readwriter import DataFrameWriter

    from cartpulse.sinks import tables
    from cartpulse.sinks.tables import jdbc_sink
    calls = []
    monkeypatch.setattr(tables, "execute_jdbc", lambda *a: None)

    def fake_jdbc(self, url, table, mode=None, properties=None):
        calls.append((self._df, url, table, mode, properties))
    monkeypatch.setattr(DataFrameWriter, "jdbc", fake_jdbc)
    rows = spark.createDataFrame(
        [("p1", datetime(2024, 1, 1), datetime(2024, 1, 2), 5, 1, 20.0, datetime(2024, 1, 3),
          True, 7)],
        "product_id string, window_start timestamp, window_end timestamp, total_views int, "
        "total_purchases int, conversion_rate double, alert_timestamp timestamp, "
        "alert_triggered boolean, batch_id long")
    jdbc_sink("jdbc:example://host/db", "flash_sale_alerts", {"user": "u"})(rows, 7)
    (df, url, table, mode, props), = calls
    assert (url, table, mode, props) == ("jdbc:example://host/db", "flash_sale_alerts",
                                         "append", {"user": "u"})
    assert df.columns == ["product_id", "window_start", "window_end", "total_views",
                          "total_purchases", "conversion_rate", "alert_timestamp",
                          "alert_triggered", "run_started", "batch_id"]
    assert dict(df.dtypes)["total_views"] == "bigint" and df.first().batch_id == 7


def test_rerun_of_an_emptied_day_leaves_no_rows(spark, workdir):
    events = click_events(spark, MEDIUM)
    dims = product_categories(spark, MEDIUM)
    run_daily_jobs(events, workdir, dims)
    rest = events.filter("event_date = DATE'2024-01-10'")  # the 11th has no events any more
    run_daily_jobs(rest, workdir, dims, first="2024-01-10", last="2024-01-11")
    for name in ("user_segmentation_daily", "top_products_daily", "conversion_rate_daily"):
        days = {str(r[0]) for r in read_result_table(spark, workdir, name)
                .select("analysis_date").distinct().collect()}
        assert "2024-01-11" not in days and {"2024-01-09", "2024-01-10", "2024-01-12"} <= days


def test_a_day_is_written_by_one_task(spark, workdir):
    import glob
    write_clean_events(cl.cleanse(click_events(spark, MEDIUM)).repartition(8), f"{workdir}/clean")
    root = f"{workdir}/clean".removeprefix("file:")
    per_day = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{root}/event_date=*")]
    assert len(per_day) == 30 and max(per_day) == 1


def test_history_prints_every_row(spark, workdir, capsys):
    from cartpulse.plans import history
    run_daily_jobs(click_events(spark, MEDIUM), workdir, product_categories(spark, MEDIUM))
    history.main(["--tables", workdir, "conversion_history"])
    n = read_result_table(spark, workdir, "conversion_rate_daily").count()
    assert n > 100 and len(capsys.readouterr().out.strip().splitlines()) == n + 1
    history.main(["--tables", workdir, "--out", f"{workdir}/csv", "conversion_history"])
    assert spark.read.option("header", True).csv(f"{workdir}/csv").count() == n


def test_jdbc_batch_deletes_its_rows_first(spark, monkeypatch):
    from cartpulse.sinks import tables as S
    done = []
    monkeypatch.setattr(S, "execute_jdbc", lambda spark, url, sql, props=None: done.append(sql))
    monkeypatch.setattr(S, "write_jdbc", lambda df, url, table, props=None, mode="append":
                        done.append((table, mode, df.columns[-2:])))
    rows = spark.createDataFrame([], S.ALERT_SCHEMA)
    S.jdbc_sink("jdbc:x:y", "alerts", {"user": "u"}, run=77)(rows, 5)
    assert done == ["DELETE FROM alerts WHERE run_started = 77 AND batch_id = 5",
                    ("alerts", "append", ["run_started", "batch_id"])]


def test_cluster_without_a_shared_folder_is_refused():
    import pytest
    from types import SimpleNamespace

    from cartpulse.session import checkpoint_root
    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(conf=conf, sparkContext=context))


def test_jdbc_upsert_is_one_transaction(spark, monkeypatch):
    """No database is started: what would be sent is intercepted."""
    from cartpulse.sinks import tables as S
    done = []
    monkeypatch.setattr(S, "transact_jdbc", lambda spark, url, sql, props=None: done.append(sql))
    monkeypatch.setattr(S, "write_jdbc", lambda df, url, table, props=None, mode="append":
                        done.append((table, mode, df.columns[-2:])))
    rows = spark.createDataFrame([], S.ALERT_SCHEMA)
    sink = S.jdbc_upsert_sink("jdbc:x:y", "alerts", {"user": "u"}, run=77)
    sink(rows, 5)
    ddl, emptied, staged, upsert = done
    assert [d.split(" (")[0] for d in ddl] == [f"CREATE TABLE IF NOT EXISTS {t}" for t in (
        "alerts", "alerts_staging", "alerts_batches")]
    assert "PRIMARY KEY (product_id, window_start)" in ddl[0] and "total_views BIGINT NOT NULL" in ddl[1]
    assert emptied == ["DELETE FROM alerts_staging WHERE run_started = 77 AND batch_id = 5"]
    assert staged == ("alerts_staging", "append", ["run_started", "batch_id"])
    assert [u.split(" WHERE")[0].split(" (")[0] for u in upsert] == [
        "DELETE FROM alerts", "INSERT INTO alerts", "DELETE FROM alerts_batches",
        "INSERT INTO alerts_batches", "DELETE FROM alerts_staging"]
    sink(rows, 6)
    assert len(done) == 7  # the tables are made once
