"""Physical plan shape of the registered queries (the scale properties)."""

import pytest

import __spark_entry__ as entry
from conftest import SMALL

QUERIES = entry.queries()
STREAM_BACKED = {"flash_sale_alerts_stream", "alert_batch_metrics", "segment_history",
                 "segment_history_avg", "top_products_history", "conversion_history",
                 "latest_alerts", "result_table_counts", "result_table_presence", "emit_events"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(set(QUERIES) - STREAM_BACKED))
def test_no_python_no_cartesian(spark, key):
    p = plan(QUERIES[key](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
                "ArrowEvalPython", "PythonUDF"):
        assert bad not in p, f"{key}: {bad}"


def test_day_scan_pushes_range_to_parquet(spark):
    p = plan(QUERIES["extract_day_all"](spark, SMALL))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p


def test_segmentation_prunes_unused_columns(spark):
    p = plan(QUERIES["user_segments_daily"](spark, SMALL))
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "props" not in scan and "value" not in scan


def test_conversion_joins_after_the_aggregate_without_a_job(spark):
    p = plan(QUERIES["category_conversion"](spark, SMALL))
    # lazy: the plan still scans the events; the join is above their aggregate
    assert "events.parquet" in p and "Scan ExistingRDD" not in p
    join = next(i for i, line in enumerate(p.splitlines()) if "Join" in line)
    scan = next(i for i, line in enumerate(p.splitlines()) if "events.parquet" in line)
    assert any("HashAggregate" in line for line in p.splitlines()[join:scan])


def test_dedup_before_windows_shuffles_four_columns(spark):
    p = plan(QUERIES["window_counts"](spark, SMALL))
    scan = [line for line in p.splitlines() if "Exchange hashpartitioning(event_id" in line]
    assert scan
    after = p[p.index("Exchange hashpartitioning(event_id"):]
    project = next(line for line in after.splitlines() if "Project [" in line)
    assert "event_date" not in project and "is_high_value" not in project


def test_top_k_per_day_limits_before_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(QUERIES["top_products_daily"](spark, SMALL))
        d = plan(QUERIES["dedup_events"](spark, SMALL))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert p.count("WindowGroupLimit") == 2
    assert d.count("WindowGroupLimit") == 2


def test_global_top_k_is_take_ordered(spark):
    p = plan(QUERIES["top_conversion_products"](spark, SMALL))
    assert "TakeOrderedAndProject" in p


def test_dimension_attach_follows_the_optimizer(spark):
    from cartpulse.operators.joins import attach_dimension
    from cartpulse.sources.tables import click_events, product_categories
    facts = click_events(spark, SMALL)
    dim = product_categories(spark, SMALL)
    small = attach_dimension(facts, dim, "product_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = attach_dimension(facts, dim, "product_id")
        p = plan(big)
        assert "BroadcastHashJoin" not in p and "SortMergeJoin" in p
        rows = sorted(big.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == sorted(small.collect())
    assert "BroadcastHashJoin" in plan(attach_dimension(facts, dim, "product_id"))
