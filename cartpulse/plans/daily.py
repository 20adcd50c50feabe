"""The three daily jobs (D9, E10, F15) as result-table rows, and a runner.

Each job is one distributed aggregate over the day's events, grouped by
``event_date`` as well, so one run can (re)compute any range of days; the
write replaces exactly those days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.plans import conversion as conv
from cartpulse.plans import products as prod
from cartpulse.plans import segmentation as seg
from cartpulse.plans import sketches as sk
from cartpulse.schema import (CONVERSION_SCHEMA, PRODUCT_VIEWERS, PRODUCT_VIEWERS_SCHEMA,
                              SEGMENTATION_SCHEMA, TOP_PRODUCTS_SCHEMA)
from cartpulse.sinks.tables import read_clean_events, table_path, write_daily

# What the daily jobs read of an event.
JOB_COLUMNS = ["event_date", "event_id", "event_timestamp", "user_id", "product_id", "event_type",
               "product_category", "price"]


def segmentation_rows(events: DataFrame) -> DataFrame:
    """Rows of ``user_segmentation_daily``."""
    return seg.user_segments(events).withColumnRenamed("event_date", "analysis_date")


def top_product_rows(events: DataFrame, categories: DataFrame | None = None,
                     approx_rsd: float | None = None) -> DataFrame:
    """Rows of ``top_products_daily`` (``approx_rsd``: estimated viewers)."""
    top = prod.top_products(prod.product_view_stats(events, categories, approx_rsd=approx_rsd))
    return top.withColumnRenamed("event_date", "analysis_date")


def conversion_rows(events: DataFrame, categories: DataFrame | None = None) -> DataFrame:
    """rows of ``conversion_rate_daily``."""
    counts = conv.funnel_counts(events, categories, by_day=True)
    return (conv.category_conversion(counts, by_day=True)
            .withColumnRenamed("event_date", "analysis_date")
            .withColumnRenamed("product_category", "category"))


def run_daily_jobs(events: DataFrame, root: str, categories: DataFrame | None = None,
                   approx_rsd: float | None = None, first: str | None = None,
                   last: str | None = None, viewer_sketches: bool = False) -> None:
    """Compute and write the three daily tables under ``root``. With a day range,
    a day of it that has no rows any more loses its old answer, too.
    ``viewer_sketches`` adds the table that answers E1-E7 for any range of days."""
    def write(df, name, schema):
        write_daily(df, table_path(root, name), schema, first, last)

    write(segmentation_rows(events), "user_segmentation_daily", SEGMENTATION_SCHEMA)
    write(top_product_rows(events, categories, approx_rsd), "top_products_daily",
          TOP_PRODUCTS_SCHEMA)
    write(conversion_rows(events, categories), "conversion_rate_daily", CONVERSION_SCHEMA)
    if viewer_sketches:
        write(sk.product_viewers(events, categories), PRODUCT_VIEWERS, PRODUCT_VIEWERS_SCHEMA)


def run_changed_days(spark: SparkSession, events_path: str, root: str, checkpoint: str,
                     categories: DataFrame | None = None, approx_rsd: float | None = None,
                     viewer_sketches: bool = False) -> list[str]:
    """Recompute the days that the stream has appended rows to since the last run.

    A streaming query follows the commit log of the cleaned-event table's file sink;
    its checkpoint keeps which files have been seen. One run takes all that is
    committed as one batch: the days of the new rows (the partition column, so no
    data column is read) are computed again from the whole table, which only
    prunes to these days, and replaced. A run that dies repeats its batch, and a day
    written twice is the same day.
    The table only grows, so no day loses its answer. Returns the days, in order; none if nothing was appended.
    """
    from cartpulse.streaming.alerts import read_clean_stream
    days: list[str] = []

    def recompute(rows: DataFrame, batch_id: int) -> None:
        day = F.col("event_date")
        touched = [r[0] for r in rows.where(day.isNotNull()).select(day).distinct()
                   .orderBy(day).collect()]  # days, not rows
        if touched:
            events = read_clean_events(rows.sparkSession, events_path, days=touched)
            # the jobs read them up to six times: copies are dropped once
            events = events.select(*[c for c in JOB_COLUMNS if c in events.columns]).persist()
            try:
                run_daily_jobs(events, root, categories, approx_rsd, viewer_sketches=viewer_sketches)
            finally:
                events.unpersist()
            days.extend(str(d) for d in touched)

    query = (read_clean_stream(spark, events_path).select("event_date").writeStream
             .foreachBatch(recompute).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return days


def main(argv: list[str] | None = None) -> None:
    """``python -m cartpulse.plans.daily --events <cleaned table> --tables <root>
    [--first D --last D]``: (re)compute the three daily tables for a day range
    from the cleaned-event table (partitioned by event_date, so the range prunes);
    ``--changed <checkpoint>`` for the days with rows since that checkpoint's last run."""
    import argparse

    from cartpulse.session import job_session
    ap = argparse.ArgumentParser(description="Daily segmentation, top products, conversion")
    ap.add_argument("--events", required=True, help="cleaned-event table (parquet)")
    ap.add_argument("--tables", required=True, help="result-table root folder")
    ap.add_argument("--first", help="first day (yyyy-MM-dd); default: all days")
    ap.add_argument("--last", help="last day (yyyy-MM-dd); default: --first")
    ap.add_argument("--categories", help="product dimension (product_id, product_category), "
                                         "when the events carry no category")
    ap.add_argument("--approx-viewers", type=float, metavar="RSD",
                    help="estimate unique viewers (HyperLogLog++, relative error RSD)")
    ap.add_argument("--changed", metavar="CHECKPOINT",
                    help="only the days that got rows since the last run with this checkpoint")
    ap.add_argument("--viewer-sketches", action="store_true",
                    help="also write the sketches that answer any range of days")
    a = ap.parse_args(argv)
    if a.changed and a.first:
        ap.error("--changed finds the days itself: no --first")
    spark = job_session("cartpulse-daily")
    events = read_clean_events(spark, a.events, a.first, a.last or a.first)
    categories = spark.read.parquet(a.categories) if a.categories else None
    if categories is None and "product_category" not in events.columns:
        ap.error("the events have no product_category: pass --categories")
    if a.changed:
        days = run_changed_days(spark, a.events, a.tables, a.changed, categories,
                                a.approx_viewers, a.viewer_sketches)
        print("\n".join(days))
        return
    run_daily_jobs(events, a.tables, categories, a.approx_viewers, a.first, a.last or a.first,
                   a.viewer_sketches)


if __name__ == "__main__":
    main()
