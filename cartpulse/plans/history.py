"""History queries over the result tables.

Each limit gets a total order: the source's SQL orders by date only, which
leaves ties to chance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.functions.rules import half_up_mean, top_k
from cartpulse.schema import HISTORY_LIMIT, RESULT_TABLES
from cartpulse.sinks.tables import (footer_session, read_result_table, table_presence,
                                    table_row_count)


def segment_history(segments: DataFrame, limit: int = HISTORY_LIMIT) -> DataFrame:
    """G1: users per (day, segment), newest day first."""
    counts = segments.groupBy("analysis_date", "segment").agg(
        F.count(F.lit(1)).alias("user_count"))
    return top_k(counts, limit, [F.desc("analysis_date"), F.asc("segment")])


def segment_history_avg(segments: DataFrame) -> DataFrame:
    """Users and ROUND(AVG(total_events), 2) per (day, segment).

    The source rounds a decimal average half-up; done exactly in integers.
    """
    agg = segments.groupBy("analysis_date", "segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("total_events").alias("_events"))
    return (agg.select("analysis_date", "segment", "users",
                       half_up_mean("_events", "users").alias("avg_events"))
            .orderBy(F.desc("analysis_date"), "segment"))


def top_products_history(top: DataFrame, limit: int = HISTORY_LIMIT) -> DataFrame:
    """Newest days first, by rank."""
    return top_k(top.select("analysis_date", "rank", "product_id", "category",
                            "total_views", "unique_viewers"),
                 limit, [F.desc("analysis_date"), F.asc("rank")])


def conversion_history(conv: DataFrame) -> DataFrame:
    """Every category-day, newest first, best rate first."""
    return (conv.select("analysis_date", "category", "total_views", "total_purchases",
                        "conversion_rate")
            .orderBy(F.desc("analysis_date"), F.desc_nulls_last("conversion_rate"),
                     "category"))


def latest_alerts(alerts: DataFrame, limit: int = HISTORY_LIMIT) -> DataFrame:
    """The ten alerts raised last; alerts of one time by window end, then
    product. A window that qualifies late comes first."""
    last = top_k(alerts, limit, [F.desc_nulls_last("alert_timestamp"), F.desc("window_end"),
                                 F.asc("product_id")])
    return last.select("product_id", "window_start", "window_end", "total_views",
                       "total_purchases", "conversion_rate", "alert_triggered")


def result_table_counts(spark: SparkSession, root: str) -> DataFrame:
    """Row count of each result table; a missing table counts 0 rows."""
    return (result_table_presence(spark, root)
            .select("table_name", F.coalesce("row_count", F.lit(0)).alias("row_count")))


def result_table_presence(spark: SparkSession, root: str) -> DataFrame:
    """Presence flag per result table with its row count (NULL if absent); counts
    come from file footers (``table_row_count``)."""
    present = table_presence(spark, root)
    own = footer_session(spark)
    parts = []
    for name in RESULT_TABLES:
        if present[name]:
            parts.append(table_row_count(own, root, name)
                         .select(F.lit(name).alias("table_name"), F.lit(True).alias("present"),
                                 "row_count"))
        else:
            parts.append(own.range(1).select(
                F.lit(name).alias("table_name"), F.lit(False).alias("present"),
                F.lit(None).cast("bigint").alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


HISTORY_QUERIES = {
    "segment_history": ("user_segmentation_daily", segment_history),
    "segment_history_avg": ("user_segmentation_daily", segment_history_avg),
    "top_products_history": ("top_products_daily", top_products_history),
    "conversion_history": ("conversion_rate_daily", conversion_history),
    "latest_alerts": ("flash_sale_alerts", latest_alerts),
}


def print_all(df: DataFrame) -> None:
    """Every row, tab-separated, one partition at a time."""
    print("\t".join(df.columns))
    for row in df.toLocalIterator():
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> None:
    """``python -m cartpulse.plans.history --tables <root> <query>``: print a
    history query (or ``counts`` / ``presence``) over the result tables;
    ``sql --sql "..."`` runs any SQL against the tables by name."""
    import argparse

    from cartpulse.session import job_session
    ap = argparse.ArgumentParser(description="History queries over the result tables")
    ap.add_argument("--tables", required=True)
    ap.add_argument("query", choices=[*HISTORY_QUERIES, "counts", "presence", "sql"])
    ap.add_argument("--sql", help="with query 'sql': any SQL over the result-table names")
    ap.add_argument("--out", help="write the rows as CSV to this folder instead of printing them")
    a = ap.parse_args(argv)
    spark = job_session("cartpulse-history")
    if a.query == "sql":
        from cartpulse.sinks.tables import register_result_views
        register_result_views(spark, a.tables)
        out = spark.sql(a.sql)
    elif a.query == "counts":
        out = result_table_counts(spark, a.tables)
    elif a.query == "presence":
        out = result_table_presence(spark, a.tables)
    else:
        table, fn = HISTORY_QUERIES[a.query]
        out = fn(read_result_table(spark, a.tables, table))
    if a.out:
        out.write.mode("overwrite").option("header", True).csv(a.out)
    else:
        print_all(out)


if __name__ == "__main__":
    main()
