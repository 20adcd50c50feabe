"""Batch sources (A3, A4, A8) and the adapter from the driver tables.

The driver tables carry a generic event log (``events``) and a product
dimension (``part``). The adapter maps them onto the clickstream model:

=================  ==============================================
clickstream        from
=================  ==============================================
event_id, user_id  events
product_id         ``props.k`` (100 products)
event_type         ``click`` -> ``add_to_cart``; others unchanged
event_timestamp    ts, cast from TIMESTAMP_NTZ to TIMESTAMP (UTC)
price              value
product_category   part.p_type on p_partkey = product_id
=================  ==============================================

The category is a *dimension attribute*: it is a function of product_id.
``click_events`` therefore returns the fact columns only and
``product_categories`` the dimension; the analyses aggregate the facts to
(day, product) first and attach the category to that small result, instead
of shuffling every event through a join with the product table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators.joins import attach_dimension

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _event_type(col: Column) -> Column:
    return F.when(col == "click", F.lit("add_to_cart")).otherwise(col)


def click_events(spark: SparkSession, sf_dir: str, day: str | None = None) -> DataFrame:
    """Clickstream facts without the category (see module doc).

    ``day`` (A3) filters the raw ``ts`` column before any cast, so the range
    reaches the parquet scan as a pushed filter and skips row groups.
    """
    ev = read_table(spark, sf_dir, "events")
    if day is not None:
        start = F.lit(day).cast("timestamp_ntz")
        ev = ev.filter((F.col("ts") >= start) & (F.col("ts") < start + F.expr("INTERVAL 1 DAY")))
    return to_click_events(ev)


def to_click_events(ev: DataFrame) -> DataFrame:
    """The adapter projection over an ``events`` frame (batch or stream)."""
    ts = F.col("ts").cast("timestamp")
    return ev.select(
        F.col("event_id"),
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        _event_type(F.col("event_type")).alias("event_type"),
        ts.alias("event_timestamp"),
        F.col("value").alias("price"),
        F.to_date(ts).alias("event_date"),
    )


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a file stream (new files are new events)."""
    schema = read_table(spark, sf_dir, "events").schema
    base = sf_dir.rstrip("/")
    return (spark.readStream.schema(schema).option("basePath", base)
            .parquet(f"{base}/{{events.parquet}}"))


def product_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product dimension: (product_id, product_category)."""
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with the category attached per event (the denormalised event).

    Used where the category must travel with each event (the encoded feed).
    """
    facts = click_events(spark, sf_dir)
    dim = product_categories(spark, sf_dir)
    return attach_dimension(facts, dim, "product_id").select(
        "event_id", "user_id", "product_id", "event_type", "event_timestamp",
        "price", "product_category", "event_date")


def day_events(events: DataFrame, day: str | None = None) -> DataFrame:
    """A3: one day's events (``event_date = day``); all days when ``day`` is None.

    On the cleaned-event table (partitioned by ``event_date``) this prunes
    partitions; for the driver tables use ``click_events(..., day=)``.
    """
    if day is None:
        return events
    return events.filter(F.col("event_date") == F.to_date(F.lit(day)))


def day_views(events: DataFrame, day: str | None = None) -> DataFrame:
    """A4: one day's ``view`` events."""
    return day_events(events, day).filter(F.col("event_type") == "view")
