"""Top products over any range of days (E1-E7) from stored daily rows.

Unique viewers do not add up over days: a user who returns would count twice. So each
(day, product) keeps a HyperLogLog sketch of its viewers (``hll_sketch_agg``), at most
a few KB whatever the number of viewers, beside sums that do add up. A range of
days is then one aggregate over days x products rows, with the sketches merged by
``hll_union_agg``; no event is read again, and a recomputed day replaces its rows
only. The sketch is built with map-side partial aggregation, so a hot product ships
one sketch per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.rules import mean_half_even, price_units
from cartpulse.operators.joins import attach_dimension
from cartpulse.plans.products import _with_first_category
from cartpulse.schema import VIEW

# log2 of a sketch's registers, and the relative standard error that it states for
# many viewers (few viewers are counted nearly exactly).
LG_REGISTERS = 12
RELATIVE_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)


def product_viewers(events: DataFrame, categories: DataFrame | None = None,
                    lg_registers: int = LG_REGISTERS) -> DataFrame:
    """Rows of ``product_viewers_daily``: per (day, product) the views, the price sum
    and count, the first category in event order (or the dimension's) and the sketch
    of non-null user ids. A day and product without any user id has no sketch."""
    keys = ["event_date", "product_id"]
    views = events.filter((F.col("event_type") == VIEW) & F.col("product_id").isNotNull())
    user = F.col("user_id").cast("string")
    aggs = [F.count("user_id").alias("total_views"),
            F.sum(price_units("price")).alias("price_units"),
            F.count("price").alias("n_prices"),
            F.hll_sketch_agg(user, F.lit(lg_registers)).alias("viewers")]
    if categories is None:
        aggs.append(F.min(F.when(F.col("product_category").isNotNull(),
                                 F.col("event_timestamp"))).alias("first_ts"))
    rows = views.groupBy(*keys).agg(*aggs)
    if categories is None:
        rows = _with_first_category(views, rows, keys)
    else:
        rows = attach_dimension(
            rows, categories.withColumnRenamed("product_category", "category"), "product_id")
    return rows.select(F.col("event_date").alias("analysis_date"), "product_id", "category",
                       "total_views", F.col("price_units").cast("decimal(38,0)").alias("price_units"),
                       "n_prices", "viewers")


def range_view_stats(viewers: DataFrame, first: str | None = None,
                     last: str | None = None) -> DataFrame:
    """E1-E3, E6 per product over the days first .. last (all by default), in the shape
    of ``products.product_view_stats``: its ``top_products`` ranks them. Unique
    viewers are estimated within about ``RELATIVE_ERROR``; the rest is exact. The
    category is that of the first day that has one."""
    if first:
        day = F.col("analysis_date")
        viewers = viewers.filter(day.between(F.to_date(F.lit(first)), F.to_date(F.lit(last or first))))
    known = F.when(F.col("category").isNotNull(), F.col("analysis_date"))
    stats = viewers.groupBy("product_id").agg(
        F.min_by("category", known).alias("category"),
        F.sum("total_views").cast("bigint").alias("total_views"),
        F.hll_sketch_estimate(F.hll_union_agg("viewers")).alias("unique_viewers"),
        F.sum("price_units").cast("decimal(38,0)").alias("price_units"),
        F.sum("n_prices").cast("bigint").alias("n_prices"))
    return stats.select("product_id", "category", "total_views",
                        F.coalesce("unique_viewers", F.lit(0)).cast("bigint").alias("unique_viewers"),
                        mean_half_even("price_units", "n_prices").alias("avg_price"))
