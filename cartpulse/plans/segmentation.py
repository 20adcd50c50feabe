"""User segmentation.

The per-user event list of the source is never built: classification and the
four counts fold into one aggregate of conditional counts, which combines map
side, so a very active user (or a bot on a third of all rows) is reduced per
task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.rules import count_where, ratio_pct, top_k, top_k_per_group
from cartpulse.schema import (ADD_TO_CART, PURCHASE, SEGMENT_BUYER, SEGMENT_SAMPLE_K,
                              SEGMENT_SHOPPER, SEGMENT_UNKNOWN, VIEW)


def _day_keys(by_day: bool) -> list[str]:
    return ["event_date"] if by_day else []


def user_segments(events: DataFrame, by_day: bool = True) -> DataFrame:
    """One row per (day, user) with segment and counts.

    Buyer if any purchase; else Window Shopper if any view or add_to_cart;
    else Unknown. ``total_events`` counts every event, NULL types included.
    """
    t = F.col("event_type")
    keys = _day_keys(by_day)
    per_user = (events.filter(F.col("user_id").isNotNull())
                .groupBy(*keys, "user_id")
                .agg(F.count(F.lit(1)).alias("total_events"),
                     count_where(t == VIEW).alias("view_count"),
                     count_where(t == ADD_TO_CART).alias("cart_count"),
                     count_where(t == PURCHASE).alias("purchase_count")))
    segment = (F.when(F.col("purchase_count") > 0, F.lit(SEGMENT_BUYER))
               .when(F.col("view_count") + F.col("cart_count") > 0, F.lit(SEGMENT_SHOPPER))
               .otherwise(F.lit(SEGMENT_UNKNOWN)))
    return per_user.select(*keys, "user_id", segment.alias("segment"), "total_events",
                           "view_count", "cart_count", "purchase_count")


def segment_distribution(segments: DataFrame, by_day: bool = True) -> DataFrame:
    """Users per segment, most common first."""
    keys = _day_keys(by_day)
    return (segments.groupBy(*keys, "segment").agg(F.count(F.lit(1)).alias("user_count"))
            .orderBy(*keys, F.desc("user_count"), "segment"))


def segment_sample(segments: DataFrame, k: int = SEGMENT_SAMPLE_K,
                   by_day: bool = True) -> DataFrame:
    """First k users in user_id order (per day)."""
    if by_day:
        return top_k_per_group(segments, ["event_date"], k, [F.col("user_id")])
    return top_k(segments, k, [F.col("user_id")])


def segmentation_summary(segments: DataFrame, by_day: bool = True) -> DataFrame:
    """Totals and buyer percentage (NULL percentage on empty input)."""
    keys = _day_keys(by_day)
    seg = F.col("segment")
    out = segments.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_users"),
        count_where(seg == SEGMENT_BUYER).alias("buyers"),
        count_where(seg == SEGMENT_SHOPPER).alias("window_shoppers"))
    return out.withColumn("buyer_percentage", ratio_pct("buyers", "total_users"))


def segmentation_report(segments: DataFrame, by_day: bool = True) -> DataFrame:
    """The summary plus the shopper share as printed by the source,
    ``100 - buyer %`` (so Unknown users count towards it)."""
    summary = segmentation_summary(segments, by_day)
    return summary.withColumn(
        "shopper_percentage", F.bround(F.lit(100.0) - F.col("buyer_percentage"), 2))
