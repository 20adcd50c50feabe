"""Conversion funnel (F1-F16) as one aggregate plus small roll-ups.

Plan shape: one shuffle aggregates the events to (day, product[, category])
conditional counts; every other answer (category pivot, product pivot, overall
summary, distributions, best/worst) is a roll-up of that result, whose size is
bounded by days x products, not by events. Counts are additive, so nothing
is re-read. A pivot via ``groupBy().pivot()`` would cost two shuffles; the
conditional counts cost one and absorb the hot product in the map-side
partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.rules import count_where, ratio_pct, top_k, top_k_per_group
from cartpulse.operators.joins import attach_dimension
from cartpulse.schema import ADD_TO_CART, CONVERSION_K, MIN_PRODUCT_VIEWS, PURCHASE, VIEW

COUNT_COLS = ["total_views", "total_cart", "total_purchases", "total_events", "all_events"]


def _day_keys(by_day: bool) -> list[str]:
    return ["event_date"] if by_day else []


def funnel_counts(events: DataFrame, categories: DataFrame | None = None,
                  by_day: bool = True) -> DataFrame:
    """Per (day, product, category) funnel counts; NULL keys kept as groups.

    ``total_events`` counts rows with a non-null event type (the pandas pivot
    drops NULL types); ``all_events`` counts every row (value_counts of the
    category). With ``categories`` (product_id -> product_category) the events
    are aggregated per product first and the dimension attached afterwards.
    """
    t = F.col("event_type")
    aggs = [
        count_where(t == VIEW).alias("total_views"),
        count_where(t == ADD_TO_CART).alias("total_cart"),
        count_where(t == PURCHASE).alias("total_purchases"),
        F.count(t).alias("total_events"),
        F.count(F.lit(1)).alias("all_events"),
    ]
    keys = _day_keys(by_day)
    if categories is None:
        return events.groupBy(*keys, "product_id", "product_category").agg(*aggs)
    per_product = events.groupBy(*keys, "product_id").agg(*aggs)
    # Attached after the aggregate: days x products rows are joined, not events.
    return attach_dimension(per_product, categories, "product_id")


def _rates(df: DataFrame) -> DataFrame:
    return df.select(
        "*",
        ratio_pct("total_purchases", "total_views").alias("conversion_rate"),
        ratio_pct("total_cart", "total_views").alias("cart_rate"),
        F.coalesce(ratio_pct("total_purchases", "total_cart"), F.lit(0.0))
        .alias("purchase_from_cart_rate"),
    )


def _sums(cols: list[str]) -> list[Column]:
    return [F.sum(c).cast("bigint").alias(c) for c in cols]


def category_conversion(counts: DataFrame, by_day: bool = True) -> DataFrame:
    """Category pivot with rates, sorted by conversion_rate desc.

    A category whose rows all have a NULL event type has no pivot row, as in
    the pandas pivot (``total_events > 0``).
    """
    keys = _day_keys(by_day) + ["product_category"]
    cat = (counts.filter(F.col("product_category").isNotNull())
           .groupBy(*keys).agg(*_sums(COUNT_COLS[:4]))
           .filter(F.col("total_events") > 0))
    return _rates(cat).orderBy(*_day_keys(by_day), F.desc_nulls_last("conversion_rate"),
                               "product_category")


def product_conversion(counts: DataFrame, min_views: int = MIN_PRODUCT_VIEWS,
                       by_day: bool = False) -> DataFrame:
    """(product, category) pivot with conversion_rate, views >= min_views."""
    keys = _day_keys(by_day) + ["product_id", "product_category"]
    prod = (counts.filter(F.col("product_id").isNotNull()
                          & F.col("product_category").isNotNull())
            .groupBy(*keys).agg(*_sums(COUNT_COLS[:4]))
            .filter((F.col("total_events") > 0) & (F.col("total_views") >= min_views)))
    return prod.select(*keys, "total_views", "total_cart", "total_purchases",
                       ratio_pct("total_purchases", "total_views").alias("conversion_rate"))


def top_conversion(products: DataFrame, k: int = CONVERSION_K) -> DataFrame:
    """highest rounded rates; ties by (product_id, category)."""
    return top_k(products, k, [F.desc("conversion_rate"), "product_id", "product_category"])


def bottom_conversion(products: DataFrame, k: int = CONVERSION_K) -> DataFrame:
    """lowest rates among those under 100 %."""
    return top_k(products.filter(F.col("conversion_rate") < 100), k,
                 [F.asc("conversion_rate"), "product_id", "product_category"])


def conversion_summary(counts: DataFrame, by_day: bool = False) -> DataFrame:
    """F12-F13 in one aggregate.

    Overall views and purchases cover every row (NULL categories included);
    best / worst category follow the F7 order (rate desc, category asc) over
    categories with a defined rate. Built as one roll-up of the per-category
    counts, so no second scan and no join of summaries.
    """
    keys = _day_keys(by_day)
    per_cat = _rates(counts.groupBy(*keys, "product_category").agg(*_sums(COUNT_COLS[:4])))
    ranked = F.when(F.col("product_category").isNotNull() & (F.col("total_events") > 0)
                    & F.col("conversion_rate").isNotNull(),
                    F.struct(-F.col("conversion_rate"), F.col("product_category")))
    out = per_cat.groupBy(*keys).agg(
        F.sum("total_views").cast("bigint").alias("overall_views"),
        F.sum("total_purchases").cast("bigint").alias("overall_purchases"),
        F.min_by("product_category", ranked).alias("best_category"),
        F.min_by("conversion_rate", ranked).alias("best_category_rate"),
        F.max_by("product_category", ranked).alias("worst_category"),
        F.max_by("conversion_rate", ranked).alias("worst_category_rate"),
    )
    return out.select(*keys, "overall_views", "overall_purchases",
                      ratio_pct("overall_purchases", "overall_views")
                      .alias("overall_conversion_rate"),
                      "best_category", "best_category_rate",
                      "worst_category", "worst_category_rate")


def event_type_distribution(events: DataFrame, by_day: bool = True) -> DataFrame:
    """``value_counts`` of event_type (NULL excluded)."""
    keys = _day_keys(by_day)
    return (events.filter(F.col("event_type").isNotNull())
            .groupBy(*keys, "event_type").agg(F.count(F.lit(1)).alias("event_count"))
            .orderBy(*keys, F.desc("event_count"), "event_type"))


def category_distribution(counts: DataFrame, by_day: bool = True) -> DataFrame:
    """``value_counts`` of product_category, from the funnel counts."""
    keys = _day_keys(by_day)
    return (counts.filter(F.col("product_category").isNotNull())
            .groupBy(*keys, "product_category")
            .agg(F.sum("all_events").cast("bigint").alias("event_count"))
            .orderBy(*keys, F.desc("event_count"), "product_category"))


def conversion_report(counts: DataFrame, min_views: int = MIN_PRODUCT_VIEWS,
                      k: int = CONVERSION_K) -> DataFrame:
    """F16: overall, per-category, top-k and bottom-k rows as one tagged table.

    One aggregate over grouping sets gives the three levels (all, category, product)
    of the funnel counts, so the events are scanned once and nothing is kept in the
    session. A product row then goes to the sections it qualifies for. Without any
    counts there is one overall row of NULLs, as in ``conversion_summary``.
    """
    keys = ["product_id", "product_category"]
    counts = counts.select(*keys, *COUNT_COLS[:4])
    nothing = counts.sparkSession.range(1).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in counts.schema.fields])
    levels = (counts.unionByName(nothing)
              .groupingSets([[], ["product_category"], keys], *keys)
              .agg(*_sums(COUNT_COLS[:4]), F.grouping_id().alias("level"))
              .withColumn("conversion_rate", ratio_pct("total_purchases", "total_views")))
    # grouping_id has a bit for each key that was summed over: product_id 2, category 1
    level, rate = F.col("level"), F.col("conversion_rate")
    named = F.col("product_category").isNotNull() & (F.col("total_events") > 0)
    listed = named & F.col("product_id").isNotNull() & (F.col("total_views") >= min_views)
    section = (F.when(level == 3, F.array(F.lit("overall")))
               .when((level == 2) & named, F.array(F.lit("category")))
               .when((level == 0) & listed, F.array_compact(F.array(
                   F.lit("top"), F.when(rate < 100, F.lit("bottom"))))))
    rows = levels.withColumn("section", F.explode(section))
    # rank <= k: WindowGroupLimit keeps k rows of a section per task before the shuffle.
    # Categories carry no rank (their order is conversion_rate, F7): each is a group of
    # its own, so that no task holds them all.
    is_category = F.col("section") == "category"
    rows = rows.withColumn("_group", F.when(is_category, F.col("product_category")))
    ranked = top_k_per_group(
        rows, ["section", "_group"], k,
        [F.asc_nulls_last(F.when(F.col("section") == "top", -rate).otherwise(rate)),
         F.col("product_id"), F.col("product_category")], rank_col="item_rank")
    return ranked.select(
        "section", F.when(~is_category, F.col("item_rank")).cast("int").alias("item_rank"),
        "product_category", F.col("product_id").cast("string").alias("product_id"),
        "total_views", F.when(F.col("section") != "overall", F.col("total_cart")).alias("total_cart"),
        "total_purchases", "conversion_rate")
