"""Top viewed products.

The source computes per-product stats and distinct viewers in two pandas
group-bys and merges them (its only join). Here both come from one two-level
aggregate: first per (day, product, user), then per (day, product). The first
level is keyed by user as well, so a hot product (a third of all views) is
spread over many tasks; the second level sees at most one row per viewer.
Distinct viewers fall out as a plain count, with no Expand of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartpulse.functions.rules import mean_half_even, price_units, ratio, top_k, top_k_per_group
from cartpulse.operators.joins import attach_dimension
from cartpulse.schema import TOP_PRODUCTS_K, TOP_VIEWS_K, VIEW


def _day_keys(by_day: bool) -> list[str]:
    return ["event_date"] if by_day else []


def product_view_stats(events: DataFrame, categories: DataFrame | None = None,
                       by_day: bool = True, approx_rsd: float | None = None) -> DataFrame:
    """total_views, unique_viewers, category, avg_price per product.

    ``events`` may hold every type; only views count. total_views counts
    non-null user ids; category is the first non-null category in event
    order (or the dimension value when ``categories`` is given); avg_price is
    the mean of non-null prices rounded half-even to two decimals.
    """
    keys = _day_keys(by_day) + ["product_id"]
    views = events.filter((F.col("event_type") == VIEW) & F.col("product_id").isNotNull())
    if approx_rsd is not None:
        return _approx_view_stats(views, keys, categories, approx_rsd)
    level1 = [F.count("user_id").alias("n_views"),
              F.sum(price_units("price")).alias("price_units"),
              F.count("price").alias("n_prices")]
    level2 = [F.sum("n_views").cast("bigint").alias("total_views"),
              F.count("user_id").alias("unique_viewers"),
              F.sum("price_units").alias("price_units"),
              F.sum("n_prices").alias("n_prices")]
    if categories is None:
        first_ts = F.when(F.col("product_category").isNotNull(), F.col("event_timestamp"))
        level1.append(F.min(first_ts).alias("first_ts"))
        level2.append(F.min("first_ts").alias("first_ts"))
    stats = (views.groupBy(*keys, "user_id").agg(*level1)
             .groupBy(*keys).agg(*level2))
    if categories is None:
        stats = _with_first_category(views, stats, keys)
    else:
        stats = attach_dimension(
            stats, categories.withColumnRenamed("product_category", "category"), "product_id")
    return stats.select(*keys, "category", "total_views", "unique_viewers",
                        mean_half_even("price_units", "n_prices").alias("avg_price"))


def _with_first_category(views: DataFrame, stats: DataFrame, keys: list) -> DataFrame:
    """Attach the first non-null category in event order (event time, then
    event id; rows without an event time come after all timed rows).

    A string in an aggregation buffer forces a sort-based aggregate over every
    view. Instead the hash aggregate keeps only the earliest timestamp that
    has a category (``first_ts``), and the views at exactly that timestamp are
    fetched by a semi-join with the (key, first_ts) pairs, so only the candidate
    rows, about one per group, reach the sort that breaks ties by event id.
    """
    firsts = stats.select(*[F.col(k).alias(f"_f_{k}") for k in keys], F.col("first_ts").alias("_f_ts"))
    cat_views = views.filter(F.col("product_category").isNotNull()) \
        .select(*keys, "event_timestamp", "event_id", "product_category")
    cond = [F.col(k) == F.col(f"_f_{k}") for k in keys] + \
        [F.col("event_timestamp").eqNullSafe(F.col("_f_ts"))]
    cand = cat_views.join(firsts, cond, "left_semi")
    first = cand.groupBy(*keys).agg(
        F.min_by("product_category", "event_id").alias("category"))
    return stats.join(first, keys, "left").drop("first_ts")


def _approx_view_stats(views: DataFrame, keys: list, categories: DataFrame | None,
                       rsd: float) -> DataFrame:
    """Opt-in for very large inputs: one aggregate, unique viewers estimated
    by HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``)
    instead of the exact two-level aggregate."""
    aggs = [F.count("user_id").alias("total_views"),
            F.approx_count_distinct("user_id", rsd).alias("unique_viewers"),
            F.sum(price_units("price")).alias("price_units"),
            F.count("price").alias("n_prices")]
    if categories is None:
        aggs.append(F.min(F.when(F.col("product_category").isNotNull(),
                                 F.col("event_timestamp"))).alias("first_ts"))
    stats = views.groupBy(*keys).agg(*aggs)
    if categories is None:
        stats = _with_first_category(views, stats, keys)
    else:
        stats = attach_dimension(
            stats, categories.withColumnRenamed("product_category", "category"), "product_id")
    return stats.select(*keys, "category", "total_views", "unique_viewers",
                        mean_half_even("price_units", "n_prices").alias("avg_price"))


def _view_order():
    return [F.desc("total_views"), F.asc("product_id")]


def top_products(stats: DataFrame, k: int = TOP_PRODUCTS_K, by_day: bool = True) -> DataFrame:
    """Top-k by total_views (ties: lowest product_id), ranked 1..k.

    Fewer than k products give fewer rows. Per day this is a row_number
    under a ``rank <= k`` filter (WindowGroupLimit before the shuffle);
    overall it is TakeOrderedAndProject.
    """
    if by_day:
        ranked = top_k_per_group(stats, ["event_date"], k, _view_order(), rank_col="rank")
    else:
        ranked = top_k(stats, k, _view_order()).withColumn(
            "rank", F.row_number().over(Window.orderBy(*_view_order())))
    return ranked.select(*_day_keys(by_day), F.col("rank").cast("int").alias("rank"),
                         "product_id", "category", "total_views", "unique_viewers",
                         "avg_price",
                         ratio("total_views", "unique_viewers").alias("repeat_rate"))


def top_viewed(events: DataFrame, k: int = TOP_VIEWS_K, by_day: bool = True) -> DataFrame:
    """``value_counts().head(k)`` of product_id over the view events."""
    keys = _day_keys(by_day)
    counts = (events.filter((F.col("event_type") == VIEW) & F.col("product_id").isNotNull())
              .groupBy(*keys, "product_id").agg(F.count(F.lit(1)).alias("view_events")))
    order = [F.desc("view_events"), F.asc("product_id")]
    if by_day:
        return top_k_per_group(counts, keys, k, order)
    return top_k(counts, k, order)


def _insight_aggs() -> dict:
    pricey = F.when(F.col("avg_price").isNotNull(),
                    F.struct(F.col("avg_price"), -F.col("rank")))
    return {
        "most_popular_product": F.min_by("product_id", "rank"),
        "most_popular_views": F.min_by("total_views", "rank"),
        "highest_value_product": F.max_by("product_id", pricey),
        "highest_avg_price": F.max("avg_price"),
        "top_total_views": F.sum("total_views"),
        "top_total_viewers": F.sum("unique_viewers"),
    }


def top_products_insights(top: DataFrame, by_day: bool = True) -> DataFrame:
    """Most popular (rank 1), highest avg_price (first rank on ties), and
    the sums of views and of unique viewers over the top-k rows."""
    return top.groupBy(*_day_keys(by_day)).agg(
        *[c.cast("bigint").alias(n) if n.startswith("top_total") else c.alias(n)
          for n, c in _insight_aggs().items()])


def top_products_report(top: DataFrame, by_day: bool = True) -> DataFrame:
    """The per-product block with the day's insights alongside.

    The insights are window aggregates over the at most k rows of each day,
    so no join is needed.
    """
    w = Window.partitionBy(*_day_keys(by_day))
    return top.select("*", *[
        c.over(w).cast("bigint").alias(n) if n.startswith("top_total") else c.over(w).alias(n)
        for n, c in _insight_aggs().items()])
