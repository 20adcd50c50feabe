"""Sliding event-time windows and the flash-sale alert rule.

Pure DataFrame -> DataFrame functions, used unchanged by the batch plan and
the streaming query. The window expands each event into length/slide
copies; only the three columns the rule needs are projected before the
expansion, and the counts are partial-aggregated right after it, so the
hot product is folded per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartpulse.functions.rules import count_where
from cartpulse.schema import PURCHASE, VIEW, AlertParams


def _seconds(duration: str) -> int:
    n, unit = duration.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return int(n) * scale[unit.rstrip("s")]


def window_counts(events: DataFrame, params: AlertParams = AlertParams(),
                  key: str = "product_id", panes: bool = False) -> DataFrame:
    """Views and purchases per (sliding window, product), with the
    unrounded conversion rate (0 when there are no views).

    ``panes=True`` (batch only) first counts per (slide-sized pane, product),
    then expands the pane counts into the length/slide windows that contain
    them and sums again. Counts are additive and every window is a union of
    whole panes (when length is a multiple of slide), so the answer is the
    same; the expansion then multiplies panes instead of events. A streaming
    query keeps the single ``window()`` aggregate, because a second
    aggregation is not allowed in update mode.
    """
    t = F.col("event_type")
    counts = [count_where(t == VIEW).alias("total_views"),
              count_where(t == PURCHASE).alias("total_purchases")]
    length, slide = _seconds(params.window), _seconds(params.slide)
    narrow = events.select("event_timestamp", key, "event_type")
    if panes and length % slide == 0 and length > slide:
        pane = (narrow.groupBy(F.window("event_timestamp", params.slide).start.alias("pane"), key)
                .agg(*counts))
        k = F.explode(F.sequence(F.lit(0), F.lit(length // slide - 1))).alias("k")
        starts = pane.select(key, "total_views", "total_purchases", "pane", k).select(
            key, "total_views", "total_purchases",
            (F.col("pane") - F.make_dt_interval(secs=F.col("k") * slide)).alias("window_start"))
        agg = starts.groupBy("window_start", key).agg(
            F.sum("total_views").cast("bigint").alias("total_views"),
            F.sum("total_purchases").cast("bigint").alias("total_purchases"))
        agg = agg.withColumn("window_end",
                             F.col("window_start") + F.make_dt_interval(secs=F.lit(length)))
    else:
        agg = (narrow.groupBy(F.window("event_timestamp", params.window, params.slide)
                              .alias("window"), key)
               .agg(*counts)
               .select(key, F.col("window.start").alias("window_start"),
                       F.col("window.end").alias("window_end"),
                       "total_views", "total_purchases"))
    return agg.select(
        key, "window_start", "window_end", "total_views", "total_purchases",
        conversion_rate("total_purchases", "total_views").alias("conversion_rate"))


def conversion_rate(purchases: str, views: str):
    """purchases * 100 / views in double, unrounded; 0.0 when views = 0."""
    return (F.when(F.col(views) > 0,
                   F.col(purchases).cast("double") * F.lit(100.0) / F.col(views))
            .otherwise(F.lit(0.0)))


def alert_rule(counts: DataFrame, params: AlertParams = AlertParams()) -> DataFrame:
    """Strict thresholds, views > min_views and purchases < max_purchases."""
    return counts.filter((F.col("total_views") > params.min_views)
                         & (F.col("total_purchases") < params.max_purchases))


def stamp_alerts(alerts: DataFrame, triggered=None) -> DataFrame:
    """alert_timestamp (now) and alert_triggered."""
    flag = F.lit(True) if triggered is None else triggered
    return alerts.withColumn("alert_timestamp", F.current_timestamp()) \
        .withColumn("alert_triggered", flag)


def alert_updates(counts: DataFrame, params: AlertParams = AlertParams()) -> DataFrame:
    """The streaming emission rule (see ``cartpulse.streaming.alerts``).

    Every changed window with views > min_views is emitted, flagged with
    ``alert_triggered = purchases < max_purchases``. Views only grow and a
    false purchase test stays false, so the last row per key is the current
    truth, and an alert that stops qualifying is retracted by its flag.
    """
    over = counts.filter(F.col("total_views") > params.min_views)
    return stamp_alerts(over, F.col("total_purchases") < params.max_purchases)


def flash_sale_alerts(events: DataFrame, params: AlertParams = AlertParams()) -> DataFrame:
    """C3-C8 as one batch plan over cleaned events (pane pre-aggregation)."""
    return stamp_alerts(alert_rule(window_counts(events, params, panes=True), params))
