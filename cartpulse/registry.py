"""Registered queries over the driver tables, with their DuckDB oracles.

Every query reads the driver tables whole (``events`` and ``part``) through
the clickstream adapter of ``cartpulse.sources.tables``. The SQL strings are
independent re-statements of each answer for DuckDB, used as the oracle.
Timestamps leave Spark as TIMESTAMP_NTZ so they compare with DuckDB
TIMESTAMP; current-time columns are never part of an answer.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.operators import cleanse as cl
from cartpulse.operators import windows as win
from cartpulse.plans import conversion as conv
from cartpulse.plans import products as prod
from cartpulse.plans import segmentation as seg
from cartpulse.schema import FIXTURE_ALERT_PARAMS, AlertParams
from cartpulse.sources import feed
from cartpulse.sources.tables import click_events, clicks, product_categories

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The analysis day used by the single-day scans (A3, A4): the last day of
# the fixture range.
ANALYSIS_DAY = "2024-01-30"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _session_key(spark: SparkSession, *parts) -> tuple:
    """Cache key of per-session work: the application id changes when a
    context is restarted, so a new session never sees another's DataFrames."""
    return (spark.sparkContext.applicationId, id(spark), *parts)


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return click_events(spark, sf_dir)


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_categories(spark, sf_dir)


# --- oracle building blocks -------------------------------------------------

CLICKS_CTE = """clicks AS (
  SELECT e.event_id, e.user_id,
         CAST(json_extract(e.props, '$.k') AS BIGINT) AS product_id,
         CASE e.event_type WHEN 'click' THEN 'add_to_cart' ELSE e.event_type END AS event_type,
         e.ts AS event_timestamp, e.value AS price, p.p_type AS product_category,
         CAST(e.ts AS DATE) AS event_date
  FROM events e
  LEFT JOIN part p ON p.p_partkey = CAST(json_extract(e.props, '$.k') AS BIGINT))"""


def pct_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN round_even(CAST({num} AS DOUBLE) / ({den}) * 100, 2) END"


def ratio_sql(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN round_even(CAST({num} AS DOUBLE) / ({den}), 2) END"


def mean_price_sql(price: str) -> str:
    """Mean of the raw prices, rounded half-even to cents once (exact, in units of
    10 ** -10)."""
    total, n = f"sum(CAST(round({price} * 1e10) AS HUGEINT))", f"count({price})"
    step = f"({n} * 100000000)"
    rem = f"((({total}) % {step} + {step}) % {step})"
    quot = f"((({total}) - {rem}) // {step})"
    return (f"CASE WHEN ({n}) > 0 THEN CAST({quot} + CASE WHEN 2 * {rem} > {step} "
            f"OR (2 * {rem} = {step} AND {quot} % 2 <> 0) THEN 1 ELSE 0 END AS DOUBLE) / 100 END")


def with_clicks(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([CLICKS_CTE, *ctes]) + "\n" + body


# --- conversion funnel (F) ---------------------------------------------------

CAT_COUNTS_SQL = """cat_counts AS (
  SELECT {keys} product_category,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS total_views,
         CAST(count(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS total_cart,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS total_purchases,
         CAST(count(event_type) AS BIGINT) AS total_events
  FROM clicks WHERE product_category IS NOT NULL AND event_type IS NOT NULL
  GROUP BY {keys} product_category)"""

CAT_RATES = f"""{pct_sql('total_purchases', 'total_views')} AS conversion_rate,
  {pct_sql('total_cart', 'total_views')} AS cart_rate,
  coalesce({pct_sql('total_purchases', 'total_cart')}, 0.0) AS purchase_from_cart_rate"""


@register("category_conversion_daily", with_clicks(
    f"SELECT *, {CAT_RATES} FROM cat_counts", CAT_COUNTS_SQL.format(keys="event_date,")))
def q_category_conversion_daily(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=True)
    return conv.category_conversion(counts, by_day=True)


@register("category_conversion", with_clicks(
    f"SELECT *, {CAT_RATES} FROM cat_counts", CAT_COUNTS_SQL.format(keys="")))
def q_category_conversion(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=False)
    return conv.category_conversion(counts, by_day=False)


PROD_CONV_SQL = f"""prod_conv AS (
  SELECT product_id, product_category,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS total_views,
         CAST(count(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS total_cart,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS total_purchases,
         {pct_sql("count(*) FILTER (WHERE event_type = 'purchase')",
                  "count(*) FILTER (WHERE event_type = 'view')")} AS conversion_rate
  FROM clicks
  WHERE product_id IS NOT NULL AND product_category IS NOT NULL AND event_type IS NOT NULL
  GROUP BY product_id, product_category
  HAVING count(*) FILTER (WHERE event_type = 'view') >= 10)"""


@register("product_conversion", with_clicks("SELECT * FROM prod_conv", PROD_CONV_SQL))
def q_product_conversion(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=False)
    return conv.product_conversion(counts)


@register("top_conversion_products", with_clicks(
    "SELECT * FROM prod_conv ORDER BY conversion_rate DESC, product_id, product_category LIMIT 5",
    PROD_CONV_SQL))
def q_top_conversion_products(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=False)
    return conv.top_conversion(conv.product_conversion(counts))


@register("bottom_conversion_products", with_clicks(
    "SELECT * FROM prod_conv WHERE conversion_rate < 100 "
    "ORDER BY conversion_rate, product_id, product_category LIMIT 5", PROD_CONV_SQL))
def q_bottom_conversion_products(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=False)
    return conv.bottom_conversion(conv.product_conversion(counts))


CONV_SUMMARY_SQL = f"""
SELECT o.overall_views, o.overall_purchases,
       {pct_sql('o.overall_purchases', 'o.overall_views')} AS overall_conversion_rate,
       b.product_category AS best_category, b.conversion_rate AS best_category_rate,
       w.product_category AS worst_category, w.conversion_rate AS worst_category_rate
FROM (SELECT CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS overall_views,
             CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS overall_purchases
      FROM clicks) o
LEFT JOIN (SELECT * FROM cat_rates WHERE conversion_rate IS NOT NULL
           ORDER BY conversion_rate DESC, product_category LIMIT 1) b ON TRUE
LEFT JOIN (SELECT * FROM cat_rates WHERE conversion_rate IS NOT NULL
           ORDER BY conversion_rate ASC, product_category DESC LIMIT 1) w ON TRUE"""


@register("conversion_summary", with_clicks(
    CONV_SUMMARY_SQL, CAT_COUNTS_SQL.format(keys=""),
    f"cat_rates AS (SELECT *, {CAT_RATES} FROM cat_counts)"))
def q_conversion_summary(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=False)
    return conv.conversion_summary(counts)


CONV_REPORT_SQL = f"""
SELECT 'overall' AS section, 1 AS item_rank, CAST(NULL AS VARCHAR) AS product_category,
       CAST(NULL AS VARCHAR) AS product_id, overall_views AS total_views,
       CAST(NULL AS BIGINT) AS total_cart, overall_purchases AS total_purchases,
       overall_conversion_rate AS conversion_rate
FROM ({CONV_SUMMARY_SQL}) s
UNION ALL
SELECT 'category', CAST(NULL AS INTEGER), product_category, CAST(NULL AS VARCHAR),
       total_views, total_cart, total_purchases, conversion_rate FROM cat_rates
UNION ALL
SELECT 'top', CAST(row_number() OVER (ORDER BY conversion_rate DESC, product_id, product_category) AS INTEGER),
       product_category, CAST(product_id AS VARCHAR), total_views, total_cart, total_purchases,
       conversion_rate
FROM prod_conv QUALIFY row_number() OVER (ORDER BY conversion_rate DESC, product_id, product_category) <= 5
UNION ALL
SELECT 'bottom', CAST(row_number() OVER (ORDER BY conversion_rate, product_id, product_category) AS INTEGER),
       product_category, CAST(product_id AS VARCHAR), total_views, total_cart, total_purchases,
       conversion_rate
FROM prod_conv WHERE conversion_rate < 100
QUALIFY row_number() OVER (ORDER BY conversion_rate, product_id, product_category) <= 5"""


@register("conversion_report", with_clicks(
    CONV_REPORT_SQL, CAT_COUNTS_SQL.format(keys=""),
    f"cat_rates AS (SELECT *, {CAT_RATES} FROM cat_counts)", PROD_CONV_SQL))
def q_conversion_report(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=False)
    return conv.conversion_report(counts)


@register("event_type_distribution", with_clicks(
    "SELECT event_date, event_type, CAST(count(*) AS BIGINT) AS event_count FROM clicks "
    "WHERE event_type IS NOT NULL GROUP BY event_date, event_type"))
def q_event_type_distribution(spark, sf_dir):
    return conv.event_type_distribution(_facts(spark, sf_dir))


@register("category_distribution", with_clicks(
    "SELECT event_date, product_category, CAST(count(*) AS BIGINT) AS event_count FROM clicks "
    "WHERE product_category IS NOT NULL GROUP BY event_date, product_category"))
def q_category_distribution(spark, sf_dir):
    counts = conv.funnel_counts(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=True)
    return conv.category_distribution(counts)


# --- user segmentation (D) ---------------------------------------------------

SEGMENTS_SQL = """segments AS (
  SELECT event_date, user_id,
         CASE WHEN count(*) FILTER (WHERE event_type = 'purchase') > 0 THEN 'Buyer'
              WHEN count(*) FILTER (WHERE event_type IN ('view', 'add_to_cart')) > 0
                THEN 'Window Shopper'
              ELSE 'Unknown' END AS segment,
         CAST(count(*) AS BIGINT) AS total_events,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS view_count,
         CAST(count(*) FILTER (WHERE event_type = 'add_to_cart') AS BIGINT) AS cart_count,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchase_count
  FROM clicks WHERE user_id IS NOT NULL GROUP BY event_date, user_id)"""

SEG_SUMMARY_SQL = f"""SELECT event_date, CAST(count(*) AS BIGINT) AS total_users,
  CAST(count(*) FILTER (WHERE segment = 'Buyer') AS BIGINT) AS buyers,
  CAST(count(*) FILTER (WHERE segment = 'Window Shopper') AS BIGINT) AS window_shoppers,
  {pct_sql("count(*) FILTER (WHERE segment = 'Buyer')", "count(*)")} AS buyer_percentage
FROM segments GROUP BY event_date"""


def _segments(spark, sf_dir):
    return seg.user_segments(_facts(spark, sf_dir))


@register("user_segments_daily", with_clicks("SELECT * FROM segments", SEGMENTS_SQL))
def q_user_segments_daily(spark, sf_dir):
    return _segments(spark, sf_dir)


@register("segment_distribution", with_clicks(
    "SELECT event_date, segment, CAST(count(*) AS BIGINT) AS user_count FROM segments "
    "GROUP BY event_date, segment", SEGMENTS_SQL))
def q_segment_distribution(spark, sf_dir):
    return seg.segment_distribution(_segments(spark, sf_dir))


@register("segment_sample", with_clicks(
    "SELECT * FROM segments QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY user_id) <= 10",
    SEGMENTS_SQL))
def q_segment_sample(spark, sf_dir):
    return seg.segment_sample(_segments(spark, sf_dir))


@register("segmentation_summary", with_clicks(SEG_SUMMARY_SQL, SEGMENTS_SQL))
def q_segmentation_summary(spark, sf_dir):
    return seg.segmentation_summary(_segments(spark, sf_dir))


@register("segmentation_report", with_clicks(
    f"SELECT *, round_even(100.0 - buyer_percentage, 2) AS shopper_percentage "
    f"FROM ({SEG_SUMMARY_SQL}) s", SEGMENTS_SQL))
def q_segmentation_report(spark, sf_dir):
    return seg.segmentation_report(_segments(spark, sf_dir))


# --- top products (E) --------------------------------------------------------

def stats_sql(keys: str) -> str:
    return f"""stats AS (
  SELECT {keys} v.product_id,
         arg_min(v.product_category, struct_pack(t := v.event_timestamp, id := v.event_id))
           FILTER (WHERE v.product_category IS NOT NULL) AS category,
         CAST(count(v.user_id) AS BIGINT) AS total_views,
         CAST(count(DISTINCT v.user_id) AS BIGINT) AS unique_viewers,
         {mean_price_sql('v.price')} AS avg_price
  FROM clicks v
  WHERE v.event_type = 'view' AND v.product_id IS NOT NULL
  GROUP BY {keys} v.product_id)"""


TOP_DAILY_SQL = f"""top AS (
  SELECT event_date,
         CAST(row_number() OVER (PARTITION BY event_date ORDER BY total_views DESC, product_id) AS INTEGER) AS rank,
         product_id, category, total_views, unique_viewers, avg_price,
         {ratio_sql('total_views', 'unique_viewers')} AS repeat_rate
  FROM stats
  QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY total_views DESC, product_id) <= 5)"""


def _stats(spark, sf_dir, by_day=True):
    return prod.product_view_stats(_facts(spark, sf_dir), _dims(spark, sf_dir), by_day=by_day)


@register("top_products_daily", with_clicks("SELECT * FROM top", stats_sql("event_date,"),
                                            TOP_DAILY_SQL))
def q_top_products_daily(spark, sf_dir):
    return prod.top_products(_stats(spark, sf_dir))


@register("top_products_overall", with_clicks(
    f"""SELECT CAST(row_number() OVER (ORDER BY total_views DESC, product_id) AS INTEGER) AS rank,
         product_id, category, total_views, unique_viewers, avg_price,
         {ratio_sql('total_views', 'unique_viewers')} AS repeat_rate
  FROM stats QUALIFY row_number() OVER (ORDER BY total_views DESC, product_id) <= 5""",
    stats_sql("")))
def q_top_products_overall(spark, sf_dir):
    return prod.top_products(_stats(spark, sf_dir, by_day=False), by_day=False)


@register("top_viewed_products", with_clicks(
    """SELECT event_date, product_id, CAST(count(*) AS BIGINT) AS view_events FROM clicks
       WHERE event_type = 'view' AND product_id IS NOT NULL GROUP BY event_date, product_id
       QUALIFY row_number() OVER (PARTITION BY event_date ORDER BY count(*) DESC, product_id) <= 10"""))
def q_top_viewed_products(spark, sf_dir):
    return prod.top_viewed(_facts(spark, sf_dir))


INSIGHTS_SQL = """insights AS (
  SELECT event_date,
         arg_min(product_id, rank) AS most_popular_product,
         arg_min(total_views, rank) AS most_popular_views,
         arg_max(product_id, [avg_price, -rank]) FILTER (WHERE avg_price IS NOT NULL) AS highest_value_product,
         max(avg_price) AS highest_avg_price,
         CAST(sum(total_views) AS BIGINT) AS top_total_views,
         CAST(sum(unique_viewers) AS BIGINT) AS top_total_viewers
  FROM top GROUP BY event_date)"""


@register("top_products_insights", with_clicks(
    "SELECT * FROM insights", stats_sql("event_date,"), TOP_DAILY_SQL, INSIGHTS_SQL))
def q_top_products_insights(spark, sf_dir):
    return prod.top_products_insights(prod.top_products(_stats(spark, sf_dir)))


@register("top_products_report", with_clicks(
    "SELECT t.*, i.* EXCLUDE (event_date) FROM top t JOIN insights i USING (event_date)",
    stats_sql("event_date,"), TOP_DAILY_SQL, INSIGHTS_SQL))
def q_top_products_report(spark, sf_dir):
    return prod.top_products_report(prod.top_products(_stats(spark, sf_dir)))


# --- single-day scans (A3, A4) -----------------------------------------------

@register("extract_day_all", with_clicks(
    "SELECT event_id, user_id, product_id, event_type, CAST(event_timestamp AS TIMESTAMP) "
    "AS event_timestamp, price, event_date FROM clicks "
    f"WHERE event_date = DATE '{ANALYSIS_DAY}'"))
def q_extract_day_all(spark, sf_dir):
    return _ntz(click_events(spark, sf_dir, day=ANALYSIS_DAY))


@register("extract_day_views", with_clicks(
    "SELECT event_id, user_id, product_id, event_type, CAST(event_timestamp AS TIMESTAMP) "
    "AS event_timestamp, price, event_date FROM clicks "
    f"WHERE event_date = DATE '{ANALYSIS_DAY}' AND event_type = 'view'"))
def q_extract_day_views(spark, sf_dir):
    return _ntz(click_events(spark, sf_dir, day=ANALYSIS_DAY).filter(F.col("event_type") == "view"))


def _ntz(df: DataFrame) -> DataFrame:
    """Timestamps as TIMESTAMP_NTZ (UTC wall clock) to line up with DuckDB."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


# --- decode, cleanse, de-duplicate (B) ----------------------------------------

def _feed_sql() -> str:
    faults = " OR ".join(f"event_id % {m} = 0" for m in feed.FAULTS.values())
    return f"""feed AS (
  SELECT *, 0 AS copy FROM clicks WHERE NOT ({faults})
  UNION ALL
  SELECT *, 1 AS copy FROM clicks)"""


def decoded_cols(offset: str | None = "event_id * 2 + copy",
                 arrival: str | None = "event_timestamp + copy * INTERVAL 1 SECOND",
                 enriched: bool = True) -> str:
    """Oracle columns of decoded messages; ``offset``/``arrival`` None leaves
    the bus position and arrival time out."""
    cols = f"""printf('evt_%08d', event_id) AS event_id, printf('user_%04d', user_id) AS user_id,
  printf('prod_%04d', product_id) AS product_id, event_type,
  event_timestamp, printf('session_%d', 1000 + user_id % 9000) AS session_id, product_category,
  ['mobile', 'desktop', 'tablet'][event_id % 3 + 1] AS device_type,
  '/product/' || printf('prod_%04d', product_id) AS page_url, price * {feed.PRICE_SCALE} AS price,
  CAST(user_id % 3 AS INTEGER) AS partition"""
    if offset is not None:
        cols += f", {offset} AS offset"
    if arrival is not None:
        cols += f", {arrival} AS kafka_timestamp"
    if enriched:
        cols += f""", price * {feed.PRICE_SCALE} > 500 AS is_high_value,
  CAST(event_timestamp AS DATE) AS event_date, CAST(hour(event_timestamp) AS INTEGER) AS event_hour"""
    return cols


DECODED_COLS = decoded_cols()

VALID_FEED = f"""valid AS (
  SELECT * FROM feed
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
    AND event_type IS NOT NULL AND event_timestamp IS NOT NULL AND price * {feed.PRICE_SCALE} > 0)"""


def _clicks(spark, sf_dir) -> DataFrame:
    """The per-event enriched view."""
    return clicks(spark, sf_dir)


def _decoded(spark, sf_dir) -> DataFrame:
    return cl.validate(cl.decode(feed.faulty_feed(_clicks(spark, sf_dir))))


@register("decode_clean_events", with_clicks(f"SELECT {DECODED_COLS} FROM valid",
                                             _feed_sql(), VALID_FEED))
def q_decode_clean_events(spark, sf_dir):
    return _ntz(_decoded(spark, sf_dir).drop("processing_timestamp"))


@register("dedup_events", with_clicks(
    f"SELECT {DECODED_COLS} FROM valid QUALIFY row_number() OVER "
    "(PARTITION BY event_id ORDER BY event_timestamp, event_timestamp + copy * INTERVAL 1 SECOND, "
    "user_id % 3, event_id * 2 + copy) = 1", _feed_sql(), VALID_FEED))
def q_dedup_events(spark, sf_dir):
    return _ntz(cl.deduplicate(_decoded(spark, sf_dir)).drop("processing_timestamp"))


# --- sliding windows and alerts (C) -------------------------------------------

CLEAN_SQL = """clean AS (
  SELECT * FROM clicks
  WHERE event_id IS NOT NULL AND user_id IS NOT NULL AND product_id IS NOT NULL
    AND event_type IS NOT NULL AND event_timestamp IS NOT NULL AND price > 0
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY event_timestamp) = 1)"""

_UNITS_US = {"second": 10 ** 6, "minute": 60 * 10 ** 6, "hour": 3600 * 10 ** 6,
             "day": 86400 * 10 ** 6}


def _micros(duration: str) -> int:
    n, unit = duration.split()
    return int(n) * _UNITS_US[unit.rstrip("s")]


def window_counts_sql(params: AlertParams) -> str:
    length, slide = _micros(params.window), _micros(params.slide)
    return f"""wexp AS (
  SELECT product_id, event_type, unnest(range(0, {length // slide})) AS k,
         (epoch_us(event_timestamp) // {slide}) * {slide} AS last_start
  FROM clean),
wcounts AS (
  SELECT product_id, make_timestamp(last_start - k * {slide}) AS window_start,
         make_timestamp(last_start - k * {slide} + {length}) AS window_end,
         CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS total_views,
         CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS total_purchases
  FROM wexp GROUP BY ALL),
wrates AS (
  SELECT *, CASE WHEN total_views > 0 THEN CAST(total_purchases AS DOUBLE) * 100.0 / total_views
                 ELSE 0.0 END AS conversion_rate
  FROM wcounts)"""


def alerts_sql(params: AlertParams) -> str:
    return (f"SELECT *, true AS alert_triggered FROM wrates WHERE total_views > {params.min_views}"
            f" AND total_purchases < {params.max_purchases}")


def _clean_facts(spark, sf_dir) -> DataFrame:
    """Valid events, one per id, with the columns that windows need: the de-dup
    shuffles no others."""
    valid = cl.validate(click_events(spark, sf_dir))
    return cl.deduplicate(valid.select("event_id", "event_timestamp", "product_id", "event_type"))


@register("window_counts", with_clicks("SELECT * FROM wrates", CLEAN_SQL,
                                       window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_window_counts(spark, sf_dir):
    return _ntz(win.window_counts(_clean_facts(spark, sf_dir), FIXTURE_ALERT_PARAMS, panes=True))


@register("flash_sale_alerts", with_clicks(alerts_sql(FIXTURE_ALERT_PARAMS), CLEAN_SQL,
                                           window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_flash_sale_alerts(spark, sf_dir):
    alerts = win.flash_sale_alerts(_clean_facts(spark, sf_dir), FIXTURE_ALERT_PARAMS)
    return _ntz(alerts.drop("alert_timestamp"))


# --- streaming alerts (A1, C1-C15) ---------------------------------------------

# Replay batching: files per trigger. Files hold consecutive time ranges and come
# in order, so the answers do not depend on this number.
REPLAY_FILES_PER_TRIGGER = 8
_STREAM_RUNS: dict[tuple, dict] = {}


def stream_run(spark: SparkSession, sf_dir: str, dedup: str = "bounded") -> dict:
    """Replay the fixture feed through the streaming alert query once per
    session, input folder and mode (bounded, exact, or final: bounded in append form;
    the modes share the replay files);
    returns the replay, checkpoint and alert-log paths."""
    import uuid

    from cartpulse.session import input_key, work_path
    from cartpulse.streaming.alerts import replay_alerts
    from cartpulse.streaming.replay import in_time_order
    key = _session_key(spark, sf_dir, dedup)
    if key not in _STREAM_RUNS:
        shared = next((v["replay"] for k, v in _STREAM_RUNS.items() if k[:-1] == key[:-1]), None)
        workdir = work_path(spark, "stream", input_key(sf_dir), uuid.uuid4().hex)
        messages = None
        if not shared:
            rows = _facts(spark, sf_dir).count()  # of the file footers
            messages = feed.faulty_feed(in_time_order(_clicks(spark, sf_dir), rows))
        # the exact run keeps a compacted log, so both forms of the log are compared
        _STREAM_RUNS[key] = replay_alerts(spark, messages, workdir, FIXTURE_ALERT_PARAMS,
                                          dedup="bounded" if dedup == "final" else dedup,
                                          replay_path=shared, final=dedup == "final",
                                          max_files_per_trigger=REPLAY_FILES_PER_TRIGGER,
                                          compact_every=4 if dedup == "exact" else None,
                                          in_order=True)
    return _STREAM_RUNS[key]


def _stream_alerts(spark, sf_dir, dedup: str = "bounded") -> DataFrame:
    from cartpulse.streaming.alerts import current_alerts, read_alert_log
    return current_alerts(read_alert_log(spark, stream_run(spark, sf_dir, dedup)["alert_log"]))


STREAM_ALERTS_SQL = ("SELECT printf('prod_%04d', product_id) AS product_id, window_start, "
                     "window_end, total_views, total_purchases, conversion_rate, alert_triggered "
                     f"FROM ({alerts_sql(FIXTURE_ALERT_PARAMS)}) a")


@register("flash_sale_alerts_stream", with_clicks(STREAM_ALERTS_SQL, CLEAN_SQL,
                                                  window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_flash_sale_alerts_stream(spark, sf_dir):
    return _ntz(_stream_alerts(spark, sf_dir).drop("alert_timestamp"))


@register("flash_sale_alerts_stream_exact", with_clicks(
    STREAM_ALERTS_SQL, CLEAN_SQL, window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_flash_sale_alerts_stream_exact(spark, sf_dir):
    """C2 in the source's shape: de-dup before the watermark, state kept for
    every id. On an ordered replay it equals the bounded mode and the batch."""
    return _ntz(_stream_alerts(spark, sf_dir, "exact").drop("alert_timestamp"))


# The watermark is behind the newest event by the allowed lateness and one window.
FINAL_HORIZON = _micros(FIXTURE_ALERT_PARAMS.watermark) + _micros(FIXTURE_ALERT_PARAMS.window)


@register("flash_sale_alerts_final", with_clicks(
    f"{STREAM_ALERTS_SQL} WHERE epoch_us(window_end) <= "
    f"(SELECT max(epoch_us(event_timestamp)) FROM clean) - {FINAL_HORIZON}", CLEAN_SQL,
    window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_flash_sale_alerts_final(spark, sf_dir):
    """C9, append form: the alerts of the windows that the watermark has closed, each
    emitted once, equal the batch answer over these windows."""
    from cartpulse.streaming.alerts import read_final_alerts
    final = read_final_alerts(spark, stream_run(spark, sf_dir, "final")["alert_log"])
    return _ntz(final.drop("alert_timestamp"))


_CLEAN_RUNS: dict[tuple, str] = {}


def clean_stream_run(spark: SparkSession, sf_dir: str) -> str:
    """Stream the fixture feed (the replay files of ``stream_run``) into the
    cleaned-event table once per session and input folder; returns its path."""
    import uuid

    from cartpulse.session import input_key, work_path
    from cartpulse.streaming.alerts import read_events, start_clean_event_sink, valid_stream
    key = _session_key(spark, sf_dir)
    if key not in _CLEAN_RUNS:
        replay = stream_run(spark, sf_dir)["replay"]
        workdir = work_path(spark, "clean_stream", input_key(sf_dir), uuid.uuid4().hex)
        messages = read_events(spark, source="parquet", path=replay,
                               max_files_per_trigger=REPLAY_FILES_PER_TRIGGER)
        from cartpulse.schema import ENVELOPE_SCHEMA
        clean = valid_stream(messages.select(*ENVELOPE_SCHEMA.fieldNames()))
        q = start_clean_event_sink(clean, f"{workdir}/clean_events", f"{workdir}/checkpoint",
                                   trigger={"availableNow": True})
        q.awaitTermination()
        _CLEAN_RUNS[key] = f"{workdir}/clean_events"
    return _CLEAN_RUNS[key]


@register("clean_events_stream", with_clicks(
    f"SELECT {decoded_cols(offset=None, arrival=None)} FROM valid "
    "QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY copy) = 1",
    _feed_sql(), VALID_FEED))
def q_clean_events_stream(spark, sf_dir):
    """H1 written by the stream (every valid row) and read as the daily jobs read
    it, one row per event id."""
    from cartpulse.sinks.tables import read_clean_events
    table = read_clean_events(spark, clean_stream_run(spark, sf_dir))
    return _ntz(table.drop("offset", "kafka_timestamp"))


_METRIC_RUNS: dict[tuple, dict] = {}


def metrics_run(spark: SparkSession, sf_dir: str) -> dict:
    """Replay the fixture feed with one micro-batch for each day (as many files a day as
    files a trigger), so that batches do not depend on file splits; returns the paths
    of the alert log and of the listener's metrics."""
    import uuid

    from cartpulse.session import input_key, work_path
    from cartpulse.streaming.alerts import replay_alerts
    from cartpulse.streaming.replay import write_periods
    key = _session_key(spark, sf_dir)
    if key not in _METRIC_RUNS:
        workdir = work_path(spark, "metrics", input_key(sf_dir), uuid.uuid4().hex)
        files = write_periods(spark, feed.faulty_feed(_clicks(spark, sf_dir)), f"{workdir}/days")
        paths = replay_alerts(spark, None, workdir, FIXTURE_ALERT_PARAMS, replay_path=f"{workdir}/days",
                              max_files_per_trigger=files, metrics=f"{workdir}/metrics")
        _METRIC_RUNS[key] = {**paths, "metrics": f"{workdir}/metrics"}
    return _METRIC_RUNS[key]


# What each day's batch changes: an event belongs to the batch in which its first
# valid copy arrives; a window's counts are those of all batches so far.
_FIXTURE_SLIDE, _FIXTURE_LENGTH = _micros(FIXTURE_ALERT_PARAMS.slide), _micros(FIXTURE_ALERT_PARAMS.window)
BATCH_SQL = f"""batches AS (
  SELECT day, row_number() OVER (ORDER BY day) - 1 AS batch_id, input_rows
  FROM (SELECT CAST(event_timestamp + c * INTERVAL 1 SECOND AS DATE) AS day, count(*) AS input_rows
        FROM clicks, (VALUES (0), (1)) AS t(c) GROUP BY 1)),
arrived AS (
  SELECT event_id, any_value(product_id) AS product_id, any_value(event_type) AS event_type,
         any_value(event_timestamp) AS event_timestamp,
         CAST(min(event_timestamp + copy * INTERVAL 1 SECOND) AS DATE) AS day
  FROM valid GROUP BY event_id),
touched AS (
  SELECT product_id, day, event_type,
         unnest(range(0, {_FIXTURE_LENGTH // _FIXTURE_SLIDE})) * {_FIXTURE_SLIDE} AS back,
         (epoch_us(event_timestamp) // {_FIXTURE_SLIDE}) * {_FIXTURE_SLIDE} AS last_start FROM arrived),
gained AS (
  SELECT product_id, last_start - back AS window_start, day,
         count(*) FILTER (WHERE event_type = 'view') AS views,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases
  FROM touched GROUP BY ALL),
changed AS (
  SELECT product_id, day, sum(views) OVER w AS views, sum(purchases) OVER w AS purchases
  FROM gained WINDOW w AS (PARTITION BY product_id, window_start ORDER BY day)),
updates AS (
  SELECT batch_id, product_id, views, purchases, purchases < {FIXTURE_ALERT_PARAMS.max_purchases} AS alert
  FROM changed JOIN batches USING (day) WHERE views > {FIXTURE_ALERT_PARAMS.min_views})"""
_BATCH_SUMS = """count(*) AS changed_windows, count(*) FILTER (WHERE alert) AS alerts,
  CAST(sum(views) FILTER (WHERE alert) AS BIGINT) AS alert_views,
  CAST(sum(purchases) FILTER (WHERE alert) AS BIGINT) AS alert_purchases"""


@register("alert_batch_metrics", with_clicks(
    f"SELECT batch_id, {_BATCH_SUMS}, count(DISTINCT product_id) FILTER (WHERE alert) AS alert_products, "
    "max(CAST(purchases AS DOUBLE) * 100.0 / views) FILTER (WHERE alert) AS max_alert_rate "
    "FROM updates GROUP BY batch_id", _feed_sql(), VALID_FEED, BATCH_SQL))
def q_alert_batch_metrics(spark, sf_dir):
    """C14: per micro-batch metrics from the alert log, one batch for each day."""
    from cartpulse.streaming.alerts import batch_metrics, read_alert_log
    return batch_metrics(read_alert_log(spark, metrics_run(spark, sf_dir)["alert_log"]))


@register("alert_stream_progress", with_clicks(
    "SELECT b.batch_id, CAST(b.input_rows AS BIGINT) AS input_rows, coalesce(changed_windows, 0) AS "
    "changed_windows, coalesce(alerts, 0) AS alerts, alert_views, alert_purchases, "
    "CAST(0 AS BIGINT) AS rows_dropped_late FROM batches b LEFT JOIN "
    f"(SELECT batch_id, {_BATCH_SUMS} FROM updates GROUP BY batch_id) u ON u.batch_id = b.batch_id",
    _feed_sql(), VALID_FEED, BATCH_SQL))
def q_alert_stream_progress(spark, sf_dir):
    """C14: what the query listener kept of every batch that read rows."""
    from cartpulse.streaming.metrics import read_metrics
    rows = read_metrics(spark, metrics_run(spark, sf_dir)["metrics"]).where("input_rows > 0")
    return rows.drop("run_started", "state_rows")


_TABLE_STREAM_RUNS: dict[tuple, str] = {}


def table_stream_run(spark: SparkSession, sf_dir: str, accepted: bool) -> str:
    """Alerts streamed from a table instead of messages: the cleaned-event table
    (copies dropped by the bounded de-dup), or the accepted events, whose ids an
    index has checked; returns the alert log's path."""
    import uuid

    from cartpulse.schema import ENVELOPE_SCHEMA
    from cartpulse.session import input_key, work_path
    from cartpulse.streaming import accepted as acc
    from cartpulse.streaming import alerts as al
    key = _session_key(spark, sf_dir, accepted)
    if key not in _TABLE_STREAM_RUNS:
        workdir = work_path(spark, "table_stream", input_key(sf_dir), uuid.uuid4().hex)
        now = {"availableNow": True}
        if accepted:
            messages = al.read_events(spark, source="parquet", path=stream_run(spark, sf_dir)["replay"],
                                      max_files_per_trigger=REPLAY_FILES_PER_TRIGGER)
            valid = al.valid_stream(messages.select(*ENVELOPE_SCHEMA.fieldNames()))
            acc.start_accept_query(valid, workdir, f"{workdir}/accept_checkpoint", now,
                                   compact_every=2).awaitTermination()
            events = acc.read_accepted_stream(spark, workdir)
        else:
            events = al.read_clean_stream(spark, clean_stream_run(spark, sf_dir))
        alerts = al.event_alerts(events, FIXTURE_ALERT_PARAMS, "accepted" if accepted else "bounded")
        al.start_alert_query(alerts, al.log_sink(f"{workdir}/log"), f"{workdir}/checkpoint",
                             now).awaitTermination()
        _TABLE_STREAM_RUNS[key] = f"{workdir}/log"
    return _TABLE_STREAM_RUNS[key]


def _table_stream_alerts(spark, sf_dir, accepted: bool) -> DataFrame:
    from cartpulse.streaming.alerts import current_alerts, read_alert_log
    log = read_alert_log(spark, table_stream_run(spark, sf_dir, accepted))
    return _ntz(current_alerts(log).drop("alert_timestamp"))


@register("flash_sale_alerts_from_table", with_clicks(STREAM_ALERTS_SQL, CLEAN_SQL,
                                                      window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_flash_sale_alerts_from_table(spark, sf_dir):
    """C13 with one decoded stream: alerts from the cleaned-event table's commit log."""
    return _table_stream_alerts(spark, sf_dir, accepted=False)


@register("flash_sale_alerts_accepted", with_clicks(STREAM_ALERTS_SQL, CLEAN_SQL,
                                                    window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_flash_sale_alerts_accepted(spark, sf_dir):
    """C2 exact with bounded state: ids checked against the index of accepted ids."""
    return _table_stream_alerts(spark, sf_dir, accepted=True)


# --- result tables and history (D9, E10, F15, H1-H3, G1-G7) ----------------------

_TABLE_RUNS: dict[tuple, str] = {}
# Seconds by which the fixture's alerts are raised after their window's end: the
# views times a step, modulo ten days.
LATE_STEP, LATE_RANGE = 79_199, 864_000


def result_tables(spark: SparkSession, sf_dir: str) -> str:
    """Compute and write the four result tables once per session and input
    folder (re-writes are idempotent); returns the tables root."""
    from cartpulse.plans.daily import run_daily_jobs
    from cartpulse.schema import ALERT_SCHEMA
    from cartpulse.session import input_key, work_path
    from cartpulse.sinks.tables import table_path, write_snapshot
    key = _session_key(spark, sf_dir)
    if key not in _TABLE_RUNS:
        # one folder per application: parallel sessions never write the same tables
        root = work_path(spark, "tables", input_key(sf_dir), spark.sparkContext.applicationId)
        run_daily_jobs(_facts(spark, sf_dir), root, _dims(spark, sf_dir))
        # fixed stamps instead of the wall clock: alerts are raised late, in another
        # order than their windows end
        late = F.make_dt_interval(secs=F.pmod(F.col("total_views") * LATE_STEP, F.lit(LATE_RANGE)))
        alerts = _stream_alerts(spark, sf_dir).withColumn("alert_timestamp", F.col("window_end") + late)
        write_snapshot(alerts, table_path(root, "flash_sale_alerts"), ALERT_SCHEMA)
        _TABLE_RUNS[key] = root
    return _TABLE_RUNS[key]


def _table(spark, sf_dir, name) -> DataFrame:
    from cartpulse.sinks.tables import read_result_table
    return read_result_table(spark, result_tables(spark, sf_dir), name)


SEG_TABLE_SQL = """seg_table AS (
  SELECT event_date AS analysis_date, CAST(user_id AS VARCHAR) AS user_id, segment, total_events
  FROM segments)"""


@register("segment_history", with_clicks(
    "SELECT analysis_date, segment, CAST(count(*) AS BIGINT) AS user_count FROM seg_table "
    "GROUP BY analysis_date, segment ORDER BY analysis_date DESC, segment LIMIT 10",
    SEGMENTS_SQL, SEG_TABLE_SQL))
def q_segment_history(spark, sf_dir):
    from cartpulse.plans.history import segment_history
    return segment_history(_table(spark, sf_dir, "user_segmentation_daily"))


@register("segment_history_avg", with_clicks(
    "SELECT analysis_date, segment, CAST(count(*) AS BIGINT) AS users, "
    "CAST((sum(total_events) * 200 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_events "
    "FROM seg_table GROUP BY analysis_date, segment", SEGMENTS_SQL, SEG_TABLE_SQL))
def q_segment_history_avg(spark, sf_dir):
    from cartpulse.plans.history import segment_history_avg
    return segment_history_avg(_table(spark, sf_dir, "user_segmentation_daily"))


@register("top_products_history", with_clicks(
    "SELECT event_date AS analysis_date, rank, CAST(product_id AS VARCHAR) AS product_id, "
    "category, total_views, unique_viewers FROM top "
    "ORDER BY analysis_date DESC, rank LIMIT 10", stats_sql("event_date,"), TOP_DAILY_SQL))
def q_top_products_history(spark, sf_dir):
    from cartpulse.plans.history import top_products_history
    return top_products_history(_table(spark, sf_dir, "top_products_daily"))


@register("conversion_history", with_clicks(
    f"SELECT event_date AS analysis_date, product_category AS category, total_views, "
    f"total_purchases, {pct_sql('total_purchases', 'total_views')} AS conversion_rate "
    f"FROM cat_counts", CAT_COUNTS_SQL.format(keys="event_date,")))
def q_conversion_history(spark, sf_dir):
    from cartpulse.plans.history import conversion_history
    return conversion_history(_table(spark, sf_dir, "conversion_rate_daily"))


@register("latest_alerts", with_clicks(
    f"SELECT * FROM ({STREAM_ALERTS_SQL}) s ORDER BY epoch_us(window_end) + "
    f"(total_views * {LATE_STEP} % {LATE_RANGE}) * 1000000 DESC, window_end DESC, product_id LIMIT 10",
    CLEAN_SQL, window_counts_sql(FIXTURE_ALERT_PARAMS)))
def q_latest_alerts(spark, sf_dir):
    from cartpulse.plans.history import latest_alerts
    return _ntz(latest_alerts(_table(spark, sf_dir, "flash_sale_alerts")))


TABLE_COUNTS_SQL = """counts AS (
  SELECT 'user_segmentation_daily' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM segments
  UNION ALL SELECT 'top_products_daily', CAST(count(*) AS BIGINT) FROM top
  UNION ALL SELECT 'conversion_rate_daily', CAST(count(*) AS BIGINT) FROM cat_counts
  UNION ALL SELECT 'flash_sale_alerts', CAST(count(*) AS BIGINT) FROM wrates
    WHERE total_views > {v} AND total_purchases < {p})""".format(
    v=FIXTURE_ALERT_PARAMS.min_views, p=FIXTURE_ALERT_PARAMS.max_purchases)

_ALL_TABLE_CTES = (SEGMENTS_SQL, stats_sql("event_date,"), TOP_DAILY_SQL,
                   CAT_COUNTS_SQL.format(keys="event_date,"), CLEAN_SQL,
                   window_counts_sql(FIXTURE_ALERT_PARAMS), TABLE_COUNTS_SQL)


@register("result_table_counts", with_clicks("SELECT * FROM counts", *_ALL_TABLE_CTES))
def q_result_table_counts(spark, sf_dir):
    from cartpulse.plans.history import result_table_counts
    return result_table_counts(spark, result_tables(spark, sf_dir))


@register("result_table_presence", with_clicks(
    "SELECT table_name, true AS present, row_count FROM counts", *_ALL_TABLE_CTES))
def q_result_table_presence(spark, sf_dir):
    from cartpulse.plans.history import result_table_presence
    return result_table_presence(spark, result_tables(spark, sf_dir))


# --- emission (A7) ---------------------------------------------------------------

_EMIT_RUNS: dict[tuple, str] = {}


def emit_run(spark: SparkSession, sf_dir: str) -> str:
    """A7 once per session: stream ``events`` through the adapter (a
    stream-static join with the product table) into keyed JSON messages."""
    import uuid

    from cartpulse.operators.joins import attach_dimension
    from cartpulse.session import input_key, work_path
    from cartpulse.sources.tables import events_stream, to_click_events
    from cartpulse.streaming.emit import start_emitter
    key = _session_key(spark, sf_dir)
    if key not in _EMIT_RUNS:
        workdir = work_path(spark, "emit", input_key(sf_dir), uuid.uuid4().hex)
        stream = attach_dimension(to_click_events(events_stream(spark, sf_dir)),
                                  _dims(spark, sf_dir), "product_id")
        query = start_emitter(feed.encode_messages(stream), f"{workdir}/checkpoint",
                              sink="parquet", path=f"{workdir}/messages",
                              trigger={"availableNow": True})
        query.awaitTermination()
        _EMIT_RUNS[key] = f"{workdir}/messages"
    return _EMIT_RUNS[key]


@register("emit_events", with_clicks(
    "SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, "
    "CAST(product_id AS VARCHAR) AS product_id, event_type, event_timestamp, "
    "CAST(NULL AS VARCHAR) AS session_id, product_category, CAST(NULL AS VARCHAR) AS device_type, "
    "CAST(NULL AS VARCHAR) AS page_url, price, CAST(user_id % 3 AS INTEGER) AS partition, "
    "event_id AS offset, event_timestamp AS kafka_timestamp FROM clicks"))
def q_emit_events(spark, sf_dir):
    """A7 round trip: emitted messages decode back to the adapter rows."""
    return _ntz(cl.decode(spark.read.parquet(emit_run(spark, sf_dir)))
                .drop("processing_timestamp"))


# --- daily analyses over the stream-written cleaned-event table (H1 -> D, E, F) --

H1_SQL = f"""h1 AS (
  SELECT {decoded_cols(offset=None, arrival=None)} FROM valid
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY copy) = 1)"""


def _h1(spark, sf_dir) -> DataFrame:
    """The cleaned-event table as the stream wrote it (category on each event)."""
    from cartpulse.sinks.tables import read_clean_events
    return read_clean_events(spark, clean_stream_run(spark, sf_dir))


def _over_h1(sql: str) -> str:
    """An oracle body written against ``clicks``, re-aimed at the h1 rows."""
    return sql.replace("FROM clicks", "FROM h1")


@register("segments_from_clean_table", with_clicks(
    "SELECT * FROM segments", _feed_sql(), VALID_FEED, H1_SQL, _over_h1(SEGMENTS_SQL)))
def q_segments_from_clean_table(spark, sf_dir):
    """D1-D3 over the H1 table written by the stream: the daily job's real input."""
    return seg.user_segments(_h1(spark, sf_dir))


@register("category_conversion_from_clean_table", with_clicks(
    f"SELECT *, {CAT_RATES} FROM cat_counts", _feed_sql(), VALID_FEED, H1_SQL,
    _over_h1(CAT_COUNTS_SQL.format(keys="event_date,"))))
def q_category_conversion_from_clean_table(spark, sf_dir):
    """F1-F7 over the H1 table (category carried by each event)."""
    return conv.category_conversion(conv.funnel_counts(_h1(spark, sf_dir), by_day=True))


@register("top_products_from_clean_table", with_clicks(
    "SELECT * FROM top", _feed_sql(), VALID_FEED, H1_SQL,
    stats_sql("event_date,").replace("FROM clicks v", "FROM h1 v"), TOP_DAILY_SQL))
def q_top_products_from_clean_table(spark, sf_dir):
    """E1-E7 over the H1 table: first category in event order, exact viewers."""
    return prod.top_products(prod.product_view_stats(_h1(spark, sf_dir)))


# --- daily tables by change, and any range of days (H3; E2) -----------------------

_CHANGE_RUNS: dict[tuple, str] = {}


def change_run(spark: SparkSession, sf_dir: str) -> str:
    """Daily tables kept up by change, once per session and input folder: the first
    copies of the feed's events (some faulty) are streamed into a cleaned-event table
    and the days computed; then the clean retries arrive for the same days, late, and
    the days they touch are computed again. Returns the tables root."""
    import uuid

    from cartpulse.plans.daily import run_changed_days
    from cartpulse.schema import ENVELOPE_SCHEMA
    from cartpulse.session import input_key, work_path
    from cartpulse.streaming.alerts import read_events, start_clean_event_sink, valid_stream
    key = _session_key(spark, sf_dir)
    if key not in _CHANGE_RUNS:
        workdir = work_path(spark, "by_change", input_key(sf_dir), uuid.uuid4().hex)
        messages = feed.faulty_feed(_clicks(spark, sf_dir))
        for copy in (0, 1):
            (messages.where(F.col("offset") % 2 == copy).write.mode("append")
             .parquet(f"{workdir}/messages"))
            arrived = read_events(spark, source="parquet", path=f"{workdir}/messages")
            start_clean_event_sink(valid_stream(arrived.select(*ENVELOPE_SCHEMA.fieldNames())),
                                   f"{workdir}/clean", f"{workdir}/clean_checkpoint",
                                   {"availableNow": True}).awaitTermination()
            run_changed_days(spark, f"{workdir}/clean", f"{workdir}/tables",
                             f"{workdir}/days_checkpoint", viewer_sketches=True)
        _CHANGE_RUNS[key] = f"{workdir}/tables"
    return _CHANGE_RUNS[key]


def _changed_table(spark, sf_dir, name) -> DataFrame:
    from cartpulse.sinks.tables import read_result_table
    return read_result_table(spark, change_run(spark, sf_dir), name).drop("created_at")


@register("segments_by_change", with_clicks(
    "SELECT event_date AS analysis_date, user_id, segment, total_events, view_count, cart_count, "
    "purchase_count FROM segments", _feed_sql(), VALID_FEED, H1_SQL, _over_h1(SEGMENTS_SQL)))
def q_segments_by_change(spark, sf_dir):
    """The segments table after two runs over the days that got rows."""
    return _changed_table(spark, sf_dir, "user_segmentation_daily")


@register("category_conversion_by_change", with_clicks(
    f"SELECT event_date AS analysis_date, product_category AS category, total_views, total_cart, "
    f"total_purchases, {CAT_RATES} FROM cat_counts", _feed_sql(), VALID_FEED, H1_SQL,
    _over_h1(CAT_COUNTS_SQL.format(keys="event_date,"))))
def q_category_conversion_by_change(spark, sf_dir):
    """The conversion table after two runs over the days that got rows."""
    return _changed_table(spark, sf_dir, "conversion_rate_daily")


# Two weeks in the middle of the fixture's days.
RANGE_FIRST, RANGE_LAST = "2024-01-08", "2024-01-21"


@register("product_views_any_range", with_clicks(
    "SELECT product_id, category, total_views, avg_price, true AS viewers_close FROM stats",
    _feed_sql(), VALID_FEED, H1_SQL,
    f"ranged AS (SELECT * FROM h1 WHERE event_date BETWEEN DATE '{RANGE_FIRST}' AND DATE '{RANGE_LAST}')",
    stats_sql("").replace("FROM clicks v", "FROM ranged v")))
def q_product_views_any_range(spark, sf_dir):
    """E1-E3, E6 over a range of days from the stored rows; ``viewers_close``: the merged
    sketches' viewers are within three times the stated error of the exact count."""
    from cartpulse.plans.sketches import RELATIVE_ERROR, range_view_stats
    from cartpulse.schema import PRODUCT_VIEWERS
    stats = range_view_stats(_changed_table(spark, sf_dir, PRODUCT_VIEWERS), RANGE_FIRST, RANGE_LAST)
    day = F.col("event_date")
    events = _h1(spark, sf_dir).where(day.between(F.to_date(F.lit(RANGE_FIRST)),
                                                  F.to_date(F.lit(RANGE_LAST))))
    exact = prod.product_view_stats(events, by_day=False).select(
        "product_id", F.col("unique_viewers").alias("exact_viewers"))
    close = (F.abs(F.col("unique_viewers") - F.col("exact_viewers"))
             <= F.col("exact_viewers") * (3 * RELATIVE_ERROR))
    return (stats.join(exact, "product_id", "left")
            .select("product_id", "category", "total_views", "avg_price",
                    F.coalesce(close, F.lit(False)).alias("viewers_close")))
