"""Declared schemas and run parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Fixed values that must equal the source pipeline's for equal results:
# event types, alert thresholds, window geometry, watermark, top-k sizes,
# minimum support and segment labels.
VIEW = "view"
ADD_TO_CART = "add_to_cart"
PURCHASE = "purchase"
EVENT_TYPES = ["view", "add_to_cart", "purchase"]
SEGMENT_BUYER = "Buyer"
SEGMENT_SHOPPER = "Window Shopper"
SEGMENT_UNKNOWN = "Unknown"
DEFAULT_VIEW_THRESHOLD = 100
DEFAULT_PURCHASE_THRESHOLD = 5
DEFAULT_WINDOW = "10 minutes"
DEFAULT_SLIDE = "1 minute"
DEFAULT_WATERMARK = "5 minutes"
HIGH_VALUE_PRICE = 500.0
TOP_PRODUCTS_K = 5
TOP_VIEWS_K = 10
CONVERSION_K = 5
MIN_PRODUCT_VIEWS = 10
SEGMENT_SAMPLE_K = 10
HISTORY_LIMIT = 10

# A2: the JSON payload of one clickstream event; every field nullable.
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("timestamp", T.StringType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("product_category", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("page_url", T.StringType(), True),
    T.StructField("price", T.DoubleType(), True),
])

# The message envelope of the event bus (the columns a Kafka source yields
# that the pipeline uses). File replays carry the same columns.
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

# H1: a row of the cleaned-event table.
CLEAN_EVENT_SCHEMA = T.StructType(
    EVENT_SCHEMA.fields[:4]
    + [T.StructField("event_timestamp", T.TimestampType(), True)]
    + EVENT_SCHEMA.fields[5:]
    + [T.StructField("partition", T.IntegerType(), True), T.StructField("offset", T.LongType(), True),
       T.StructField("kafka_timestamp", T.TimestampType(), True),
       T.StructField("is_high_value", T.BooleanType(), True),
       T.StructField("event_hour", T.IntegerType(), True), T.StructField("event_date", T.DateType(), True)])

# Result tables (serial ids dropped; natural keys in the docstrings).
ALERT_SCHEMA = T.StructType([  # key (product_id, window_start)
    T.StructField("product_id", T.StringType(), False),
    T.StructField("window_start", T.TimestampType(), False),
    T.StructField("window_end", T.TimestampType(), False),
    T.StructField("total_views", T.LongType(), False),
    T.StructField("total_purchases", T.LongType(), False),
    T.StructField("conversion_rate", T.DoubleType(), True),
    T.StructField("alert_timestamp", T.TimestampType(), False),
    T.StructField("alert_triggered", T.BooleanType(), False),
])

SEGMENTATION_SCHEMA = T.StructType([  # key (analysis_date, user_id)
    T.StructField("user_id", T.StringType(), False),
    T.StructField("segment", T.StringType(), False),
    T.StructField("total_events", T.LongType(), False),
    T.StructField("view_count", T.LongType(), False),
    T.StructField("cart_count", T.LongType(), False),
    T.StructField("purchase_count", T.LongType(), False),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("analysis_date", T.DateType(), False),
])

TOP_PRODUCTS_SCHEMA = T.StructType([  # key (analysis_date, rank)
    T.StructField("rank", T.IntegerType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
    T.StructField("total_views", T.LongType(), False),
    T.StructField("unique_viewers", T.LongType(), False),
    T.StructField("avg_price", T.DecimalType(10, 2), True),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("analysis_date", T.DateType(), False),
])

CONVERSION_SCHEMA = T.StructType([  # key (analysis_date, category)
    T.StructField("category", T.StringType(), False),
    T.StructField("total_views", T.LongType(), False),
    T.StructField("total_cart", T.LongType(), False),
    T.StructField("total_purchases", T.LongType(), False),
    T.StructField("conversion_rate", T.DoubleType(), True),
    T.StructField("cart_rate", T.DoubleType(), True),
    T.StructField("purchase_from_cart_rate", T.DoubleType(), True),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("analysis_date", T.DateType(), False),
])

# Views of a product on a day in a form that adds up over days (``plans.sketches``).
PRODUCT_VIEWERS = "product_viewers_daily"
PRODUCT_VIEWERS_SCHEMA = T.StructType([  # key (analysis_date, product_id)
    T.StructField("product_id", T.StringType(), False),
    T.StructField("category", T.StringType(), True),
    T.StructField("total_views", T.LongType(), False),
    T.StructField("price_units", T.DecimalType(38, 0), True),
    T.StructField("n_prices", T.LongType(), False),
    T.StructField("viewers", T.BinaryType(), True),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("analysis_date", T.DateType(), False),
])

# The result-table names the history queries read.
RESULT_TABLES = ["user_segmentation_daily", "top_products_daily",
                 "conversion_rate_daily", "flash_sale_alerts"]


@dataclass(frozen=True)
class AlertParams:
    """Sliding-window alert rule (C1, C3, C7). Defaults are the source's."""
    window: str = DEFAULT_WINDOW
    slide: str = DEFAULT_SLIDE
    watermark: str = DEFAULT_WATERMARK
    min_views: int = DEFAULT_VIEW_THRESHOLD        # alert when views > min_views
    max_purchases: int = DEFAULT_PURCHASE_THRESHOLD  # ... and purchases < max_purchases


# The fixture tables are too small for the source thresholds (no window ever
# reaches 100 views); this rule has non-empty answers at sf0.01 and sf0.1.
FIXTURE_ALERT_PARAMS = AlertParams(window="1 day", slide="1 hour",
                                   watermark="5 minutes", min_views=3, max_purchases=5)
