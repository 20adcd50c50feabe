"""Seeded synthetic clickstream.

Each field is a function of (event number, seed, field salt) through
``xxhash64``, so the output does not depend on partitioning or task order
(``rand(seed)`` does) and any slice can be regenerated alone. The hot
product takes ``hot_share`` of all events with its own type weights: the
skew the engine must absorb.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.schema import EVENT_TYPES
from cartpulse.sources.feed import (DEVICE_TYPES, EVENT_ID_FORMAT, PAGE_URL_PREFIX,
                                    PRODUCT_ID_FORMAT, SESSION_ID_FORMAT, TIMESTAMP_FORMAT,
                                    USER_ID_FORMAT)

# Fixed values of the source generator: category names, the hot product, and
# its share and type weights (event types and devices: schema.py, feed.py).
CATEGORIES = ["Electronics", "Clothing", "Home & Garden", "Sports", "Books"]
HOT_PRODUCT = "prod_0042"
HOT_CATEGORY = "Electronics"
HOT_SHARE = 0.2
HOT_WEIGHTS = (0.95, 0.04, 0.01)
TYPE_WEIGHTS = (0.70, 0.20, 0.10)
_U53 = 1 << 53


@dataclass(frozen=True)
class GeneratorSpec:
    n_users: int = 500
    n_products: int = 100
    hot_product: str | None = HOT_PRODUCT
    hot_share: float = HOT_SHARE
    hot_weights: tuple = HOT_WEIGHTS
    type_weights: tuple = TYPE_WEIGHTS
    only_views: bool = False
    category: str = "random"           # "random" per event, or "by_product"
    start: str = "2024-01-01 00:00:00"
    events_per_second: float = 5.0
    fields: tuple = field(default=("event_id", "user_id", "product_id", "event_type",
                                   "timestamp", "session_id", "product_category",
                                   "device_type", "page_url", "price"))


# A5: the stream producer; A6: the three daily batch generators.
PRODUCER = GeneratorSpec()
SEGMENTATION_BATCH = GeneratorSpec(n_users=100, n_products=50, hot_product=None,
                                   fields=("user_id", "product_id", "event_type", "timestamp"))
TOP_PRODUCTS_BATCH = GeneratorSpec(only_views=True,
                                   fields=("product_id", "user_id", "event_type", "timestamp",
                                           "product_category", "price"))
CONVERSION_BATCH = GeneratorSpec(category="by_product",
                                 fields=("event_id", "product_id", "user_id", "event_type",
                                         "timestamp", "product_category", "price"))


def _uniform(n: Column, seed: int, salt: int) -> Column:
    """Deterministic U[0, 1) from (event number, seed, salt)."""
    return F.pmod(F.xxhash64(n, F.lit(seed), F.lit(salt)), F.lit(_U53)) / F.lit(float(_U53))


def _pick(values: list[str], u: Column) -> Column:
    idx = (F.floor(u * len(values)) + 1).cast("int")
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def _weighted(values: list[str], weights: tuple, u: Column) -> Column:
    out, acc = None, 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w
        out = (F.when(u < acc, F.lit(v)) if out is None else out.when(u < acc, F.lit(v)))
    return out.otherwise(F.lit(values[-1]))


def synthesize(numbers: DataFrame, spec: GeneratorSpec = PRODUCER, seed: int = 42,
               number_col: str = "id", ts_col: str | None = None) -> DataFrame:
    """Events for each row of ``numbers`` (column ``number_col`` = event number).

    ``ts_col`` takes event times from the input; otherwise they are paced at
    ``events_per_second`` from ``start``.
    """
    n = F.col(number_col)
    hot = (_uniform(n, seed, 1) < spec.hot_share) if spec.hot_product else F.lit(False)
    product_no = (F.floor(_uniform(n, seed, 2) * spec.n_products) + 1).cast("long")
    product = F.when(hot, F.lit(spec.hot_product)) \
        .otherwise(F.format_string(PRODUCT_ID_FORMAT, product_no))
    u_type = _uniform(n, seed, 3)
    if spec.only_views:
        etype = F.lit("view")
    else:
        etype = F.when(hot, _weighted(EVENT_TYPES, spec.hot_weights, u_type)) \
            .otherwise(_weighted(EVENT_TYPES, spec.type_weights, u_type))
    if spec.category == "by_product":
        by_product = F.element_at(F.array(*[F.lit(c) for c in CATEGORIES]),
                                  (F.pmod(F.xxhash64(product), F.lit(len(CATEGORIES))) + 1)
                                  .cast("int"))
        category = F.when(product == F.lit(HOT_PRODUCT), F.lit(HOT_CATEGORY)).otherwise(by_product)
    else:
        category = _pick(CATEGORIES, _uniform(n, seed, 4))
    if ts_col:
        ts = F.col(ts_col).cast("timestamp")
    else:
        ts = F.to_timestamp(F.lit(spec.start)) + F.make_dt_interval(
            secs=(n.cast("double") / F.lit(spec.events_per_second)).cast("decimal(18,6)"))
    user_no = (F.floor(_uniform(n, seed, 5) * spec.n_users) + 1).cast("long")
    cols = {
        "event_id": F.format_string(EVENT_ID_FORMAT, n),
        "user_id": F.format_string(USER_ID_FORMAT, user_no),
        "product_id": product,
        "event_type": etype,
        "timestamp": F.date_format(ts, TIMESTAMP_FORMAT),
        "session_id": F.format_string(
            SESSION_ID_FORMAT, (F.floor(_uniform(n, seed, 6) * 9000) + 1000).cast("long")),
        "product_category": category,
        "device_type": _pick(DEVICE_TYPES, _uniform(n, seed, 7)),
        "page_url": F.concat(F.lit(PAGE_URL_PREFIX), product),
        "price": F.round(F.lit(10.0) + _uniform(n, seed, 8) * F.lit(990.0), 2),
    }
    return numbers.select(*[cols[f].alias(f) for f in spec.fields])


def generate(spark: SparkSession, n: int, spec: GeneratorSpec = PRODUCER, seed: int = 42,
             partitions: int | None = None) -> DataFrame:
    """``n`` synthetic events from ``spark.range``; spread over ``partitions``."""
    return synthesize(spark.range(0, n, 1, partitions), spec, seed)


def paced_stream(spark: SparkSession, rows_per_second: float = 5.0,
                 spec: GeneratorSpec = PRODUCER, seed: int = 42) -> DataFrame:
    """A live stream at a fixed rate from the ``rate`` source."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", str(rows_per_second)).load()
    return synthesize(rate.withColumnRenamed("value", "id"), spec, seed, ts_col="timestamp")
