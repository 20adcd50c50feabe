"""Event messages: encode clickstream rows as bus messages (A7), and the
fixture feed that exercises decoding and cleansing (B1-B10).

A message is the source's JSON payload keyed by user id, in the envelope a
Kafka source yields (key, value, partition, offset, timestamp). Ids are
rendered the way the source producer renders them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed formats of the source producer's identifiers and payload.
EVENT_ID_FORMAT = "evt_%08d"
USER_ID_FORMAT = "user_%04d"
PRODUCT_ID_FORMAT = "prod_%04d"
SESSION_ID_FORMAT = "session_%d"
PAGE_URL_PREFIX = "/product/"
DEVICE_TYPES = ["mobile", "desktop", "tablet"]
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
BUS_PARTITIONS = 3

# Fault injection of the fixture feed: the first copy of an event whose id
# is divisible by the modulus carries the fault; a second, clean copy of
# every event follows (a producer retry), so de-duplication must pick the
# valid copy. Every event of the table is encoded; nothing is filtered out.
FAULTS = {
    "malformed_json": 43,
    "null_event_id": 47,
    "null_user_id": 17,
    "null_product_id": 19,
    "null_event_type": 23,
    "bad_timestamp": 29,
    "quoted_price": 31,
    "zero_price": 37,
    "negative_price": 41,
}
PRICE_SCALE = 10.0  # fixture values x 10 reach the source's 10..1000 price range


def _fault(event_id: Column, name: str) -> Column:
    return F.pmod(event_id, F.lit(FAULTS[name])) == 0


def _fmt(fmt: str, col: Column) -> Column:
    return F.when(col.isNotNull(), F.format_string(fmt, col))


def payload(ev: DataFrame, faulty: bool | Column, extra: list[str] | None = None) -> DataFrame:
    """Typed clickstream rows (long ids) -> message envelope.

    ``faulty`` (a flag or a per-row condition) applies the FAULTS rules.
    """
    if faulty is False:
        faulty_row = None
    else:
        faulty_row = F.lit(True) if faulty is True else faulty
    eid, uid, pid = F.col("event_id"), F.col("user_id"), F.col("product_id")
    price = F.col("price") * F.lit(PRICE_SCALE)
    fields = {
        "event_id": _fmt(EVENT_ID_FORMAT, eid),
        "user_id": _fmt(USER_ID_FORMAT, uid),
        "product_id": _fmt(PRODUCT_ID_FORMAT, pid),
        "event_type": F.col("event_type"),
        "timestamp": F.date_format("event_timestamp", TIMESTAMP_FORMAT),
        "session_id": _fmt(SESSION_ID_FORMAT, F.lit(1000) + F.pmod(uid, F.lit(9000))),
        "product_category": F.col("product_category"),
        "device_type": F.element_at(F.array(*[F.lit(d) for d in DEVICE_TYPES]),
                                    (F.pmod(eid, F.lit(len(DEVICE_TYPES))) + 1).cast("int")),
        "page_url": F.concat(F.lit(PAGE_URL_PREFIX), _fmt(PRODUCT_ID_FORMAT, pid)),
        "price": price,
    }
    if faulty_row is not None:
        def hit(fault: str) -> Column:
            return faulty_row & _fault(eid, fault)

        def nulled(name: str, fault: str) -> Column:
            return F.when(~hit(fault), fields[name])
        fields["event_id"] = nulled("event_id", "null_event_id")
        fields["user_id"] = nulled("user_id", "null_user_id")
        fields["product_id"] = nulled("product_id", "null_product_id")
        fields["event_type"] = nulled("event_type", "null_event_type")
        fields["timestamp"] = F.when(hit("bad_timestamp"), F.lit("not-a-timestamp")) \
            .otherwise(fields["timestamp"])
        fields["price"] = (F.when(hit("zero_price"), F.lit(0.0))
                           .when(hit("negative_price"), -price)
                           .otherwise(price))
    value = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    if faulty_row is not None:
        value = F.when(hit("quoted_price"),
                       F.regexp_replace(value, r'"price":([^,}]+)', '"price":"$1"')) \
            .otherwise(value)
    msgs = ev.select(
        _fmt(USER_ID_FORMAT, uid).cast("binary").alias("key"),
        value.alias("value_json"),
        F.pmod(uid, F.lit(BUS_PARTITIONS)).cast("int").alias("partition"),
        eid.alias("event_id"),
        F.col("event_timestamp"),
        *[F.col(c) for c in (extra or [])],
        (faulty_row if faulty_row is not None else F.lit(False)).alias("_faulty"),
    )
    # Cut the payload short (not parseable JSON); done on the finished string.
    cut = F.col("_faulty") & _fault(F.col("event_id"), "malformed_json")
    return msgs.withColumn("value_json", F.when(cut, F.substring("value_json", 1, 20))
                           .otherwise(F.col("value_json"))).drop("_faulty")


def encode_messages(clicks: DataFrame) -> DataFrame:
    """A7 serializer: one message per event that carries the row as it is, keyed by
    user id; partition by user, offset = event id."""
    uid = F.col("user_id")
    value = F.to_json(F.struct(
        "event_id", "user_id", "product_id", "event_type",
        F.date_format("event_timestamp", TIMESTAMP_FORMAT).alias("timestamp"),
        "product_category", "price"))
    return clicks.select(
        uid.cast("string").cast("binary").alias("key"), value.cast("binary").alias("value"),
        F.pmod(uid, F.lit(BUS_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("event_timestamp").alias("timestamp"))


def faulty_feed(clicks: DataFrame) -> DataFrame:
    """The fixture feed: a faulty first copy and a clean retry of every event.

    Copy 0 has offset 2*id and arrives at the event time; copy 1 has offset
    2*id + 1 and arrives one second later. Both copies come from one scan:
    each row is doubled by ``explode`` and the fault rules apply to copy 0.
    """
    doubled = clicks.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy"))
    msgs = payload(doubled, faulty=F.col("copy") == 0, extra=["copy"])
    return msgs.select(
        "key", F.col("value_json").cast("binary").alias("value"), "partition",
        (F.col("event_id") * 2 + F.col("copy")).alias("offset"),
        (F.col("event_timestamp") + F.make_dt_interval(secs=F.col("copy"))).alias("timestamp"))
