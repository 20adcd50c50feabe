"""Seeded random clickstreams with NULLs and ties: Spark plans vs the DuckDB
oracle SQL of the same analyses (the generic path: category on the event)."""

from datetime import datetime, timedelta

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse import registry
from cartpulse.operators import cleanse as cl
from cartpulse.operators import windows as win
from cartpulse.plans import conversion as conv
from cartpulse.plans import products as prod
from cartpulse.plans import segmentation as seg
from cartpulse.schema import FIXTURE_ALERT_PARAMS
from tools.compare import rows_of

SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("product_category", T.StringType()),
])


def frame(seed: int, n: int = 1500) -> pd.DataFrame:
    rng = np.random.default_rng(seed)

    def pick(values, p_null):
        out = rng.choice(values, n).astype(object)
        out[rng.random(n) < p_null] = None
        return out

    t0 = datetime(2024, 5, 1)
    secs = rng.integers(0, 3 * 86400, n)
    secs[rng.random(n) < 0.1] = 3600  # many identical timestamps: tie handling
    prices = np.round(rng.uniform(-5, 60, n), 2).astype(object)
    prices[rng.random(n) < 0.05] = None
    return pd.DataFrame({
        "event_id": [f"e{i:05d}" for i in range(n)],
        "user_id": pick([f"u{i}" for i in range(25)], 0.05),
        "product_id": pick([f"p{i}" for i in range(6)], 0.05),
        "event_type": pick(["view", "view", "view", "add_to_cart", "purchase", "signup"], 0.05),
        "event_timestamp": [t0 + timedelta(seconds=int(s)) for s in secs],
        "price": prices,
        "product_category": pick(["A", "B", "C"], 0.1),
    })


def spark_side(df):
    counts_day = conv.funnel_counts(df, by_day=True)
    counts_all = conv.funnel_counts(df, by_day=False)
    return {
        "category_conversion_daily": conv.category_conversion(counts_day, by_day=True),
        "category_conversion": conv.category_conversion(counts_all, by_day=False),
        "product_conversion": conv.product_conversion(counts_all),
        "top_conversion_products": conv.top_conversion(conv.product_conversion(counts_all)),
        "bottom_conversion_products": conv.bottom_conversion(conv.product_conversion(counts_all)),
        "conversion_summary": conv.conversion_summary(counts_all),
        "event_type_distribution": conv.event_type_distribution(df),
        "category_distribution": conv.category_distribution(counts_day),
        "user_segments_daily": seg.user_segments(df),
        "segmentation_summary": seg.segmentation_summary(seg.user_segments(df)),
        "segment_sample": seg.segment_sample(seg.user_segments(df)),
        "top_products_daily": prod.top_products(prod.product_view_stats(df)),
        "top_products_overall": prod.top_products(prod.product_view_stats(df, by_day=False),
                                                  by_day=False),
        "top_products_insights": prod.top_products_insights(
            prod.top_products(prod.product_view_stats(df))),
        "top_products_report": prod.top_products_report(
            prod.top_products(prod.product_view_stats(df))),
        "top_viewed_products": prod.top_viewed(df),
        "segment_distribution": seg.segment_distribution(seg.user_segments(df)),
        "segmentation_report": seg.segmentation_report(seg.user_segments(df)),
        "conversion_report": conv.conversion_report(counts_all),
        "flash_sale_alerts": win.flash_sale_alerts(cl.cleanse(df), FIXTURE_ALERT_PARAMS)
        .drop("alert_timestamp").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
        .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")),
    }


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_frames_match_oracle(spark, seed):
    pdf = frame(seed)
    pdf["event_date"] = pd.to_datetime(pdf["event_timestamp"]).dt.date
    sdf = spark.createDataFrame(pdf.drop(columns=["event_date"]), SCHEMA) \
        .withColumn("event_date", F.to_date("event_timestamp"))
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    con.register("rnd", pdf)
    for key, got_df in spark_side(sdf).items():
        sql = registry.ORACLES[key].replace(
            registry.CLICKS_CTE,
            "clicks AS (SELECT event_id, user_id, product_id, event_type, "
            "CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, CAST(price AS DOUBLE) AS price, "
            "product_category, CAST(event_date AS DATE) AS event_date FROM rnd)")
        want = con.execute(sql).df()
        got = got_df.toPandas()
        cols = sorted(got.columns)
        assert cols == sorted(want.columns), key
        assert rows_of(got, cols) == rows_of(want, cols), key


@pytest.mark.parametrize("window,slide", [("10 minutes", "1 minute"), ("1 hour", "15 minutes"),
                                          ("1 day", "1 hour"), ("10 minutes", "3 minutes"),
                                          ("2 hours", "2 hours")])
def test_pane_windows_equal_native_windows(spark, window, slide):
    from cartpulse.schema import AlertParams
    pdf = frame(7, n=800)
    pdf = pdf[pdf["event_timestamp"].notna()]
    sdf = spark.createDataFrame(pdf, SCHEMA)
    params = AlertParams(window=window, slide=slide, min_views=0)
    native = win.window_counts(sdf, params, panes=False)
    panes = win.window_counts(sdf, params, panes=True)
    assert native.count() > 0
    assert native.exceptAll(panes).count() == 0 and panes.exceptAll(native).count() == 0
