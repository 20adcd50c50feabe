"""Hand-made frames for the edge cases of SURVEY §5 / FIXTURES §4."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartpulse.operators import cleanse as cl
from cartpulse.operators import windows as win
from cartpulse.plans import conversion as conv
from cartpulse.plans import products as prod
from cartpulse.plans import segmentation as seg
from cartpulse.schema import AlertParams

CLICK_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.TimestampType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("product_category", T.StringType()),
])

T0 = datetime(2024, 3, 1, 12, 0, 0)


def clicks(spark, rows):
    df = spark.createDataFrame(rows, CLICK_SCHEMA)
    return df.withColumn("event_date", F.to_date("event_timestamp"))


def ev(i, user="u1", product="p1", etype="view", ts=T0, price=10.0, cat="C"):
    return (f"e{i}", user, product, etype, ts, price, cat)


# --- alerts -------------------------------------------------------------------

@pytest.mark.parametrize("views,purchases,alert", [(100, 4, False), (101, 4, True),
                                                     (101, 5, False), (150, 0, True)])
def test_alert_thresholds_are_strict(spark, views, purchases, alert):
    rows = [ev(i, ts=T0 + timedelta(seconds=i)) for i in range(views)]
    rows += [ev(10_000 + i, etype="purchase", ts=T0 + timedelta(seconds=i)) for i in range(purchases)]
    out = win.alert_rule(win.window_counts(clicks(spark, rows), AlertParams()), AlertParams())
    # every window that holds all rows alerts (or none does)
    got = out.filter(F.col("total_views") == views).count() > 0
    assert got == alert


def test_event_on_slide_boundary_is_in_ten_windows(spark):
    counts = win.window_counts(clicks(spark, [ev(1, ts=datetime(2024, 3, 1, 12, 5, 0))]))
    rows = counts.collect()
    assert len(rows) == 10
    starts = sorted(r.window_start for r in rows)
    assert starts[0] == datetime(2024, 3, 1, 11, 56) and starts[-1] == datetime(2024, 3, 1, 12, 5)
    assert all(r.window_end - r.window_start == timedelta(minutes=10) for r in rows)


def test_conversion_rate_unrounded_and_zero_views(spark):
    rows = [ev(1), ev(2), ev(3), ev(4, etype="purchase"),
            ev(5, product="p2", etype="purchase")]
    out = {r.product_id: r for r in win.window_counts(clicks(spark, rows)).collect()}
    assert out["p1"].conversion_rate == pytest.approx(100 / 3)
    assert out["p2"].conversion_rate == 0.0 and out["p2"].total_views == 0


# --- decode and cleanse -----------------------------------------------------------

ENV = T.StructType([T.StructField("value", T.StringType()),
                    T.StructField("partition", T.IntegerType()),
                    T.StructField("offset", T.LongType()),
                    T.StructField("timestamp", T.TimestampType())])

GOOD = ('{"event_id":"evt_1","user_id":"u","product_id":"p","event_type":"view",'
        '"timestamp":"2024-03-01T12:00:00.5Z","price":%s}')


def decoded(spark, values):
    env = spark.createDataFrame([(v, 0, i, T0) for i, v in enumerate(values)], ENV)
    return cl.decode(env)


def test_decode_malformed_null_and_wrong_types(spark):
    rows = decoded(spark, ["{not json", None, GOOD % '"12.5"',
                           '{"event_id": 7, "timestamp": "garbage", "price": 3}']).collect()
    assert rows[0].event_id is None and rows[1].event_id is None
    assert rows[2].event_id == "evt_1" and rows[2].price is None
    assert rows[3].event_id == "7" and rows[3].event_timestamp is None and rows[3].price == 3.0


def test_decode_parses_iso_utc(spark):
    row = decoded(spark, [GOOD % "1"]).collect()[0]
    assert row.event_timestamp == datetime(2024, 3, 1, 12, 0, 0, 500000)
    assert row.kafka_timestamp == T0


@pytest.mark.parametrize("price,kept,high", [(None, False, None), (0.0, False, None),
                                             (-1.0, False, None), (0.01, True, False),
                                             (500.0, True, False), (500.01, True, True)])
def test_price_filter_and_high_value(spark, price, kept, high):
    out = cl.validate(clicks(spark, [ev(1, price=price)])).collect()
    assert (len(out) == 1) == kept
    if kept:
        assert out[0].is_high_value == high
        assert out[0].event_hour == 12 and str(out[0].event_date) == "2024-03-01"


def test_empty_strings_pass_not_null_checks(spark):
    assert cl.validate(clicks(spark, [ev(1, user="")])).count() == 1


def test_dedup_after_filters_keeps_valid_copy(spark):
    rows = [ev(1, price=None, ts=T0), ev(1, price=5.0, ts=T0 + timedelta(seconds=1))]
    out = cl.cleanse(clicks(spark, rows)).collect()
    assert len(out) == 1 and out[0].price == 5.0


def test_dedup_keeps_earliest_of_two_valid(spark):
    rows = [ev(1, price=7.0, ts=T0 + timedelta(seconds=5)), ev(1, price=5.0, ts=T0)]
    out = cl.cleanse(clicks(spark, rows)).collect()
    assert len(out) == 1 and out[0].price == 5.0


# --- rounding and rates -------------------------------------------------------------

def _funnel(spark, rows):
    return conv.funnel_counts(clicks(spark, rows), by_day=False)


def test_half_even_rounding(spark):
    rows = [ev(i, cat="A") for i in range(32)] + [ev(100, etype="purchase", cat="A")]
    rows += [ev(1000 + i, product="p2", cat="B") for i in range(800)]
    rows += [ev(5000, product="p2", etype="purchase", cat="B")]
    out = {r.product_category: r.conversion_rate
           for r in conv.category_conversion(_funnel(spark, rows), by_day=False).collect()}
    assert out == {"A": 3.12, "B": 0.12}


def test_undefined_rates(spark):
    rows = [ev(1, etype="purchase", cat="A"),            # 0 views, purchases
            ev(2, etype="add_to_cart", cat="B"),         # 0 views, no purchases
            ev(3, cat="C"), ev(4, etype="purchase", cat="C")]  # 0 carts
    out = {r.product_category: r for r in
           conv.category_conversion(_funnel(spark, rows), by_day=False).collect()}
    assert out["A"].conversion_rate is None and out["A"].purchase_from_cart_rate == 0.0
    assert out["B"].conversion_rate is None and out["B"].cart_rate is None
    assert out["C"].conversion_rate == 100.0 and out["C"].purchase_from_cart_rate == 0.0


def test_best_worst_follow_sort_order(spark):
    rows = []
    for cat, n_purchase in [("A", 1), ("B", 2), ("C", 1), ("D", 0)]:
        rows += [ev(f"{cat}{i}", cat=cat) for i in range(10)]
        rows += [ev(f"{cat}p{i}", cat=cat, etype="purchase") for i in range(n_purchase)]
    rows += [ev("z", etype="purchase", cat="E")]  # undefined rate: never best or worst
    s = conv.conversion_summary(_funnel(spark, rows)).collect()[0]
    assert (s.best_category, s.best_category_rate) == ("B", 20.0)
    assert (s.worst_category, s.worst_category_rate) == ("D", 0.0)
    assert s.overall_views == 40 and s.overall_purchases == 5


# --- top-k ---------------------------------------------------------------------------

def test_top_five_ties_and_short_result(spark):
    rows = []
    for p, n in [("p1", 5), ("p2", 4), ("p3", 4), ("p4", 3), ("p5", 2), ("p6", 2), ("p7", 1)]:
        rows += [ev(f"{p}-{i}", product=p, user=f"u{i}") for i in range(n)]
    top = prod.top_products(prod.product_view_stats(clicks(spark, rows)), by_day=False)
    got = [(r.rank, r.product_id) for r in top.orderBy("rank").collect()]
    assert got == [(1, "p1"), (2, "p2"), (3, "p3"), (4, "p4"), (5, "p5")]
    short = prod.top_products(prod.product_view_stats(clicks(spark, rows[:9])), by_day=False)
    assert short.count() == 2


def test_product_stats_first_category_avg_price_and_viewers(spark):
    rows = [ev(1, user="a", cat=None, price=5.00, ts=T0),
            ev(2, user="a", cat="Late", price=5.01, ts=T0 + timedelta(seconds=2)),
            ev(3, user="b", cat="Early", price=None, ts=T0 + timedelta(seconds=1)),
            ev(4, user=None, cat="X", price=1.0, ts=T0 + timedelta(seconds=3))]
    r = prod.product_view_stats(clicks(spark, rows), by_day=False).collect()[0]
    assert r.category == "Early"
    assert r.total_views == 3 and r.unique_viewers == 2
    assert r.avg_price == 3.67  # (5.00 + 5.01 + 1.00) / 3 = 3.67


def test_avg_price_exact_half_even_tie(spark):
    rows = [ev(1, price=5.00), ev(2, price=5.01, user="b")]  # mean 5.005 -> 5.00
    r = prod.product_view_stats(clicks(spark, rows), by_day=False).collect()[0]
    assert r.avg_price == 5.0
    rows = [ev(1, price=5.01), ev(2, price=5.02, user="b")]  # mean 5.015 -> 5.02
    assert prod.product_view_stats(clicks(spark, rows), by_day=False).collect()[0].avg_price == 5.02


# --- NULL keys, two categories, empty input -----------------------------------------------

def test_null_keys_dropped_from_groups_but_kept_in_totals(spark):
    rows = [ev(1, user=None), ev(2, product=None), ev(3, cat=None), ev(4, etype=None),
            ev(5, etype="purchase")]
    df = clicks(spark, rows)
    segs = seg.user_segments(df, by_day=False).collect()
    assert len(segs) == 1 and segs[0].total_events == 4 and segs[0].segment == "Buyer"
    cat = conv.category_conversion(_funnel(spark, rows), by_day=False).collect()
    assert len(cat) == 1 and cat[0].total_views == 2 and cat[0].total_events == 3
    s = conv.conversion_summary(_funnel(spark, rows)).collect()[0]
    assert s.overall_views == 3 and s.overall_purchases == 1


def test_product_with_two_categories_gives_two_rows(spark):
    rows = [ev(i, cat="A") for i in range(10)] + [ev(100 + i, cat="B") for i in range(10)]
    out = conv.product_conversion(_funnel(spark, rows)).collect()
    assert sorted(r.product_category for r in out) == ["A", "B"]


def test_unknown_segment(spark):
    rows = [ev(1, etype="signup"), ev(2, user="u2", etype="view")]
    out = {r.user_id: r.segment for r in seg.user_segments(clicks(spark, rows), False).collect()}
    assert out == {"u1": "Unknown", "u2": "Window Shopper"}


def test_empty_input_summary(spark):
    empty = clicks(spark, [])
    s = seg.segmentation_summary(seg.user_segments(empty, False), by_day=False).collect()
    assert len(s) == 1 and s[0].total_users == 0 and s[0].buyer_percentage is None
    c = conv.conversion_summary(_funnel(spark, [])).collect()[0]
    assert c.overall_views == 0 or c.overall_views is None
    assert c.overall_conversion_rate is None and c.best_category is None


def test_approx_unique_viewers_opt_in(spark):
    rows = [ev(i, user=f"u{i % 300}", ts=T0 + timedelta(seconds=i)) for i in range(3000)]
    exact = prod.product_view_stats(clicks(spark, rows), by_day=False).collect()[0]
    approx = prod.product_view_stats(clicks(spark, rows), by_day=False,
                                     approx_rsd=0.02).collect()[0]
    assert exact.unique_viewers == 300
    assert abs(approx.unique_viewers - 300) <= 300 * 0.06
    assert (approx.total_views, approx.avg_price, approx.category) == \
        (exact.total_views, exact.avg_price, exact.category)


def test_insights_highest_price_tie_goes_to_better_rank(spark):
    rows = [ev(f"a{i}", product="pA", user=f"u{i}", price=20.0) for i in range(3)]
    rows += [ev(f"b{i}", product="pB", user=f"u{i}", price=20.0) for i in range(2)]
    rows += [ev(f"c{i}", product="pC", user=f"u{i}", price=30.0) for i in range(1)]
    rows += [ev(f"d{i}", product="pD", user=f"u{i}", price=30.0) for i in range(2)]
    top = prod.top_products(prod.product_view_stats(clicks(spark, rows)), by_day=False)
    ins = prod.top_products_insights(top, by_day=False).collect()[0]
    # ranks: pA 1 (3 views), pB 2, pD 3 (2 views, ties broken by id), pC 4
    assert (ins.most_popular_product, ins.most_popular_views) == ("pA", 3)
    assert (ins.highest_value_product, ins.highest_avg_price) == ("pD", 30.0)
    assert (ins.top_total_views, ins.top_total_viewers) == (8, 8)


def test_exact_rounding_helpers_match_fraction_arithmetic(spark):
    """mean_half_even and half_up_mean against exact rational rounding."""
    import random
    from fractions import Fraction

    from cartpulse.functions.rules import half_up_mean, mean_half_even
    rng = random.Random(11)
    cases = [(rng.randint(-10**9, 10**9), rng.randint(1, 10**4)) for _ in range(2000)]
    cases += [(1001, 2), (1003, 2), (-1001, 2), (-1003, 2), (5, 2), (7, 2), (0, 3), (10, 0)]
    df = spark.createDataFrame(cases, "total long, n long").withColumn(
        "units", F.expr("cast(total as decimal(28,0)) * 100000000"))  # cents to units
    got = df.select("total", "n", mean_half_even("units", "n").alias("even"),
                    half_up_mean("total", "n").alias("up")).collect()

    def even(t, n):  # round half to even, in cents, then to units
        q = Fraction(t, n)
        f = q.numerator // q.denominator
        r = q - f
        up = r > Fraction(1, 2) or (r == Fraction(1, 2) and f % 2 == 1)
        return (f + up) / 100

    for r in got:
        if r.n == 0:
            assert r.even is None
            continue
        assert r.even == even(r.total, r.n), (r.total, r.n)
        if r.total >= 0:  # half_up_mean serves non-negative sums (event counts)
            assert r.up == float(Fraction(int(Fraction(r.total * 100, r.n) + Fraction(1, 2)), 100))


def test_mean_price_is_rounded_once(spark):
    """Sub-cent prices: the mean of the raw prices, not of rounded ones."""
    from cartpulse.functions.rules import mean_half_even, price_units
    prices = [0.004, 0.004, 0.004, 1.2345, 1.2345, 10.333, None]
    df = spark.createDataFrame([(p,) for p in prices], "price double")
    got = df.select(price_units("price").alias("u"), "price").agg(
        F.sum("u").alias("u"), F.count("price").alias("n")).select(mean_half_even("u", "n")).first()[0]
    known = [p for p in prices if p is not None]
    assert got == round(sum(known) / len(known), 2) == 2.14
