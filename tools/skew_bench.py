"""Skew benchmark: the batch analyses over generated events in which one
product holds a third of all rows (and its views dominate).

Usage: python tools/skew_bench.py [n_events] [cpus]
Prints one JSON line: seconds per analysis, rows, and the hot share.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 5_000_000
    cpus = int(sys.argv[2]) if len(sys.argv) > 2 else 8
    from pyspark.sql import functions as F

    from cartpulse.operators import cleanse as cl
    from cartpulse.operators import windows as win
    from cartpulse.plans import conversion as conv
    from cartpulse.plans import products as prod
    from cartpulse.plans import segmentation as seg
    from cartpulse.schema import AlertParams
    from cartpulse.session import build_session, work_path
    from tools.generator import GeneratorSpec, generate

    extra = {"spark.driver.memory": "16g"}
    event_log = os.environ.get("SKEW_EVENT_LOG")  # a scratch folder, for tools/stage_times.py
    if event_log:
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus * 2, extra=extra)
    spark.sparkContext.setLogLevel("ERROR")
    spec = GeneratorSpec(hot_share=1 / 3, events_per_second=50.0)
    path = work_path(spark, "skew_bench", str(n))
    t0 = time.perf_counter()
    (generate(spark, n, spec, seed=11, partitions=cpus * 4)
     .select(F.col("event_id"), "user_id", "product_id", "event_type",
             F.to_timestamp("timestamp").alias("event_timestamp"), "price", "product_category")
     .withColumn("event_date", F.to_date("event_timestamp"))
     .write.mode("overwrite").parquet(path))
    gen_s = time.perf_counter() - t0
    ev = spark.read.parquet(path)
    hot = ev.groupBy("product_id").count().orderBy(F.desc("count")).first()

    def timed(build):
        # building may run eager jobs (checkpoints, measured broadcasts): time both
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - t, 3)

    # Two more hot-key shapes on the same rows: one event id repeated on a third
    # of all rows (a replaying producer), and one bot user on a third of all rows.
    third = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    hot_id = ev.withColumn("event_id", F.when(third, F.lit("evt_hot")).otherwise(F.col("event_id")))
    bot = ev.withColumn("user_id", F.when(third, F.lit("user_bot")).otherwise(F.col("user_id")))
    plans = {
        "category_conversion_daily":
            lambda: conv.category_conversion(conv.funnel_counts(ev, by_day=True)),
        "product_conversion":
            lambda: conv.product_conversion(conv.funnel_counts(ev, by_day=False)),
        "user_segments_daily": lambda: seg.user_segments(ev),
        "top_products_daily": lambda: prod.top_products(prod.product_view_stats(ev)),
        "dedup": lambda: cl.deduplicate(cl.validate(ev)),
        "dedup_hot_id": lambda: cl.deduplicate(cl.validate(hot_id)),
        "user_segments_daily_bot": lambda: seg.user_segments(bot),
        "top_products_daily_bot": lambda: prod.top_products(prod.product_view_stats(bot)),
        "window_counts_10m_1m_panes":
            lambda: win.window_counts(ev, AlertParams(min_views=0), panes=True),
        "window_counts_10m_1m_native": lambda: win.window_counts(ev, AlertParams(min_views=0)),
    }
    times = {k: timed(v) for k, v in plans.items()}
    print(json.dumps({"events": n, "cpus": cpus, "hot_product": hot["product_id"],
                      "hot_share": round(hot["count"] / n, 4), "generate_write_s": round(gen_s, 2),
                      "seconds": times}))
    spark.stop()


if __name__ == "__main__":
    main()
