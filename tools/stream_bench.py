"""Streaming benchmark: generated skewed events replayed through
the alert query with the source's defaults (10 min / 1 min windows, 5 min
watermark), in ``bounded`` and ``exact`` de-dup modes.

Usage: python tools/stream_bench.py [n_events] [files_per_trigger] [cpus]
A tenth of the events is sent twice (producer retries), so the de-dup has
work to do. Prints one JSON line per mode: messages and input rows/s, batches,
batch duration (median / max), state rows of each stateful operator at the end,
and the largest view count among current alerts (equal in both modes: the
retries are dropped).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 1_000_000
    per_trigger = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    cpus = int(sys.argv[3]) if len(sys.argv) > 3 else 8
    from pyspark.sql import functions as F

    from cartpulse.schema import ENVELOPE_SCHEMA, AlertParams
    from cartpulse.session import build_session, work_path
    from tools.generator import GeneratorSpec, generate
    from cartpulse.streaming import alerts as A
    from cartpulse.streaming.emit import to_messages
    from cartpulse.streaming.replay import write_replay

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    # 1M events at 5/s would span 2.3 days; pace them at 20/s over ~14 h so that
    # hourly replay folders give a few dozen micro-batches.
    spec = GeneratorSpec(hot_share=1 / 3, events_per_second=20.0)
    root = work_path(spark, "stream_bench", uuid.uuid4().hex)
    events = generate(spark, n, spec, seed=5, partitions=cpus * 2)
    messages = to_messages(events).select(
        "key", "value", F.lit(0).alias("partition"), F.lit(0).cast("long").alias("offset"),
        F.to_timestamp(F.get_json_object(F.col("value").cast("string"), "$.timestamp"))
        .alias("timestamp"))
    # Producer retries: a tenth of the messages (chosen by a hash of the payload)
    # are sent again 30 seconds later; de-duplication must drop them.
    retried = messages.filter(F.pmod(F.xxhash64("value"), F.lit(10)) == 0) \
        .withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 30 SECONDS"))
    messages = messages.unionByName(retried)
    t0 = time.perf_counter()
    # one replay folder per hour of event time (per day would give 1 batch)
    files = write_replay(spark, messages, f"{root}/replay", folder_format="yyyy-MM-dd-HH")
    write_s = time.perf_counter() - t0
    for mode in ("bounded", "exact"):
        stream = A.read_events(spark, source="parquet", path=f"{root}/replay",
                               max_files_per_trigger=per_trigger)
        stream = stream.select(*ENVELOPE_SCHEMA.fieldNames())
        t0 = time.perf_counter()
        q = A.start_alert_query(A.alert_stream(stream, AlertParams(), mode),
                                A.log_sink(f"{root}/{mode}/log"), f"{root}/{mode}/ck",
                                trigger={"availableNow": True})
        q.awaitTermination()
        wall = time.perf_counter() - t0
        prog = [p for p in q.recentProgress if p.numInputRows > 0]
        durations = [p.durationMs.get("triggerExecution", 0) for p in prog]
        last = q.recentProgress[-1]
        log = A.read_alert_log(spark, f"{root}/{mode}/log")
        hot_views = A.current_alerts(log).agg(F.max("total_views")).first()[0]
        print(json.dumps({
            "mode": mode, "events": n, "messages": sum(p.numInputRows for p in prog),
            "max_alert_views": hot_views,
            "files": files, "replay_write_s": round(write_s, 2),
            "batches": len(prog), "wall_s": round(wall, 2),
            "rows_per_s": round(sum(p.numInputRows for p in prog) / wall, 1),
            "batch_ms_median": statistics.median(durations) if durations else None,
            "batch_ms_max": max(durations) if durations else None,
            "state_rows": {s.operatorName: s.numRowsTotal for s in last.stateOperators},
        }))
    spark.stop()


if __name__ == "__main__":
    main()
