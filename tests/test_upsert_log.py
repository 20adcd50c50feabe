"""The compacted alert log: bounded folders, answers that no crash changes."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartpulse.schema import ALERT_SCHEMA
from cartpulse.streaming import alerts as A

T0 = datetime(2024, 3, 1)


def rows(spark, rng, n=4):
    """Updates of a few windows over three days; a key once in a batch."""
    keys = rng.sample([(p, d) for p in ("p1", "p2", "p3") for d in range(3)], n)
    data = [(p, T0 + timedelta(days=d), T0 + timedelta(days=d, minutes=10), rng.randrange(100),
             rng.randrange(9), 0.0, T0, rng.random() < 0.7) for p, d in keys]
    return spark.createDataFrame(data, ALERT_SCHEMA).coalesce(1)


def answer(log):
    return sorted(tuple(r) for r in A.current_alerts(log).drop("alert_timestamp").collect())


def last_of(batches):
    last = {}
    for batch in batches:
        for r in batch:
            last[r[0], r[1]] = r
    return sorted((*r[:6], r[7]) for r in last.values() if r[7])


def test_folders_stay_bounded(spark, workdir):
    rng, seen, most = random.Random(1), [], 0
    sink = A.log_sink(f"{workdir}/log", run=5, compact_every=10)
    for b in range(60):
        batch = rows(spark, rng)
        seen.append([tuple(r) for r in batch.collect()])
        sink(batch, b)
        log = A.alert_log(spark, f"{workdir}/log")
        most = max(most, len(log.deltas()))
    assert most <= 23  # two rounds of ten and what a round leaves
    assert len(log._list("base")) <= 6 and len(log._list("manifest")) <= 2
    assert answer(A.read_alert_log(spark, f"{workdir}/log")) == last_of(seen)


@pytest.mark.parametrize("step", ["write", "draft", "rename", "clean", "half clean"])
def test_a_compaction_killed_at_any_step_changes_no_answer(spark, workdir, monkeypatch, step):
    from pyspark.sql.readwriter import DataFrameWriter

    from cartpulse.sinks.upsert_log import UpsertLog
    rng, seen = random.Random(step), []
    path = f"{workdir}/log"
    sink = A.log_sink(path, run=5)

    def more(first, last):
        for b in range(first, last):
            batch = rows(spark, rng)
            seen.append([tuple(r) for r in batch.collect()])
            sink(batch, b)

    more(0, 6)
    log = A.alert_log(spark, path)
    log.compact(5, 4)
    more(6, 12)
    want = answer(A.read_alert_log(spark, path))
    assert want == last_of(seen)

    def die(*args, **kwargs):
        raise KeyboardInterrupt(step)

    with monkeypatch.context() as m:
        if step == "write":
            m.setattr(DataFrameWriter, "parquet", die)
        elif step == "draft":
            m.setattr(UpsertLog, "_publish", die)
        elif step == "rename":
            m.setattr(UpsertLog, "_rename", die)
        elif step == "clean":
            m.setattr(UpsertLog, "_clean", die)
        else:
            real, left = UpsertLog._delete, [2]

            def delete(self, *parts):
                left[0] -= 1
                return real(self, *parts) if left[0] >= 0 else die()
            m.setattr(UpsertLog, "_delete", delete)
        with pytest.raises(KeyboardInterrupt):
            log.compact(5, 10)
    assert answer(A.read_alert_log(spark, path)) == want
    # the stream goes on: the batch that was interrupted runs again, then the next
    sink(spark.createDataFrame(seen[-1], ALERT_SCHEMA), 11)
    assert answer(A.read_alert_log(spark, path)) == want
    more(12, 14)
    log.compact(5, 12)
    assert answer(A.read_alert_log(spark, path)) == last_of(seen)
    log.compact(5, 13)
    assert answer(A.read_alert_log(spark, path)) == last_of(seen)
    assert log.deltas() == [(5, 13)] and len(log._list("manifest")) == 2


def test_only_touched_days_are_rewritten(spark, workdir):
    log = A.alert_log(spark, f"{workdir}/log")
    everything = rows(spark, random.Random(3), 9).persist()
    log.append(everything, 1, 0)
    log.compact(1, 0)
    before = log.manifest().days
    log.append(everything.filter(F.to_date("window_start") == F.lit("2024-03-02")), 1, 1)
    log.compact(1, 1)
    after = log.manifest().days
    assert {d for d in after if after[d] != before[d]} == {"2024-03-02"} and len(after) == 3
    assert log.read().count() == 9


def test_a_later_run_outranks_a_folded_one(spark, workdir):
    rng = random.Random(4)
    first, second = rows(spark, rng, 9).persist(), rows(spark, rng, 9).persist()
    A.log_sink(f"{workdir}/log", run=5)(first, 900)
    A.alert_log(spark, f"{workdir}/log").compact(5, 900)
    A.log_sink(f"{workdir}/log", run=6)(second, 0)
    assert answer(A.read_alert_log(spark, f"{workdir}/log")) == last_of([[tuple(r) for r in second.collect()]])
