"""Per-stage task times from a Spark event log (no UI needed).

Usage: python tools/stage_times.py <event log file or folder> [min_tasks]
Prints one line per stage with at least ``min_tasks`` tasks: task count,
median and max task time, and max/median (a straggler shows as a high ratio).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def _lines(path: str):
    if path.endswith(".zstd"):
        import io

        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh))
    else:
        with open(path) as fh:
            yield from fh


def stage_task_times(path: str) -> dict:
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                   if f.startswith(("events", "eventlog", "local-", "app-"))) \
        if os.path.isdir(path) else [path]
    tasks: dict = defaultdict(list)
    names: dict = {}
    for f in files:
        for line in _lines(f):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                key = (ev["Stage ID"], ev["Stage Attempt ID"])
                tasks[key].append(info["Finish Time"] - info["Launch Time"])
            elif kind == "SparkListenerStageCompleted":
                st = ev["Stage Info"]
                names[(st["Stage ID"], st["Stage Attempt ID"])] = st["Stage Name"]
    return {k: (names.get(k, ""), v) for k, v in tasks.items()}


def main() -> None:
    path = sys.argv[1]
    min_tasks = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    worst = 0.0
    for (stage, attempt), (name, times) in sorted(stage_task_times(path).items()):
        if len(times) < min_tasks:
            continue
        med = statistics.median(times)
        ratio = max(times) / med if med > 0 else float("inf")
        worst = max(worst, ratio if med >= 50 else 0.0)
        print(f"stage {stage:4d}.{attempt} tasks={len(times):4d} median={med:7.0f}ms "
              f"max={max(times):7.0f}ms max/median={ratio:5.1f}  {name[:60]}")
    print(f"worst max/median over stages with median >= 50 ms: {worst:.1f}")


if __name__ == "__main__":
    main()
