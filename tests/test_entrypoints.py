"""Driver-facing entry points: bench.py's one JSON line, the bin/ drivers."""

import json
import os
import subprocess
import sys

from conftest import SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SMALL, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="category_conversion_daily,user_segments_daily")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=900, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["value"] > 0 and res["sf"] == "0.001"
    assert {"category_conversion_daily", "user_segments_daily", "stream_replay"} <= set(res["queries"])


def test_bin_drivers_import():
    for name in ("alert_job", "daily_job", "history", "producer"):
        out = subprocess.run([sys.executable, os.path.join(REPO, "bin", f"{name}.py"), "--help"],
                             env=dict(os.environ, PYTHONPATH=REPO), capture_output=True,
                             text=True, timeout=120)
        assert out.returncode == 0 and "usage:" in out.stdout, name
