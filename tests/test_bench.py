"""bench.py prints one JSON line with the expected keys."""

import json
import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_bench_emits_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_REPEAT="1",
               BENCH_QUERIES="word_sources,seed_urls")
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], env=env, capture_output=True, text=True,
                         timeout=600, check=True).stdout.strip().splitlines()
    d = json.loads(out[-1])
    assert d["unit"] == "sec" and set(d["queries"]) == {"word_sources", "seed_urls"}
    assert d["value"] > 0 and d["sf"] == 0.001 and "failed" not in d
