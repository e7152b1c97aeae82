"""The driver contract: entry, queries, oracle_sql, and bench output."""

from __future__ import annotations

import json
import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_schema_is_stable(spark):
    a, b = E.entry(spark), E.entry(spark)
    assert a.schema == b.schema
    assert a.columns == ["model", "param", "rmse", "n", "n_missing"]


def test_oracles_belong_to_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(isinstance(v, str) and v.strip().upper().startswith("WITH") for v in o.values())


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2",
               BENCH_QUERIES="split_nested,tune_bias_clamped")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, cwd="/tmp")
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert out.returncode == 0 and len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and set(d["queries"]) == {"split_nested", "tune_bias_clamped"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01
