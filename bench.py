"""Times the headline queries and prints one JSON line.

Each query runs to the end into a sink that drops its rows; the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from suite import QUERIES  # noqa: E402
from telefold.session import build_session  # noqa: E402

HEADLINE = [
    "fuse_first_present",
    "fuse_range_default",
    "fuse_formula",
    "fuse_full",
    "fuse_scaled_group",
    "fuse_wide_table",
    "device_enrich_left",
    "signal_census",
    "box_summary_price",
    "json_array_explode",
    "value_reconcile",
    "unit_apply",
    "frame_scan_semi",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "bench", master=f"local[{cpus}]", spark__ui__enabled="false",
        spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g", spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    times = {}
    for name in names:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    found = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(found.group(1)) if found else None,
    }))


if __name__ == "__main__":
    main()
