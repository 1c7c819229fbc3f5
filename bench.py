"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of per-query medians, sec), "unit",
"queries": {name: median sec}, "sf"}. Each query is fully computed (``noop`` sink: all
rows produced, nothing collected), 1 warm-up + 3 timed runs, median reported.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from framewise.plans.registry import queries  # noqa: E402
from framewise.session import local_session  # noqa: E402

HEADLINE = ["group_top_sum", "top_k", "group_zscore", "udf_group_apply", "great_circle", "udf_rowwise",
            "join_then_group", "flow_daily_traffic", "flow_party_donations", "multi_agg_shared"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores=cpus, shuffle_partitions=max(8, int(cpus) * 2), app="framewise-bench")
    qs = queries()
    out = {}
    for name in names:
        def run():
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0
        run()  # warm-up (JIT, Python workers, file listing)
        out[name] = round(statistics.median(run() for _ in range(runs)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
