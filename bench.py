"""Benchmark: run the headline queries and print one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default HEADLINE).  Each query is fully
evaluated with the ``noop`` sink (no collect to the driver); the time per
query is wall-clock after one warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from leafline.plans import registry  # noqa: E402
from leafline.session import local_session  # noqa: E402

HEADLINE = [
    # audit and records (the reference's own correctness query)
    "audit_entity",
    "audit_summary",
    "validate_leaf",
    "flatten_order_leaves",
    "explode_children",
    # text, links, extraction, incremental runs
    "clean_lines",
    "html_to_text",
    "best_link_row",
    "label_value_extract",
    "run_summary",
    # features, models, clusters, profiles
    "feature_projection",
    "corr_matrix",
    "gap_to_target",
    "kmeans_lloyd",
    "cluster_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus)
    qs = registry.queries()
    names = [n for n in names if n in qs]
    # warm-up: JVM start, first codegen
    qs["label_fallback"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for n in names:
        t0 = time.time()
        qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[n] = round(time.time() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
