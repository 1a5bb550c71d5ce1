"""All registered queries: key -> (spark builder, DuckDB oracle SQL or None).

Each plan module exposes ``QUERIES`` (key -> callable(spark, sf_dir) ->
DataFrame) and ``ORACLES`` (key -> SQL over the pre-registered views).
"""

from __future__ import annotations

import importlib

PLAN_MODULES = [
    "leafline.plans.audit_plans",
    "leafline.plans.text_plans",
    "leafline.plans.extract_plans",
    "leafline.plans.analysis_plans",
    "leafline.plans.cluster_plans",
]


def _load():
    queries, oracles = {}, {}
    for name in PLAN_MODULES:
        m = importlib.import_module(name)
        for k, fn in m.QUERIES.items():
            if k in queries:
                raise ValueError(f"duplicate query key {k}")
            queries[k] = fn
        oracles.update(getattr(m, "ORACLES", {}))
    missing = set(oracles) - set(queries)
    if missing:
        raise ValueError(f"oracles without queries: {sorted(missing)}")
    return queries, oracles


def queries():
    return _load()[0]


def oracle_sql():
    return _load()[1]
