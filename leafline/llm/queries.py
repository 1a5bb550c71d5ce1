"""Queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

import importlib

#: query name -> module of this package that defines it
OPERATORS = {
    "op1_html_wrapper": "html_extract",
    "op2_secrets": "secrets",
    "op3_decontamination": "decontamination",
    "op4_near_duplicates": "neardup",
    "op5_warc_segments": "warc",
    "op6_toxicity_kn": "toxicity",
    "op7_shard_lpt": "sharding",
    "op8_mixing": "mixing",
    "op9_winnowing": "winnowing",
    "op10_quality_kn": "quality",
    "op11_url_filter": "url_filter",
    "op12_hard_negatives": "hard_negatives",
    "op13_source_divergence": "divergence",
}


def queries():
    return {
        name: getattr(importlib.import_module(f"leafline.llm.{module}"), name)
        for name, module in OPERATORS.items()
    }


def oracle_sql():
    out = {}
    for module in dict.fromkeys(OPERATORS.values()):
        out.update(getattr(importlib.import_module(f"leafline.llm.{module}"), "ORACLES", {}))
    return out
