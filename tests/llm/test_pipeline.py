import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from leafline.llm.common import read_table

from .conftest import make_docs, odd_rows, prose

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]


@pytest.mark.parametrize("name, stage", cp.STAGES)
def test_every_stage_takes_odd_rows_and_empty_tables(spark, odd, none, name, stage):
    out = stage(spark, odd, SF)
    if name != "sharding":
        assert out.columns == odd.columns
        gone = len(odd_rows()) - out.count()
        # near_dedup: the null and empty texts are one class, as are the two copies and the repeated
        # rows; the labels belong to other texts, so toxicity may call any of these toxic
        assert gone <= {"near_dedup": 4, "toxicity": len(odd_rows())}.get(name, 0)
    assert stage(spark, none, SF).count() == 0


def test_near_dedup_keeps_one_of_each_group(spark):
    text = prose(1, 200)
    near = text.replace(text.split()[50], "changed", 1)
    rows = [(5, text), (3, near), (9, text), (3, near), (20, prose(2, 200)), (21, "short one"), (22, "short one")]
    got = sorted(r["doc_id"] for r in cp.near_dedup(spark, make_docs(spark, rows), SF).collect())
    assert got == [3, 20, 21]


def test_decontamination_drops_only_leaks(spark):
    item = read_table(spark, SF, "benchmark").orderBy("item_id").first()["text"]
    rows = [(1, prose(1, 50) + " " + item), (2, prose(1, 50)), (3, None)]
    assert sorted(r["doc_id"] for r in cp.decontaminate(spark, make_docs(spark, rows), SF).collect()) == [2, 3]


def test_mix_keeps_every_document(spark):
    docs = read_table(spark, SF, "documents")
    out = cp.mix(spark, docs, SF)
    assert out.columns == docs.columns
    assert out.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    by = {r["lang"]: (r["a"], r["b"]) for r in docs.groupBy("lang").agg(F.count("*").alias("a")).join(
        out.groupBy("lang").agg(F.count("*").alias("b")), "lang").collect()}
    most = max(by, key=lambda k: by[k][0])
    assert any(b > a for k, (a, b) in by.items() if k != most)


def test_run(spark):
    out = cp.run(spark, SF).collect()
    assert out and {r["shard"] for r in out} <= set(range(16))
