"""Same results under 1 and 8 shuffle partitions and reversed input order."""

import pytest
from pyspark.sql import functions as F

from leafline.operators import audit as A
from leafline.operators import text as T
from leafline.operators.features import global_row_number
from leafline.sources.bindings import customer_features, doc_records, doc_texts

from .conftest import SF


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_audit_and_clean_lines_partition_independent(spark):
    out = []
    for parts, desc in ((1, False), (8, True)):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        rec = doc_records(spark, SF)
        txt = doc_texts(spark, SF)
        if desc:
            rec, txt = rec.orderBy(F.desc("doc_id")), txt.orderBy(F.desc("doc_id"))
        rep = A.audit_entity(A.audit_records(rec, txt, "doc_id"), "doc_id").drop("match_types", "unsupported")
        cl = T.clean_lines(txt, "doc_id", "text", T.CleanSpec(end_markers=("Licensed under",), block_start="@"))
        feat = customer_features(spark, SF).select("c_custkey", "rank", "spend", "avg_price", "p1")
        out.append((_rows(rep), _rows(cl), _rows(feat)))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert out[0] == out[1]


@pytest.mark.parametrize("partitions", [4, 8, 37])
def test_global_row_number_beyond_the_sampling_size(spark, partitions):
    n = 24_000
    df = spark.range(n, numPartitions=6).select(
        F.col("id"), (F.xxhash64("id") % 5000).alias("x"), F.md5(F.col("id").cast("string")).alias("extra"), F.rand(3).alias("noise"))
    order = [F.desc("x"), F.asc("id")]
    got = global_row_number(df, order, "pos", partitions).select("id", "x", "pos", "extra").collect()
    want = {r["id"]: i + 1 for i, r in enumerate(sorted(got, key=lambda r: (-r["x"], r["id"])))}
    assert len(got) == n and all(r["pos"] == want[r["id"]] for r in got)
