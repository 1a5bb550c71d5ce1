import os
import tempfile

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from leafline.streaming.incremental import read_results, run_incremental

from .conftest import SF


def test_incremental_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="leafline-inc-")
    src, out, ck = (os.path.join(base, d) for d in ("in", "out", "ck"))
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    first, second = docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1")

    def process(df):
        return df.select("doc_id", F.length("text").alias("n"))

    first.write.parquet(os.path.join(src, "part1"))
    schema = "doc_id long, text string"
    assert run_incremental(spark, src + "/*", schema, out, ck, process) >= 1
    assert run_incremental(spark, src + "/*", schema, out, ck, process) == 0  # nothing new
    second.write.parquet(os.path.join(src, "part2"))
    run_incremental(spark, src + "/*", schema, out, ck, process)
    got = sorted(tuple(r) for r in read_results(spark, out).select("doc_id", "n").collect())
    want = sorted(tuple(r) for r in process(docs).collect())
    assert got == want


def test_entry_and_registry(spark):
    df = entry_mod.entry(spark)
    assert df.count() >= 0 and "support_rate" in df.columns
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(o) <= set(q) and len(q) > 100
