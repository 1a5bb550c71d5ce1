import os
import tempfile

from leafline.sources import io


def test_csv_na_tokens_and_registry(spark):
    d = tempfile.mkdtemp(prefix="leafline-io-")
    p = os.path.join(d, "flat.csv")
    with open(p, "w") as f:
        f.write("name,score,note\nA,1.5,ok\nB,N/A,NULL\nC,abc,nan\nD,,x\n")
    df = io.read_csv_typed(spark, p, numeric=["score"])
    got = {r["name"]: (r["score"], r["note"]) for r in df.collect()}
    assert got == {"A": (1.5, "ok"), "B": (None, None), "C": (None, None), "D": (None, "x")}
    reg = os.path.join(d, "reg.csv")
    with open(reg, "w") as f:
        f.write("school_name,url\n  slug-a ,http://x/a\nslug-b,http://x/b\n")
    assert {r["entity_id"]: r["display_name"] for r in io.load_registry(spark, reg).collect()} == {
        "slug-a": "slug-a", "slug-b": "slug-b"}


def test_text_and_json_scans(spark):
    d = tempfile.mkdtemp(prefix="leafline-io-")
    for name, body in [("a.json", '{"x": 1}'), ("b.json", "{bad"), ("c.txt", "line1\nline2")]:
        with open(os.path.join(d, name), "w") as f:
            f.write(body)
    recs = {r["entity_id"]: r["parse_error"] for r in io.read_json_records(spark, os.path.join(d, "*.json")).collect()}
    assert recs == {"a": None, "b": "invalid_json"}
    texts = io.read_texts(spark, os.path.join(d, "*.txt")).collect()
    assert [(r["entity_id"], r["text"]) for r in texts] == [("c", "line1\nline2")]


def test_table_set_skips_empty(spark):
    d = tempfile.mkdtemp(prefix="leafline-io-")
    full = spark.createDataFrame([(1, "a")], "k long, v string")
    empty = full.where("k < 0")
    man = {r["table_name"]: (r["n_rows"], r["non_empty"]) for r in io.write_table_set({"full": full, "empty": empty}, d).collect()}
    assert man == {"full": (1, True), "empty": (0, False)}
    assert os.path.exists(os.path.join(d, "full")) and not os.path.exists(os.path.join(d, "empty"))
    io.write_csv(full, os.path.join(d, "csv"))
    assert spark.read.option("header", True).csv(os.path.join(d, "csv")).count() == 1


def test_map_entities(spark):
    from leafline.operators.incremental import map_entities

    df = spark.range(10).selectExpr("id", "id * 2 AS v")
    out = map_entities(df, lambda pdf: pdf.assign(v=pdf["v"] + 1), "id long, v long", partitions=3, key="id")
    assert sorted(r["v"] for r in out.collect()) == [2 * i + 1 for i in range(10)]
