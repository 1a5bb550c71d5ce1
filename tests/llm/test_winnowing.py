import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from leafline.llm import winnowing as wn

from .conftest import make_docs, odd_rows, prose


def brute(text, k=wn.K, w=wn.W):
    words = [x for x in re.split(r"[\W_]+", text.lower()) if x]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in words]
    grams = []
    for i in range(len(h) - k + 1):
        s = 42
        for v in h[i : i + k]:
            s = xxhash.xxh64_intdigest(struct.pack("<Q", v), s)
        grams.append(s & 0xFFFFFFFF)
    out = []
    for j in range(max(1, len(grams) - w + 1)):
        win = grams[j : j + w]
        p = j + max(i for i, v in enumerate(win) if v == min(win))
        if (p, min(win)) not in out:
            out.append((p, min(win)))
    return ",".join(f"{p}:{v:x}" for p, v in out)


def test_against_brute_force(spark):
    texts = [prose(i, n, v) for i, (n, v) in enumerate([(5, 9), (12, 3), (13, 400), (200, 5), (900, 400)])]
    texts += ["a a a a a a a a a a a a a a a a a a a a", "One, two; THREE four-five six.\nseven"]
    docs = make_docs(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r["f"] for r in wn.add_fingerprint(docs, "text").select("doc_id", wn.digest("fp").alias("f")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_match_guarantee(spark):
    shared = prose(99, wn.K + wn.W - 1)
    docs = make_docs(spark, [(1, prose(1, 200) + " " + shared + " " + prose(2, 100)), (2, prose(3, 50) + " " + shared)])
    a, b = [set(r["h"]) for r in wn.add_fingerprint(docs, "text").select(wn.hashes("fp").alias("h")).collect()]
    assert a & b


@pytest.mark.parametrize("buckets", [1, 5])
def test_edited_texts(spark, buckets, monkeypatch):
    monkeypatch.setattr(wn, "BUCKET_ROWS", 10 if buckets > 1 else 10_000)
    rows = [(i * 7 % 101, prose(i, 3 + i % 40)) for i in range(50)]
    got = {r["_k"]: r for r in wn.fingerprint_with_edits(make_docs(spark, rows)).withColumnRenamed("doc_id", "_k").collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for n, (i, t) in enumerate(order):
        nxt = order[(n + 1) % len(order)][1]
        m = len(t) // 3
        assert got[i]["edited"] == t[: len(t) - m] + nxt[:m]


def test_odd_rows(spark, odd, none):
    out = wn.fingerprint_with_edits(odd).select("doc_id", "text", wn.digest("fp").alias("f"), F.size("fp").alias("n")).collect()
    assert len(out) == len(odd_rows())
    by_text = {}
    for r in out:
        assert by_text.setdefault(r["text"], r["f"]) == r["f"]
        assert (r["f"] == "") == (r["text"] == "")
    assert wn.fingerprint_with_edits(none).count() == 0
    one = make_docs(none.sparkSession, [(1, "abcdef")])
    assert wn.fingerprint_with_edits(one).first()["edited"] == "abcdab"


def test_query_values(spark):
    a, b = F.array(F.lit(1), F.lit(2)), F.array(F.lit(2), F.lit(3))
    row = spark.range(1).select(wn.likeness(a, b).alias("x"), wn.likeness(F.array(), F.array()).alias("y")).first()
    assert row["x"] == pytest.approx(1 / 3) and row["y"] == 1.0
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0")


def clauses(seed, n, mark="\uff0c"):
    """Punctuated text of Han, kana or Thai letters, eight to fifteen a clause."""
    rng = random.Random(seed)
    low, high = rng.choice([(0x4E00, 0x9FA5), (0x3042, 0x3093), (0x0E01, 0x0E2E)])
    return mark.join("".join(chr(rng.randint(low, high)) for _ in range(rng.randint(8, 15))) for _ in range(n))


def test_scripts_without_blanks(spark):
    texts = [clauses(i, 3 + i) for i in range(8)]
    texts += [f"{prose(1, 30)} {clauses(9, 2)}{prose(2, 20)}", f"v2{clauses(10, 1, '')}x {clauses(11, 4, ' ')}", clauses(12, 1)]
    docs = make_docs(spark, list(enumerate(texts)))
    got = {r["doc_id"]: r["f"] for r in wn.add_fingerprint(docs, "text").select("doc_id", wn.digest("fp").alias("f")).collect()}
    assert got == {i: brute(re.sub(r"([\u4e00-\u9fa5\u3042-\u3093\u0e01-\u0e2e])", r" \1 ", t)) for i, t in enumerate(texts)}


def test_match_guarantee_without_blanks(spark):
    for seed in range(20, 26):
        shared = clauses(seed, 4).replace("\uff0c", "")[: wn.K + wn.W - 1]
        docs = make_docs(spark, [
            (1, f"{clauses(seed + 10, 9)}{shared}{clauses(seed + 20, 5)}"), (2, f"{prose(seed, 200)} {shared} {prose(seed + 1, 90)}"),
        ])
        a, b = [set(r["h"]) for r in wn.add_fingerprint(docs, "text").select(wn.hashes("fp").alias("h")).collect()]
        assert a & b
