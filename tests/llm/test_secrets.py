import re

from leafline.llm.secrets import ASSIGN, scan_secrets

from .conftest import make_docs, odd_rows

LIVE = "Zq8fJ2mKx9Lw4Rt7Yb3Nc6"
KEY = "AKIA" + "Q2W3E4R5T6Y7U8I9"
TEXTS = [
    (1, f"é漢 password = 'hunter22' and token=token:abcdefgh {KEY}", "en", "a"),
    (2, "secret:ab api_key: \"abcdef1\" ApiKey=ABCDEFG", "en", "a"),
    (3, "x" + "0123456789abcdef" * 2 + "g 0123456789abcdef01234567", "en", "b"),
    (4, f"wide {LIVE} token, again password={LIVE}", "en", "c"),
    (5, KEY, "en", "c"), (6, KEY, "en", "d"), (7, KEY + KEY, "en", None),
    (8, f"only here {LIVE[::-1]} is wide", "en", "e"),
]


def brute(text):
    out = []
    for no, kind, rx, group, least in ((0, "assign", ASSIGN, 2, 6), (1, "access", "AKIA[A-Z0-9]+", 0, 20), (2, "hex", "[0-9a-f]+", 0, 24)):
        out += [(m.start(), no, kind, m.end()) for m in re.finditer(rx, text) if len(m[group]) >= least]
    return sorted(out)


def spans_of(docs):
    _, spans = scan_secrets(docs)
    got = {}
    for r in spans.collect():
        got.setdefault((r["_id"], r["_th"]), []).append(r)
    return got


def test_base_spans_and_ownership(spark):
    got = spans_of(make_docs(spark, TEXTS))
    by_id = {k[0]: v for k, v in got.items()}
    for i, t, _, _ in TEXTS:
        base = sorted((r["start"], r["kind_no"], r["kind"], r["end"]) for r in by_id.get(i, []) if r["base"])
        assert base == brute(t), i
    copied = [r for r in by_id[5] if r["kind"] == "access"][0]
    assert copied["owners"] == 3 and copied["repos"] == 3 and not copied["live"]
    assert [r["live"] for r in by_id[4] if r["kind"] == "assign"] == [True]
    assert [(r["kind"], r["value"]) for r in by_id[4] if not r["base"]] == [("owned", LIVE)]
    assert [r["kind"] for r in by_id[8]] == ["owned"]


def test_odd_rows(spark, odd, none):
    rows, spans = scan_secrets(odd)
    assert rows.count() == len(odd_rows()) and spans.count() == 0
    rows, spans = scan_secrets(none)
    assert rows.count() == 0 and spans.count() == 0


def test_repeated_rows_and_many_matches(spark):
    text = "password=abcdef " * 3000
    got = spans_of(make_docs(spark, [(1, text), (1, text), (None, text)]))
    assert sorted(len(v) for v in got.values()) == [3000, 3000]
    for v in got.values():
        assert sorted((r["start"], 0, "assign", r["end"]) for r in v) == brute(text)


def test_a_value_one_owner_copies_widely_is_no_live_one(spark):
    own = "Zq8vTr2LmK9xWb4NcY7d"
    docs = [(i, f"see {LIVE[::-1]} here", "en", "only") for i in range(30)] + [(50, f"key {own} here", "en", "only")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    _, spans = scan_secrets(frame)
    got = [(r["_id"], r["value"], r["repos"]) for r in spans.collect()]
    assert got == [(50, own, 1)]
