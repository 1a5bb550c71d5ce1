import re
from collections import Counter, defaultdict

from leafline.llm.divergence import collapse_texts, source_divergence
from leafline.llm.terms import TERM, pieces
from tests.llm.conftest import make_docs, odd_rows, prose


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, min_docs=3, top=200):
    rows = [(t or "", la or "", s or "") for _, t, la, s in rows]
    docs, counts, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for t, la, s in rows:
        terms = re.findall(TERM, lowered(t))
        counts[la, s].update(terms)
        total[la].update(terms)
        docs[la].update(set(terms))
    out = []
    kept = {la: {w for w, n in docs[la].items() if n >= min_docs} for la in {r[1] for r in rows}}

    def share(c, words):
        n = sum(c[w] for w in words)
        return {w: 1 + 10**9 * (c[w] + 1) // (n + len(words)) for w in words}

    groups = sorted({(la, s) for _, la, s in rows})
    p = {g: share(counts[g], kept[g[0]]) for g in groups}
    for la, s in groups:
        q = share(total[la], kept[la])
        pairs = [(-sum((p[la, s][w] - p[la, o][w]) ** 2 // p[la, o][w] for w in kept[la]), o.encode()) for x, o in groups if x == la and o != s]
        terms = [
            (-((p[la, s][w] - q[w]) ** 2 // q[w]), w.encode())
            for w in kept[la] if counts[la, s][w] > 0 and p[la, s][w] > q[w]
        ]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(la, s, part, item.decode(), -v, i + 1) for i, (v, item) in enumerate(found)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def full(rows):
    return [(*r, "en", "s0") if len(r) == 2 else r for r in rows]


def corpus():
    rows = []
    for i in range(60):
        lang, src = ["en", "fr", None][i % 3], ["a", "b", "c", None, "z\u00e9"][i % 5]
        rows.append((i, prose(i // 2 if i % 4 else 7, 40, 60), lang, src))
    rows += [(100 + i, prose(3, 30, 60), "en", "hot") for i in range(40)]
    rows += [(200, "ÀB àb Ab\u00e9 \u00c9", "en", "a"), (201, "x_y-z 1a2B", "en", "b"), (202, "ab\u00e9", "en", "b"), (203, "AB\u00e9", "en", "b")]
    return rows


def test_equals_brute_force(spark):
    rows = corpus()
    assert rows_of(source_divergence(make_docs(spark, rows).repartition(7))) == brute(rows)


def test_top_terms_and_ties(spark):
    rows = [(i, f"aa bb cc {'dd ee ff' if i % 2 else 'gg hh ii'}", "en", f"s{i % 2}") for i in range(12)]
    assert rows_of(source_divergence(make_docs(spark, rows), top_terms=2)) == brute(rows, top=2)


def test_odd_rows(spark, odd):
    assert rows_of(source_divergence(odd)) == brute(full(odd_rows()))


def test_lang_without_kept_terms(spark):
    rows = [(1, "only once", "xx", "a"), (2, None, "xx", "b"), (3, "", "yy", "c")]
    assert rows_of(source_divergence(make_docs(spark, rows))) == [("xx", "a", "pair", "b", 0, 1), ("xx", "b", "pair", "a", 0, 1)]


def test_empty_table(none):
    assert source_divergence(none).collect() == []


def test_copies_travel_as_one(spark):
    rows = [(i, "same text", "en", f"s{i % 3}") for i in range(30)] + [(99, "same text", "fr", "s0")]
    got = {(r["lang"], tuple(sorted((h["source"], h["n"]) for h in r["holders"]))) for r in collapse_texts(make_docs(spark, rows)).collect()}
    assert got == {("en", (("s0", 10), ("s1", 10), ("s2", 10))), ("fr", (("s0", 1),))}


def test_pieces_are_the_pattern(monkeypatch):
    import leafline.llm.terms as terms

    monkeypatch.setattr(terms, "SLICE_BYTES", 7)
    for t in (prose(1, 300), "A\u00c0b\x7f\x80c \u6f22\u5b57,\u304b@x[y`z{", "", "...", "\x00a\x00B", "one" * 50):
        got = [w.decode() for part in pieces(t.encode()) for w in part]
        assert got == re.findall(TERM, lowered(t))
