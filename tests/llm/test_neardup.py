import random
import re
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from leafline.llm import neardup as nd
from leafline.llm import shingles as sh
from leafline.llm.components import components

from .conftest import make_docs, odd_rows, prose


def vary(text, seed, share):
    rng = np.random.default_rng(seed)
    w = text.split()
    for k in rng.choice(len(w), max(1, int(share * len(w))), replace=False):
        w[k] = f"new{seed}x{k}"
    return " ".join(w)


def test_words_and_shingles_against_plain_python():
    texts = ["One two  THREE, four five six", "", "a b", "é漢 x_y 1.5", "one two three four five six", "b a"]
    h, n = sh.words(texts, sh.word_table())
    want = [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    assert n.tolist() == [len(w) for w in want]
    by = defaultdict(set)
    for x, w in zip(h.tolist(), sum(want, []), strict=True):
        by[w].add(x)
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)
    doc, val, tf = sh.shingles(texts, sh.word_table())
    assert np.bincount(doc, minlength=6).tolist() == [2, 0, 1, 1, 2, 1] and tf.tolist() == [1] * 7
    assert val[doc == 0].tolist() == val[doc == 4].tolist() and val[doc == 2][0] != val[doc == 5][0]
    lone = np.concatenate([sh.shingles([t], sh.word_table())[1] for t in texts])
    assert sorted(lone.tolist()) == sorted(val.tolist())


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(3)
    val = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    for overlap in (100, 200, 280):
        wa, wb = rng.gamma(2, 1, 400) + 0.1, rng.gamma(2, 1, 400) + 0.1
        a, b = slice(0, 300), slice(300 - overlap, 400)
        ia, ib = set(range(300)), set(range(300 - overlap, 400))
        both = sum(min(wa[i], wb[i]) for i in ia & ib)
        want = both / (wa[a].sum() + wb[b].sum() - both)
        n = 3000
        sa = nd._samples(np.zeros(300, int), val[a], wa[a], 1, nd.gamma_quantiles(), n)
        sb = nd._samples(np.zeros(100 + overlap, int), val[b], wb[b], 1, nd.gamma_quantiles(), n)
        assert (sa == sb).mean() == pytest.approx(want, abs=0.035)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(f"n{a}", f"n{b}") for a, b in rng.integers(0, 300, (200, 2)) if a != b] + [("hub", f"s{i}") for i in range(200)]
    edges += [(f"p{i:03}", f"p{i + 1:03}") for i in range(60)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert got == {x: find(x) for x in parent}


def test_classes_against_brute_force(spark):
    rows, i = [], 0
    for base in range(25):
        text = prose(base, 120)
        rows.append((i, text))
        i += 1
        for k in range(base % 4):
            rows.append((i, vary(text, i, 0.01) if k else text))
            i += 1
        rows.append((i, vary(text, i, 0.2)))  # far away
        i += 1
    hot = prose(777, 200)
    rows += [(1000 + k, vary(hot, k, 0.005)) for k in range(120)]
    docs = make_docs(spark, rows)
    got = {r["_id"]: r["class_id"] for r in nd.near_duplicates(docs).collect()}

    idf = nd.idf_table(docs.selectExpr("coalesce(text, '') as text"))
    sets = {}
    for d, t in rows:
        _, v, tf = sh.shingles([t], sh.word_table())
        sets[d] = dict(zip(v.tolist(), nd.weigh(v, tf, idf).tolist(), strict=True))
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = sum(min(w, sets[b].get(s, 0)) for s, w in sets[a].items())
            if both >= 0.8 * (sum(sets[a].values()) + sum(sets[b].values()) - both):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert got == {d: find(d) for d in ids}


def test_odd_rows(spark, odd, none):
    got = [(r["_id"], r["class_id"]) for r in nd.near_duplicates(odd).collect()]
    assert len(got) == len(odd_rows())
    assert sorted((c for i, c in got if i == 6)) == [6, 6] and dict(got)[7] == 6
    assert dict(got)[1] == 1 and dict(got)[2] == 1 and dict(got)[5] == 5 and dict(got)[None] is None
    assert nd.near_duplicates(none).count() == 0


def near_threshold(seed):
    """Two texts of weighted Jaccard similarity 0.8027 as a corpus of their own."""
    rng = random.Random(seed)
    a = [f"w{rng.randrange(10**6)}" for _ in range(143)]
    b = list(a)
    for k in (40, 100):
        b[k] = f"v{rng.randrange(10**6)}"
    return " ".join(a), " ".join(b)


def test_link_whose_one_bit_sketches_differ_much(spark):
    # 76 of the 512 bits of the former sketch differ, more than it let through
    out = nd.near_duplicates(make_docs(spark, list(enumerate(near_threshold(0)))))
    assert [r["class_id"] for r in out.collect()] == [0, 0] and "n_links" not in out.columns


def test_blocks_against_brute_force():
    rng = np.random.default_rng(5)
    sets, weights = [], []
    for _ in range(40):
        v = np.sort(rng.choice(30, 24, replace=False)).astype(np.uint64)
        sets.append(v)
        weights.append(rng.choice([1.0, 1.5], len(v)))
    rows = pd.DataFrame({
        "_g": [f"g{i:02}" for i in range(40)], "_c": [f"c{min(i, 35)}" for i in range(40)], "_big": "c35",
        "_own": [i % 2 for i in range(40)], "_set": [s.tobytes() for s in sets], "_w": [w.tobytes() for w in weights],
    })

    def classes(links):
        comp = list(range(40))
        comp[35:] = [35] * 5
        for a, b in links:
            x, y = comp[a], comp[b]
            comp = [min(x, y) if c in (x, y) else c for c in comp]
        return comp

    want = []
    for a in range(40):
        for b in range(a):
            wa, wb = (dict(zip(sets[i].tolist(), weights[i].tolist(), strict=True)) for i in (a, b))
            both = sum(min(w, wb.get(s, 0)) for s, w in wa.items())
            if both >= 0.7 * (sum(wa.values()) + sum(wb.values()) - both):
                want.append((a, b))
    whole = nd._block(rows.assign(_lo=0, _hi=0), 0.7)
    parts = [rows[rows["_own"] == 0].assign(_lo=0, _hi=0), rows[rows["_own"] == 1].assign(_lo=1, _hi=1), rows.assign(_lo=0, _hi=1)]
    dealt = [x for p in parts for x in nd._block(p, 0.7)]
    for found in (whole, dealt):
        found = [(int(a[1:]), int(b[1:])) for a, b in found]
        assert {(max(p), min(p)) for p in found} <= set(want) and classes(found) == classes(want)
    assert 1 < len(set(classes(want))) < 30


def test_a_worker_gives_memory_back_when_its_own_values_are_gone(monkeypatch):
    import weakref

    from leafline.llm import common

    class Held:
        pass

    alive, seen = [], []
    monkeypatch.setattr(common, "give_back", lambda: seen.append([r() is None for r in alive]))

    def work(batches):
        held = Held()
        alive.append(weakref.ref(held))
        for b in batches:
            yield b + 1
        assert held

    assert list(common.giving_back(work)(iter([1, 2]))) == [2, 3]
    assert seen == [[True]]
