import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leafline.llm import charkn
from leafline.llm.quality import classify_quality
from leafline.llm.toxicity import fit_curve, score_toxicity

from .conftest import make_docs, odd_rows, prose

LABELS = "doc_id long, quality int, toxic int"


def grams(text):
    t = "\x02" * 4 + text.replace("\0", "\x1a") + "\x03"
    return [t[i : i + 5] for i in range(len(t) - 4)]


def discounts(counts):
    n = [sum(1 for c in counts.values() if c == k) for k in (1, 2, 3, 4)]
    if not all(n):
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return [x if 0 < x < k else z for x, k, z in zip(d, (1, 2, 3), (0.5, 0.75, 0.9), strict=True)]


class Model:
    """Interpolated modified Kneser-Ney, written down plainly."""

    def __init__(self, top, shared, types):
        self.counts = {5: top}
        for k in range(4, 0, -1):
            source = shared if k == 4 else self.counts[k + 1]  # classes may share the lower orders
            self.counts[k] = Counter(g[1:] for g, c in source.items() if c > 0)
        self.d = {k: discounts(c) for k, c in self.counts.items()}
        self.chars = len({g[-1] for g in types}) + 1
        self.by = {k: defaultdict(list) for k in self.counts}
        for k, c in self.counts.items():
            for g, n in c.items():
                self.by[k][g[:-1]].append(n)

    def p(self, g):
        k = len(g)
        if k == 0:
            return 1 / self.chars
        seen, d = self.by[k].get(g[:-1], []), self.d[k]
        if not seen:
            return self.p(g[1:])
        cut = lambda c: d[min(c, 3) - 1]
        total = sum(seen)
        c = self.counts[k].get(g, 0)
        own = max(c - cut(c), 0) if c else 0
        return own / total + sum(cut(c) for c in seen) / total * self.p(g[1:])


TEXTS = [prose(i, 20 + 9 * i, 40) for i in range(8)] + ["", "x", "a\u0000b", "漢字かな é \U0001F600", "zzz ### zzz", "aaaaaaaaaaaaaaa"]


@pytest.fixture(scope="module")
def counted(spark):
    docs = make_docs(spark, list(enumerate(TEXTS)))
    cls = F.when(F.col("doc_id") < 5, 0).when(F.col("doc_id") < 7, 1)
    return docs, {once: charkn.count_grams(docs, cls, 2, once=once).cache() for once in (False, True)}


@pytest.mark.parametrize("once", [False, True])
def test_counts(counted, once):
    _, counts = counted
    got = {r["g"]: (r["n0"], r["n1"], r["n2"]) for r in counts[once].collect()}
    want = defaultdict(lambda: [0, 0, 0])
    for i, t in enumerate(TEXTS):
        for g in set(grams(t)) if once else grams(t):
            want[g][2] += 1
            if i < 7:
                want[g][0 if i < 5 else 1] += 1
    assert got == {g: tuple(c) for g, c in want.items()}


def test_probabilities_against_plain_python(counted):
    _, counts = counted
    counts = counts[False]
    rows = counts.collect()
    top = Counter({r["g"]: r["n0"] for r in rows if r["n0"]})
    own = counts.select("g", F.col("n0").alias("c")).where("c > 0")
    lower = charkn.lower_orders(counts, own).cache()
    p = charkn.interpolate(counts.select("g"), own, lower, 5)
    both = charkn.top_order(counts, ["n0", "n1"], lower).select("g", "p_n0", "p_n1")
    second = Counter({r["g"]: r["n1"] for r in rows if r["n1"]})
    other = Model(second, top, [r["g"] for r in rows])
    for r in both.collect():
        assert r["p_n1"] == pytest.approx(other.p(r["g"]), rel=1e-9)
    assert {r["g"]: pytest.approx(r["p_n0"]) for r in both.collect()} == {r["g"]: r["p"] for r in p.collect()}
    model = Model(top, top, [r["g"] for r in rows])
    got = {r["g"]: r["p"] for r in p.collect()}
    assert len(got) == len(rows)
    for g, x in got.items():
        assert x == pytest.approx(model.p(g), rel=1e-9)


@pytest.mark.parametrize("hot", [0, 50, 100_000])
@pytest.mark.parametrize("once", [False, True])
def test_scores_do_not_depend_on_what_is_hot(spark, counted, hot, once):
    docs, counts = counted
    table = counts[once].select("g", F.col("n2").alias("freq"), (F.xxhash64("g") % 1000 / 7.0).alias("a"))
    value = {r["g"]: r["a"] for r in table.collect()}
    both = docs.unionByName(docs.where("doc_id in (3, 9)"))
    got = charkn.score_documents(both, table, "freq", "a", once=once, excess=(10.0,), hot=hot).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        want = set(grams(TEXTS[r["_id"]])) if once else grams(TEXTS[r["_id"]])
        assert r["n"] == len(want)
        assert r["a"] == pytest.approx(sum(value[g] for g in want), rel=1e-5, abs=1e-4)
        assert r["over0"] == pytest.approx(sum(max(value[g] - 10, 0) for g in want), rel=1e-5, abs=1e-4)


def test_curve():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 2))
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1)))).astype(float)
    w, mean, spread = fit_curve(x, y)
    assert w[0] / spread[0] == pytest.approx(2, abs=0.25) and abs(w[1]) < 0.15


def corpus(n):
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = prose(i, 40, 300).split()
        if bad:
            words[3::9] = [f"vex{w[:2]}ul" for w in words[3::9]]
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if i % 7 == 0 else 1, int(bad)))
    return rows, labels


def test_toxicity_held_out(spark):
    rows, labels = corpus(600)
    got = score_toxicity(make_docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in got if r["held_out"]]
    right = sum(r["predicted"] == labels[r["_id"]][2] for r in held)
    assert len(got) == 600 and len(held) > 80 and right / len(held) > 0.97


def test_quality_held_out(spark):
    rows, labels = corpus(500)
    rows = [(i, t if labels[i][1] else " ".join(w + "***" for w in t.split())) for i, t in rows]
    got = classify_quality(make_docs(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 500 and len(held) > 60
    assert sum(r["keep"] == bool(labels[r["_id"]][1]) for r in held) / len(held) > 0.95


@pytest.mark.parametrize("labels", [[], [(6, 1, 1), (None, 1, 1), (7, None, None), (6, 0, 0), (8, 1, 0)]])
def test_odd_rows(spark, odd, labels):
    table = spark.createDataFrame(labels, LABELS)
    tox = score_toxicity(odd, table).collect()
    assert len(tox) == len(odd_rows()) and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in tox)
    qual = classify_quality(odd, table).collect()
    assert len(qual) == len(odd_rows()) and all(r["perplexity"] > 0 for r in qual)


def test_empty(none, spark):
    table = spark.createDataFrame([(1, 1, 1)], LABELS)
    assert score_toxicity(none, table).count() == 0
    assert classify_quality(none, table).count() == 0


def test_distinct_is_unique():
    import numpy as np

    from leafline.llm.charkn import distinct

    rng = np.random.default_rng(4)
    for values in (rng.integers(0, 50, 1000), rng.integers(0, 1 << 62, 5000), np.zeros(300), np.arange(0), np.arange(700) << 40):
        values = values.astype(np.uint64)
        at, number = distinct(values)
        assert (np.sort(values[at]) == np.unique(values)).all() and (values[at][number] == values).all()
        assert all(values[:k].tolist().count(values[k]) == 0 for k in at[:200])


def test_counter_sends_small_frames_and_holds_little():
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, rng.integers(97, 123, 5_000))) for _ in range(240)]
    batches = [pd.DataFrame({"text": texts[i : i + 80], "cls": np.arange(80) % 2}) for i in range(0, 240, 80)]
    tracemalloc.start()
    rows, total, largest = 0, 0, 0
    for out in charkn._counter(2, True)(iter(batches)):
        rows, total, largest = rows + len(out), total + out["n2"].sum(), max(largest, len(out))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = sum(len({("\x02" * 4 + t + "\x03")[i : i + 5] for i in range(len(t) + 1)}) for t in texts)
    assert total == want
    assert largest <= 50_000 and peak < 110e6


def test_frequent_types_reach_the_driver_as_numbers(spark):
    import tracemalloc

    n = 60_000
    g = F.concat(*[F.char(65 + F.floor(F.col("id") / 26**k) % 26) for k in range(4)], F.lit("\U0001f600"))
    table = spark.range(n).select(g.alias("g"), (F.col("id") % 7 + 1).alias("f"), F.col("id").cast("double").alias("v"))
    charkn.hot_types(table.limit(10), "f", "v", 10)
    tracemalloc.start()
    keys, values = charkn.hot_types(table, "f", "v", n)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120 * n
    order = np.argsort(values)
    cps = np.frombuffer("".join(r["g"] for r in table.orderBy("v").collect()).encode("utf-32-le"), dtype=np.uint32)
    assert (keys[order] == charkn.gram_keys(cps)[::5]).all() and (values[order] == np.arange(n)).all()
    assert (np.diff((values.astype(int) % 7)) >= 0).all()  # by rising frequency
