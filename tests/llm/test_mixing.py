import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.llm.mixing import domain_posteriors, fit_rates

from .conftest import make_docs, odd_rows, prose


def brute(p, n, goal, floor, steps):
    """Plain projected gradient with numpy."""
    mass = (n[:, None] * p).sum(0)
    r = np.full(len(n), max(1.0, floor))
    for _ in range(steps):
        s = (r[:, None] * n[:, None] * p).sum(0)
        r = np.maximum(floor, r - p @ ((s - goal) / mass))
    return r


@pytest.mark.parametrize("floor", [0.0, 1.0])
def test_rates_against_numpy(spark, floor):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    n = rng.integers(1, 500, 300)
    df = spark.createDataFrame([(i, i, int(a), [float(x) for x in b]) for i, (a, b) in enumerate(zip(n, p, strict=True))], "_id long, _th long, n long, p array<double>")
    goal = {"a": 0.5, "b": 0.3, "c": 0.2}
    total = float(n.sum()) * (2.0 if floor else 1.0)
    rates, sums = fit_rates(df, ["a", "b", "c"], goal, budget=total, floor=floor, steps=15, tolerance=0.0)
    got = np.array([r["rate"] for r in rates.orderBy("_id").collect()])
    assert got == pytest.approx(brute(p, n, np.array([0.5, 0.3, 0.2]) * total, floor, 15), rel=1e-6)
    for s, t in sums:
        assert s == pytest.approx(t, rel=0.05)


def test_posteriors_and_targets(spark):
    rows = [(i, prose(i, 60, 200) if i % 4 else " ".join("uvwxyz"[k % 6] * 3 + str(k % 9) for k in range(i, i + 40))) for i in range(120)]
    docs = make_docs(spark, rows)
    labels = spark.createDataFrame([(i, "x" if i % 4 == 0 else "y") for i in range(0, 120, 3)] + [(None, "x"), (1, None)], "doc_id long, domain string")
    post, names = domain_posteriors(docs, labels)
    assert names == ["x", "y"]
    got = {r["_id"]: r["p"] for r in post.collect()}
    assert all((got[i][0] > 0.5) == (i % 4 == 0) for i in range(120))
    assert all(sum(p) == pytest.approx(1) for p in got.values())
    rates, sums = fit_rates(post, names)
    assert rates.count() == 120 and rates.where("rate < 0").count() == 0
    assert sums[0][0] == pytest.approx(sums[1][0], rel=0.02)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(6, "b"), (6, "a"), (8, "b")], "doc_id long, domain string")
    post, names = domain_posteriors(odd, labels)
    assert names == ["a", "b"] and post.count() == len(odd_rows())
    twice = post.where("_id = 4").collect()
    assert len(twice) == 2 and twice[0]["p"] == twice[1]["p"] and twice[0]["n"] == 1
    assert post.where(F.col("n") == 0).count() >= 3
    assert fit_rates(post, names, floor=1.0)[0].where("rate < 1").count() == 0
    nobody, alone = domain_posteriors(odd, labels.where("domain = 'z'"))
    assert alone == ["all"] and nobody.count() == len(odd_rows())
    empty, names = domain_posteriors(none, labels)
    assert fit_rates(empty, names)[0].count() == 0
