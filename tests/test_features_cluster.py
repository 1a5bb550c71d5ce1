import numpy as np
import pytest
from pyspark.sql import functions as F

from leafline.operators import cluster as C
from leafline.operators import features as E
from leafline.operators import linalg
from leafline.operators import strategy as R


@pytest.fixture(scope="module")
def pts(spark):
    rng = np.random.default_rng(7)
    a = np.vstack([rng.normal(0, 0.3, (40, 2)), rng.normal(3, 0.3, (40, 2)), rng.normal([0, 3], 0.3, (40, 2))])
    rows = [(i, float(x), float(y), float(x * 2 + y + rng.normal(0, 0.1))) for i, (x, y) in enumerate(a)]
    return spark.createDataFrame(rows, "id long, x double, y double, t double"), a


def test_global_row_number(spark, pts):
    df, a = pts
    got = [r["id"] for r in E.global_row_number(df, [F.col("x"), F.col("id")], "pos", partitions=5).orderBy("pos").collect()]
    assert got == list(np.lexsort((np.arange(len(a)), a[:, 0])))


def test_medians_corr_ols(spark, pts):
    df, a = pts
    med = {r["feature"]: r["median"] for r in E.exact_medians(df, ["x", "y"]).collect()}
    assert med["x"] == pytest.approx(np.median(a[:, 0])) and med["y"] == pytest.approx(np.median(a[:, 1]))
    r = E.correlation_long(df, ["x", "y"]).first()["r"]
    assert r == pytest.approx(np.corrcoef(a[:, 0], a[:, 1])[0, 1])
    t = np.array([row["t"] for row in df.orderBy("id").collect()])
    fit = R.fit_linear(df, ["x", "y"], "t")
    X = np.column_stack([np.ones(len(a)), a])
    beta = np.linalg.lstsq(X, t, rcond=None)[0]
    assert fit["intercept"] == pytest.approx(beta[0]) and list(fit["beta"]) == pytest.approx(list(beta[1:]))
    resid = t - X @ np.r_[fit["intercept"], fit["beta"]]
    assert abs(resid @ a[:, 0]) < 1e-6  # residual orthogonal to the columns


def test_standardize_and_cv_folds(spark, pts):
    df, a = pts
    z, params = E.standardize(df, ["x"])
    zx = np.array([r["x"] for r in z.orderBy("id").collect()])
    assert zx.mean() == pytest.approx(0, abs=1e-12) and zx.std() == pytest.approx(1)
    folds = R.cv_folds(df.limit(23), "id", 5).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == [5, 5, 5, 4, 4]


def test_parse_amount(spark):
    vals = ["65,080", "2128 per credit", "$2,128 per credit", "10/20/30", "abc", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(E.parse_amount(F.col("v"))).collect()]
    assert got == [65080.0, 2128 * 60.0, None, 30.0, None, None, None]


def _np_lloyd(a, c, iters):
    for _ in range(iters):
        lab = np.argmin(((a[:, None, :] - c[None]) ** 2).sum(-1), axis=1)
        c = np.array([a[lab == k].mean(0) for k in range(len(c))])
    return c


def test_lloyd_matches_numpy(spark, pts):
    df, a = pts
    init = a[[0, 40, 80]]
    cur, inertia, _ = C.lloyd(df, ["x", "y"], {0: init.tolist()}, max_iter=5, fixed_iterations=True)
    want = _np_lloyd(a, init, 5)
    assert np.allclose(np.array(cur[0]), want)
    lab = np.argmin(((a[:, None, :] - want[None]) ** 2).sum(-1), axis=1)
    assert inertia[0] == pytest.approx(((a - want[lab]) ** 2).sum())


def test_kmeans_fit_and_ari(spark, pts):
    df, a = pts
    centres, _ = C.kmeans_fit(df, "id", ["x", "y"], 3, n_init=3, max_iter=30)
    lab = C.assign(df, ["x", "y"], centres).withColumn("truth", (F.col("id") / 40).cast("int"))
    assert C.adjusted_rand(lab, "cluster", "truth").first()["ari"] == pytest.approx(1.0)
    same = lab.withColumn("perm", (F.col("cluster") + 1) % 3)
    assert C.adjusted_rand(same, "cluster", "perm").first()["ari"] == pytest.approx(1.0)
    runs = lab.withColumn("run", F.lit(1)).unionByName(lab.withColumn("run", F.lit(2)).withColumn("cluster", F.lit(0)))
    got = {r["run"]: r["ari"] for r in C.adjusted_rand(runs, "cluster", "truth", by=["run"]).collect()}
    assert got == {1: pytest.approx(1.0), 2: pytest.approx(0.0)}
    one = lab.withColumn("one", F.lit(0))
    assert C.adjusted_rand(one, "one", "one").first()["ari"] == 1.0


def _brute_dbscan(a, eps, ms):
    n = len(a)
    d = np.sqrt(((a[:, None] - a[None]) ** 2).sum(-1))
    nb = [set(np.nonzero(d[i] <= eps)[0]) for i in range(n)]
    core = [len(nb[i]) >= ms for i in range(n)]
    comp = [-1] * n
    for i in range(n):
        if core[i] and comp[i] == -1:
            stack, comp[i] = [i], i
            while stack:
                u = stack.pop()
                for v in nb[u]:
                    if core[v] and comp[v] == -1:
                        comp[v] = i
                        stack.append(v)
    lab = [comp[i] if core[i] else min((comp[j] for j in nb[i] if core[j]), default=-1) for i in range(n)]
    ids = {c: k for k, c in enumerate(sorted(set(x for x in lab if x >= 0)))}
    return [ids.get(x, -1) for x in lab]


def test_dbscan_matches_brute_force(spark, pts):
    df, a = pts
    got = C.dbscan(df.withColumn("pos", F.col("id")), "id", "pos", ["x", "y"], 0.25, 4)
    got = [r["cluster"] for r in got.orderBy("id").collect()]
    assert got == _brute_dbscan(a, 0.25, 4)


def test_correlation_drop_list_rules():
    rule = E.correlation_drop_list
    assert rule([("a.x", "a.two_yr_avg_x", 0.9)], {}) == [("a.x", "a.two_yr_avg_x")]
    assert rule([("p.us_citizens", "p.overall", 0.9)], {}) == [("p.us_citizens", "p.overall")]
    assert rule([("s.average", "s.low_pay", 0.9)], {}) == [("s.low_pay", "s.average")]
    # only the last part of the name counts for low, high and average
    assert rule([("s.low_pay", "two_year_averages.pay", 0.9)], {"two_year_averages.pay": 3.0}) == [("two_year_averages.pay", "s.low_pay")]
    assert rule([("m", "n", 0.9)], {"m": 2.0, "n": 1.0}) == [("m", "n")]
    # a tie drops the second; a dropped column decides no further pair
    assert rule([("m", "n", 0.99), ("n", "o", 0.95), ("m", "o", 0.9)], {}) == [("n", "m"), ("o", "m")]


def test_adjusted_rand_of_a_single_row(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert C.adjusted_rand(df, "a", "b").first()["ari"] == 1.0


def test_kth_neighbour_loses_no_row(spark):
    from leafline.operators.pivots import kth_distance

    far = spark.createDataFrame([(i, float(i) ** 6, 0.0) for i in range(12)], "id long, x double, y double")
    got = {r["id"]: r["k_distance"] for r in kth_distance(far, "id", ["x", "y"], 3).collect()}
    xs = [float(i) ** 6 for i in range(12)]
    assert got == {i: pytest.approx(sorted(abs(x - v) for v in xs)[2]) for i, x in enumerate(xs)}
    few = kth_distance(far.limit(2), "id", ["x", "y"], 3).collect()
    assert len(few) == 2 and all(r["k_distance"] is None for r in few)
