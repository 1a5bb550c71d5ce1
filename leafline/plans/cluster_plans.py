"""Registered queries for groups C (clustering/validity), P (peer
profiling) and the cluster-dependent R16/R17.

The SQL-checkable clustering is Lloyd's algorithm from deterministic
initial centres (the entities at evenly spaced rank positions) for a fixed
number of iterations; the k-means++ multi-restart fit and the stability
statistics are seeded and checked by invariants in pytest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.operators import cluster as C
from leafline.operators import features as E
from leafline.operators import multirun as M
from leafline.operators import profile as P
from leafline.operators import strategy as R
from leafline.plans.analysis_plans import DENSE, FEAT_SQL, FOCUS
from leafline.operators.pivots import kth_distance
from leafline.session import checkpoint_dir, materialise
from leafline.sources.bindings import customer_features

KEY = "c_custkey"
CL = ["n_orders", "avg_price", "lo", "hi", "c_acctbal"]
K = 5
ITERS = 8
EPS, MIN_SAMPLES = 0.8, 5
SWEEP = [0.6, 0.8, 1.1]
#: sizes of the searches: k, restarts, reference sets, bootstrap draws and their restarts, left-out rows
K_RANGE, N_INIT, B, DRAWS, RESTARTS, LOO = range(2, 16), 50, 50, 100, 20, 20


def _z(spark, sf):
    """Standardised clustering input, checkpointed (iterative jobs reread it)
    into the shared folder the session names in spark.checkpoint.dir."""
    checkpoint_dir(spark)
    f = customer_features(spark, sf)
    z, _ = E.standardize(f.select(KEY, "c_name", "c_mktsegment", "rank", *CL), CL)
    return z.checkpoint()


def _positions(n: int, k: int, alt: bool = False) -> list[int]:
    if alt:
        return [n * (i + 1) // (k + 1) + 1 for i in range(k)]
    return [n * (2 * i + 1) // (2 * k) + 1 for i in range(k)]


def _fixed(z, alt: bool = False):
    n = z.count()
    pos = _positions(n, K, alt)
    init = [[float(r[c]) for c in CL] for r in z.where(F.col("rank").isin(pos)).orderBy("rank").collect()]
    cur, inertia, _ = C.lloyd(z, CL, {0: init}, max_iter=ITERS, fixed_iterations=True)
    a = C.assign(z, CL, cur[0])
    return C.relabel_by_rank(a, "cluster", "rank"), inertia[0]


def _assigned(spark, sf, alt=False):
    z = _z(spark, sf)
    a, _ = _fixed(z, alt)
    raw = customer_features(spark, sf).select(KEY, *DENSE, "c_acctbal")
    return z, a, a.select(KEY, "c_name", "rank", "cluster_id").join(raw, KEY)


def _focus_ids(a):
    row = a.where(F.col("c_name") == FOCUS).select("cluster_id").first()
    if row is None:  # no focus, no cluster: an id that none has
        return -1, -1
    return row["cluster_id"], max(0, row["cluster_id"] - 1)


def q_kmeans_lloyd(spark, sf):
    _, a, _ = _assigned(spark, sf)
    return a.select(KEY, "rank", "cluster_id")


def q_kmeans_inertia(spark, sf):
    z = _z(spark, sf)
    _, inertia = _fixed(z)
    return spark.createDataFrame([(round(inertia, 4),)], "inertia double")


def _fit(z, ks=(K,)):
    """C1 as the final clustering runs it: best of 50 cold starts for each k, all in shared passes."""
    fits = M.fit_best(M.points(z, KEY, CL), [(0, k, N_INIT) for k in ks], max_iter=500)
    return {k: fits[0, k] for k in ks}


def q_kmeans_fit(spark, sf):
    z = _z(spark, sf)
    centres, inertia = _fit(z)[K]
    a = C.relabel_by_rank(C.assign(z, CL, centres), "cluster", "rank")
    return a.select(KEY, "rank", "cluster_id", F.lit(float(inertia)).alias("inertia"))


def q_inertia_curve(spark, sf):
    rows = C.inertia_curve(_z(spark, sf), KEY, CL, K_RANGE, n_init=N_INIT, max_iter=500)
    return spark.createDataFrame(rows, "k int, inertia double")


def q_gap_statistic(spark, sf):
    """B reference sets, 20 restarts on the data and 10 on each set, for each k."""
    rows = C.gap_inertias(_z(spark, sf), KEY, CL, K_RANGE, B)
    inert = spark.createDataFrame(rows, "k int, ref_set int, inertia double")
    gaps = C.gap_from_inertias(inert, B)
    return gaps.withColumn("k_gap", F.lit(C.gap_rule(gaps).first()["k_gap"]))


def q_relabel_by_rank(spark, sf):
    _, a, _ = _assigned(spark, sf)
    return a.groupBy("cluster_id").agg(F.avg("rank").alias("mean_rank")).select("cluster_id", F.round("mean_rank", 6).alias("mean_rank"))


def q_cluster_info(spark, sf):
    _, a, _ = _assigned(spark, sf)
    i = C.cluster_info(a, "cluster_id", "rank")
    return i.select("cluster_id", "n", F.round("mean_rank", 6).alias("mean_rank"), "min_rank", "max_rank")


def q_cluster_names(spark, sf):
    _, a, _ = _assigned(spark, sf)
    return C.cluster_names(C.cluster_info(a, "cluster_id", "rank"))


def q_cluster_assignments(spark, sf):
    _, a, _ = _assigned(spark, sf)
    names = C.cluster_names(C.cluster_info(a, "cluster_id", "rank"))
    return a.join(names, "cluster_id").select(KEY, "rank", "cluster_id", "cluster_name").orderBy("cluster_id", "rank")


def _two_labelings(spark, sf):
    z = _z(spark, sf)
    a, _ = _fixed(z)
    b, _ = _fixed(z, alt=True)
    return a.select(KEY, "rank", F.col("cluster_id").alias("a")).join(b.select(KEY, F.col("cluster_id").alias("b")), KEY)


def q_adjusted_rand(spark, sf):
    return C.adjusted_rand(_two_labelings(spark, sf), "a", "b").select(F.round("ari", 6).alias("ari"))


def q_adjusted_rand_segment(spark, sf):
    _, a, _ = _assigned(spark, sf)
    return C.adjusted_rand(a, "cluster_id", "c_mktsegment").select(F.round("ari", 6).alias("ari"))


def q_match_rate(spark, sf):
    return C.match_rate(_two_labelings(spark, sf), "a", "b").select(F.round("match_rate", 6).alias("match_rate"))


def q_disagreements(spark, sf):
    return _two_labelings(spark, sf).where(F.col("a") != F.col("b")).orderBy("rank").select(KEY, "rank", "a", "b")


def q_dbscan_labels(spark, sf):
    """C20 over the whole standardised matrix."""
    return C.dbscan(_z(spark, sf).select(KEY, "rank", *CL), KEY, "rank", CL, EPS, MIN_SAMPLES)


def q_dbscan_sweep(spark, sf):
    """Clusters and outliers for several eps from one search for pairs and one
    propagation loop; outlier keys listed when there are 1 to 10."""
    lab = C.dbscan(_z(spark, sf).select(KEY, "rank", *CL), KEY, "rank", CL, SWEEP, MIN_SAMPLES)
    lab = materialise(lab, "dbscan-sweep")
    sizes = lab.groupBy("eps").agg(
        F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"),
        F.count_if(F.col("cluster") == -1).alias("n_outliers"),
    )
    few = sizes.where(F.col("n_outliers").between(1, 10)).select("eps")
    named = lab.where("cluster = -1").join(F.broadcast(few), "eps").groupBy("eps").agg(
        F.array_join(F.array_sort(F.collect_list(KEY)).cast("array<string>"), ",").alias("outliers")
    )
    return sizes.join(named, "eps", "left").select("eps", "n_clusters", "n_outliers", "outliers")


def _base(z):
    """The final clustering: ``z`` with ``cluster_id`` by mean rank."""
    return C.relabel_by_rank(C.assign(z, CL, _fit(z)[K][0]), "cluster", "rank")


def q_bootstrap_stability(spark, sf):
    """Draws of n rows with replacement, each clustered anew from cold starts
    and compared with the final clustering on the rows it drew."""
    base = _base(_z(spark, sf)).select(KEY, "cluster_id", *CL)
    pts = M.points(M.bootstrap_draws(base, KEY, DRAWS), KEY, CL, F.col("draws"), F.col("cluster_id"))
    fits = M.fit_best(pts, [(d, K, RESTARTS) for d in range(DRAWS)])
    cont = M.contingency(pts, {d: centres for (d, _), (centres, _) in fits.items()})
    aris = C.adjusted_rand(cont, "label", "cluster", F.col("w"), by=["run"])
    s = aris.agg(F.round(F.avg("ari"), 6).alias("mean_ari"), F.round(F.stddev_pop("ari"), 6).alias("std_ari"), F.count("*").alias("draws"))
    return s.withColumn("grade", C.stability_grade(F.col("mean_ari")))


def q_loo_stability(spark, sf):
    """Share of the focus cluster that stays with the focus when one other row is
    left out, for 20 rows; each time clustered anew from cold starts."""
    z = _z(spark, sf)
    order = C.uniform_hash(F.col(KEY).cast("string"), seed=123)
    dropped = [r[0] for r in z.where(F.col("c_name") != FOCUS).orderBy(order, KEY).select(KEY).limit(LOO).collect()]
    base = _base(z)
    pts = M.points(base, KEY, CL, M.left_out(F.col(KEY), dropped), F.col("cluster_id"))
    fits = M.fit_best(pts, [(i, K, RESTARTS) for i in range(len(dropped))])
    focus = base.where(F.col("c_name") == FOCUS).select("cluster_id", *CL).first()
    own, at = (focus["cluster_id"], [focus[c] for c in CL]) if focus else (-1, [0.0] * len(CL))
    near = [(i, int(((c - at) ** 2).sum(axis=1).argmin())) for (i, _), (c, _) in fits.items()]
    near = F.broadcast(spark.createDataFrame(near, "run int, cluster int"))  # one row per left-out row
    kept = M.contingency(pts, {i: c for (i, _), (c, _) in fits.items()}).join(near, ["run", "cluster"]).where(F.col("label") == own)
    n = base.where(F.col("cluster_id") == own).count()
    per = kept.select((F.col("w") / F.lit(max(n, 1))).alias("overlap"))
    return per.agg(F.round(F.avg("overlap"), 6).alias("mean_overlap"), F.round(F.min("overlap"), 6).alias("min_overlap"), F.count("*").alias("runs"),
                   F.count_if(F.col("overlap") > 0.7).alias("stable_runs"))


def _member_centres(z, a):
    rows = _centroids(z, a).orderBy("cluster_id").collect()
    return [[float(r[c]) for c in CL] for r in rows]


def q_centroid_silhouette(spark, sf):
    z, a, _ = _assigned(spark, sf)
    za = z.join(a.select(KEY, "cluster_id"), KEY)
    s = C.centroid_silhouette(za, CL, _member_centres(z, a), "cluster_id")
    return s.select(KEY, "cluster_id", F.round("silhouette", 6).alias("silhouette"))


def q_centroid_silhouette_score(spark, sf):
    return q_centroid_silhouette(spark, sf).agg(F.round(F.avg("silhouette"), 4).alias("score"))


def q_focus_silhouette(spark, sf):
    s = q_centroid_silhouette(spark, sf).join(customer_features(spark, sf).select(KEY, "c_name"), KEY)
    own = s.where(F.col("c_name") == FOCUS).select("cluster_id")
    agg = s.agg(F.max(F.when(F.col("c_name") == FOCUS, F.col("silhouette"))).alias("focus"),
                F.round(F.avg("silhouette"), 4).alias("overall"))
    clus = s.join(own, "cluster_id").agg(F.round(F.avg("silhouette"), 4).alias("focus_cluster_mean"))
    return agg.withColumn("_k", F.lit(1)).join(clus.withColumn("_k", F.lit(1)), "_k").drop("_k")


def q_candidate_k(spark, sf):
    """K-means++ fits for k = 5, 6, 7 in shared passes; the k with the
    best centroid silhouette (first on ties); the focus cluster per k."""
    z = _z(spark, sf)
    fits = _fit(z, (5, 6, 7))
    rows = []
    for k in (5, 6, 7):
        a = C.relabel_by_rank(C.assign(z, CL, fits[k][0]), "cluster", "rank")
        cen = [[float(r[c]) for c in CL] for r in z.join(a.select(KEY, "cluster_id"), KEY).groupBy("cluster_id")
               .agg(*[F.avg(c).alias(c) for c in CL]).orderBy("cluster_id").collect()]
        sil = C.centroid_silhouette(a.drop("cluster").withColumnRenamed("cluster_id", "cluster"), CL, cen, "cluster")
        r = sil.agg(F.avg("silhouette").alias("s"), F.max(F.when(F.col("c_name") == FOCUS, F.col("cluster"))).alias("fc")).first()
        rows.append((k, float(r["s"]), r["fc"]))
    df = spark.createDataFrame(rows, "k int, score double, focus_cluster int")
    best = C.best_k(df).first()["best_k"]
    return df.withColumn("chosen", F.col("k") == best)


def q_k_distance(spark, sf):
    """C19 over the whole standardised matrix: m = min(2p + 1, 10), the point itself
    counted; sorted descending."""
    kd = kth_distance(_z(spark, sf).select(KEY, *CL), KEY, CL, min(2 * len(CL) + 1, 10))
    return kd.select(KEY, F.round("k_distance", 6).alias("k_distance")).orderBy(F.desc("k_distance"), KEY)


def q_aspiration_cluster(spark, sf):
    _, a, _ = _assigned(spark, sf)
    f = a.where(F.col("c_name") == FOCUS)
    return f.select(KEY, "cluster_id", F.greatest(F.lit(0), F.col("cluster_id") - 1).alias("aspiration"))


def q_projection_2d(spark, sf):
    z, a, _ = _assigned(spark, sf)
    scored, _ = E.pca_scores(z, CL, 2)
    j = scored.select(KEY, "pc1", "pc2").join(a.select(KEY, "c_name", "rank", "cluster_id"), KEY)
    return j.select(KEY, F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"), "cluster_id",
                    (F.col("c_name") == FOCUS).alias("is_focus"), F.col("rank").between(45, 55).alias("in_band"))


# ------------------------------------------------------------------ P and R16/R17

def q_cluster_profile(spark, sf):
    _, _, raw = _assigned(spark, sf)
    p = P.cluster_profile(raw, "cluster_id", "rank", DENSE)
    return p.select("cluster_id", "n", "rank_range", F.round("mean_rank", 6).alias("mean_rank"),
                    *[F.round(c, 4).alias(c) for c in DENSE])


def q_profile_transposed(spark, sf):
    _, _, raw = _assigned(spark, sf)
    p = P.cluster_profile(raw, "cluster_id", "rank", DENSE)
    p = p.select("cluster_id", *[F.round(c, 4).alias(c) for c in DENSE])
    return P.profile_transposed(p, "cluster_id", DENSE + ["not_a_column"], {"n_orders": "orders"})


def q_peer_list(spark, sf):
    _, a, _ = _assigned(spark, sf)
    own, asp = _focus_ids(a)
    peers = P.peer_list(a, "cluster_id", "rank", own).select(KEY, "rank", F.lit("peer").alias("list"))
    aspire = P.peer_list(a, "cluster_id", "rank", asp).select(KEY, "rank", F.lit("aspiration").alias("list"))
    return peers.unionByName(aspire)


def _centroids(z, a):
    return z.join(a.select(KEY, "cluster_id"), KEY).groupBy("cluster_id").agg(*[F.avg(c).alias(c) for c in CL])


def q_centroid_distance(spark, sf):
    z, a, _ = _assigned(spark, sf)
    own, asp = _focus_ids(a)
    point = z.join(a.select(KEY, "c_name"), [KEY, "c_name"]).where(F.col("c_name") == FOCUS).select(*CL)
    d = P.centroid_distance(point, _centroids(z, a), "cluster_id", CL, own, asp)
    return d.select(*[F.round(c, 6).alias(c) for c in ("dist_own", "dist_aspiration", "ratio")])


def q_peer_comparison(spark, sf):
    _, a, raw = _assigned(spark, sf)
    own, asp = _focus_ids(a)
    pc = P.peer_comparison(raw, "cluster_id", F.col("c_name") == FOCUS, own, asp, DENSE)
    return pc.select("feature", *[F.round(c, 4).alias(c) for c in ("focus", "peer_mean", "aspiration_mean", "vs_peer", "vs_aspiration")])


#: metric dictionary: set, shown name, feature; the last set names a feature the table lacks
METRICS = [
    ("volume", "Orders (count)", "n_orders"),
    ("volume", "Spend (total)", "spend"),
    ("price", "Mean price", "avg_price"),
    ("price", "Lowest price", "lo"),
    ("price", "Highest price", "hi"),
    ("balance", "Spend (total)", "spend"),
    ("balance", "Credit limit", "credit_limit"),
]


def q_metric_set_tables(spark, sf):
    rows = [(s, i, m, f) for i, (s, m, f) in enumerate(METRICS)]
    metrics = spark.createDataFrame(rows, "metric_set string, place bigint, metric string, feature string")
    return P.metric_set_tables(q_peer_comparison(spark, sf), metrics)


def q_position_label(spark, sf):
    _, a, raw = _assigned(spark, sf)
    own, asp = _focus_ids(a)
    pc = P.peer_comparison(raw, "cluster_id", F.col("c_name") == FOCUS, own, asp, DENSE)
    inv = F.col("feature") == "lo"
    lab = F.when(inv, P.position_label(F.col("focus"), F.col("peer_mean"), inverted=True)).otherwise(
        P.position_label(F.col("focus"), F.col("peer_mean")))
    return pc.select("feature", lab.alias("position"))


def q_radar_normalized(spark, sf):
    _, _, raw = _assigned(spark, sf)
    r = P.radar_normalized(raw.select(KEY, *DENSE), DENSE, inverted=["lo"], scale=1.0)
    return r.select(KEY, *[F.round(c, 6).alias(c) for c in DENSE])


def q_peer_ranking(spark, sf):
    _, a, raw = _assigned(spark, sf)
    own, _ = _focus_ids(a)
    r = P.peer_ranking(raw, "cluster_id", own, "spend")
    return r.select(KEY, "spend", F.round("peer_mean", 4).alias("peer_mean"))


def q_columns_by_pattern(spark, sf):
    f = customer_features(spark, sf)
    cols = P.columns_by_pattern(f, "^p[0-9]", "f$")
    long = E.unpivot(f, cols)
    return long.groupBy(F.col("feature").alias("column_name")).agg(
        F.count("value").alias("n_values"), F.round(F.min("value"), 4).alias("least"), F.round(F.max("value"), 4).alias("most"))


def q_peer_gap(spark, sf):
    _, a, raw = _assigned(spark, sf)
    own, _ = _focus_ids(a)
    r = P.peer_ranking(raw, "cluster_id", own, "spend")
    return r.select(KEY, F.round(F.col("spend") - F.col("peer_mean"), 4).alias("gap_to_peer_mean"))


def q_distance_contribution(spark, sf):
    z, a, _ = _assigned(spark, sf)
    _, asp = _focus_ids(a)
    point = z.where(F.col("c_name") == FOCUS).select(*CL)
    cen = _centroids(z, a).where(F.col("cluster_id") == asp).select(*CL)
    d = R.distance_contribution(point, cen, CL)
    return d.select("feature", F.round("sq", 6).alias("sq"), F.round("pct", 4).alias("pct"), "direction")


def q_boundary_entities(spark, sf):
    z, a, _ = _assigned(spark, sf)
    own, asp = _focus_ids(a)
    cen = _centroids(z, a).where(F.col("cluster_id") == asp).first()
    centre = [cen[c] for c in CL] if cen else [0.0] * len(CL)
    members = z.join(a.select(KEY, "cluster_id"), KEY).where(F.col("cluster_id") == own)
    d = F.sqrt(C.sqdist_expr(CL, centre))
    return members.select(KEY, "rank", F.round(d, 6).alias("dist")).orderBy("dist", KEY).limit(10)


QUERIES = {
    "kmeans_lloyd": q_kmeans_lloyd,
    "kmeans_inertia": q_kmeans_inertia,
    "kmeans_fit": q_kmeans_fit,
    "inertia_curve": q_inertia_curve,
    "gap_statistic": q_gap_statistic,
    "relabel_by_rank": q_relabel_by_rank,
    "cluster_info": q_cluster_info,
    "cluster_names": q_cluster_names,
    "cluster_assignments": q_cluster_assignments,
    "adjusted_rand": q_adjusted_rand,
    "adjusted_rand_segment": q_adjusted_rand_segment,
    "match_rate": q_match_rate,
    "disagreements": q_disagreements,
    "dbscan_labels": q_dbscan_labels,
    "dbscan_sweep": q_dbscan_sweep,
    "bootstrap_stability": q_bootstrap_stability,
    "loo_stability": q_loo_stability,
    "centroid_silhouette": q_centroid_silhouette,
    "centroid_silhouette_score": q_centroid_silhouette_score,
    "focus_silhouette": q_focus_silhouette,
    "candidate_k": q_candidate_k,
    "k_distance": q_k_distance,
    "aspiration_cluster": q_aspiration_cluster,
    "projection_2d": q_projection_2d,
    "cluster_profile": q_cluster_profile,
    "profile_transposed": q_profile_transposed,
    "peer_list": q_peer_list,
    "centroid_distance": q_centroid_distance,
    "peer_comparison": q_peer_comparison,
    "metric_set_tables": q_metric_set_tables,
    "position_label": q_position_label,
    "radar_normalized": q_radar_normalized,
    "peer_ranking": q_peer_ranking,
    "columns_by_pattern": q_columns_by_pattern,
    "peer_gap": q_peer_gap,
    "distance_contribution": q_distance_contribution,
    "boundary_entities": q_boundary_entities,
}

# ------------------------------------------------------------------ oracles


def _zsql() -> str:
    cols = ", ".join(
        f"({c} - avg({c}) OVER ()) / CASE WHEN coalesce(stddev_pop({c}) OVER (), 0) = 0 THEN 1 ELSE stddev_pop({c}) OVER () END AS {c}"
        for c in CL)
    return f", z AS (SELECT c_custkey, c_name, c_mktsegment, rank, {cols} FROM feat)"


def _kmeans_sql(tag: str, alt: bool) -> str:
    pos = "(n * (i + 1)) // 6 + 1" if alt else "(n * (2 * i + 1)) // 10 + 1"
    d2 = " + ".join(f"(z.{c} - c.{c}) * (z.{c} - c.{c})" for c in CL)
    avgs = ", ".join(f"avg(z.{c}) AS {c}" for c in CL)
    out = [f""", {tag}c0 AS (SELECT row_number() OVER (ORDER BY rank) - 1 AS cl, {", ".join(CL)} FROM z
        WHERE rank IN (SELECT {pos} FROM range({K}) t(i), (SELECT count(*) AS n FROM z)))"""]
    for i in range(ITERS + 1):
        out.append(f""", {tag}a{i} AS (SELECT z.c_custkey, min({{'d': {d2}, 'c': c.cl}}).c AS cl FROM z, {tag}c{i} c GROUP BY z.c_custkey)""")
        if i < ITERS:
            out.append(f""", {tag}c{i + 1} AS (SELECT a.cl, {avgs} FROM {tag}a{i} a JOIN z ON z.c_custkey = a.c_custkey GROUP BY a.cl)""")
    out.append(f""", {tag}m AS (SELECT a.cl, row_number() OVER (ORDER BY avg(z.rank), a.cl) - 1 AS cluster_id
        FROM {tag}a{ITERS} a JOIN z ON z.c_custkey = a.c_custkey GROUP BY a.cl),
    {tag}lab AS (SELECT a.c_custkey, z.rank, z.c_name, m.cluster_id FROM {tag}a{ITERS} a JOIN {tag}m m ON a.cl = m.cl
        JOIN z ON z.c_custkey = a.c_custkey)""")
    return "".join(out)


BASE = "WITH " + FEAT_SQL + _zsql() + _kmeans_sql("k", False)
TWO = BASE + _kmeans_sql("q", True) + """, two AS (SELECT a.c_custkey, a.rank, a.cluster_id AS a, b.cluster_id AS b
    FROM klab a JOIN qlab b ON a.c_custkey = b.c_custkey)"""
_INFO = """, info AS (SELECT cluster_id, count(*) AS n, avg(rank) AS mean_rank, min(rank) AS min_rank, max(rank) AS max_rank
    FROM klab GROUP BY cluster_id),
names AS (SELECT cluster_id, printf('%s (%d-%d)', CASE cluster_id WHEN 0 THEN 'Elite' WHEN 1 THEN 'Strong' WHEN 2 THEN 'Mid-Upper'
    WHEN 3 THEN 'Mid-Lower' WHEN 4 THEN 'Lower' WHEN 5 THEN 'Bottom' WHEN 6 THEN 'Tier-7' ELSE 'Tier-' || (cluster_id + 1) END,
    min_rank, max_rank) AS cluster_name FROM info)"""
_ARI = """, cont AS (SELECT {a} AS a, {b} AS b, count(*)::DOUBLE AS nij FROM {src} GROUP BY ALL),
s AS (SELECT sum(nij * (nij - 1) / 2) AS I, sum(nij) AS N FROM cont),
sa AS (SELECT sum(ai * (ai - 1) / 2) AS A FROM (SELECT sum(nij) AS ai FROM cont GROUP BY a)),
sb AS (SELECT sum(bj * (bj - 1) / 2) AS B FROM (SELECT sum(nij) AS bj FROM cont GROUP BY b))
SELECT round(CASE WHEN (A + B) / 2 - A * B / (N * (N - 1) / 2) = 0 THEN 1.0
                  ELSE (I - A * B / (N * (N - 1) / 2)) / ((A + B) / 2 - A * B / (N * (N - 1) / 2)) END, 6) AS ari FROM s, sa, sb"""
_FOC = """, foc AS (SELECT max(cluster_id) FILTER (WHERE c_name = '""" + FOCUS + """') AS own FROM klab),
ids AS (SELECT coalesce(own, 0) AS own, greatest(0, coalesce(own, 0) - 1) AS asp FROM foc),
raw AS (SELECT l.c_custkey, l.rank, l.c_name, l.cluster_id, f.n_orders, f.spend, f.avg_price, f.lo, f.hi, f.c_acctbal
        FROM klab l JOIN feat f ON f.c_custkey = l.c_custkey),
cen AS (SELECT l.cluster_id, """ + ", ".join(f"avg(z.{c}) AS {c}" for c in CL) + """ FROM klab l JOIN z ON z.c_custkey = l.c_custkey GROUP BY l.cluster_id)"""

_D2 = "+".join(f" (a.{c} - b.{c}) * (a.{c} - b.{c}) " for c in CL)


def _dbscan_sql(eps: float) -> str:
    """CTEs ``p``, ``core`` and ``ids`` .. of one eps over ``z``, and the labels."""
    return f""", p AS (SELECT c_custkey AS i, rank AS pos, {", ".join(CL)} FROM z),
pr AS (SELECT a.i, b.i AS j FROM p a JOIN p b ON a.i <> b.i AND {_D2} <= {eps * eps}),
deg AS (SELECT i, count(*) AS nb FROM pr GROUP BY i),
core AS (SELECT p.i, p.pos FROM p LEFT JOIN deg ON deg.i = p.i WHERE coalesce(nb, 0) + 1 >= {MIN_SAMPLES}),
ce AS (SELECT pr.i, pr.j FROM pr JOIN core c1 ON c1.i = pr.i JOIN core c2 ON c2.i = pr.j),
reach(i, j) AS (SELECT i, i FROM core UNION SELECT r.i, ce.j FROM reach r JOIN ce ON r.j = ce.i),
comp AS (SELECT r.i, min(c.pos) AS lab FROM reach r JOIN core c ON c.i = r.j GROUP BY r.i),
border AS (SELECT pr.i, min(comp.lab) AS lab FROM pr JOIN comp ON comp.i = pr.j WHERE pr.i NOT IN (SELECT i FROM core) GROUP BY pr.i),
lab AS (SELECT * FROM comp UNION ALL SELECT * FROM border),
ids AS (SELECT lab, row_number() OVER (ORDER BY lab) - 1 AS cluster FROM (SELECT DISTINCT lab FROM lab)),
labelled AS (SELECT p.i AS c_custkey, coalesce(ids.cluster, -1) AS cluster, p.i IN (SELECT i FROM core) AS core
FROM p LEFT JOIN lab ON lab.i = p.i LEFT JOIN ids ON ids.lab = lab.lab)"""


def _sweep_sql() -> str:
    one = [
        f"""SELECT * FROM (WITH RECURSIVE {FEAT_SQL}{_zsql()}{_dbscan_sql(e)}
  SELECT {e}::DOUBLE AS eps, count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS n_clusters, count(*) FILTER (WHERE cluster = -1) AS n_outliers,
    CASE WHEN count(*) FILTER (WHERE cluster = -1) BETWEEN 1 AND 10
      THEN string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey) FILTER (WHERE cluster = -1) END AS outliers FROM labelled)"""
        for e in SWEEP
    ]
    return " UNION ALL ".join(one)


ORACLES = {
    "kmeans_lloyd": BASE + " SELECT c_custkey, rank, cluster_id FROM klab",
    "relabel_by_rank": BASE + " SELECT cluster_id, round(avg(rank), 6) AS mean_rank FROM klab GROUP BY cluster_id",
    "cluster_info": BASE + _INFO + " SELECT cluster_id, n, round(mean_rank, 6) AS mean_rank, min_rank, max_rank FROM info",
    "cluster_names": BASE + _INFO + " SELECT * FROM names",
    "cluster_assignments": BASE + _INFO + """ SELECT l.c_custkey, l.rank, l.cluster_id, n.cluster_name FROM klab l
        JOIN names n ON n.cluster_id = l.cluster_id""",
    "adjusted_rand": TWO + _ARI.format(a="a", b="b", src="two"),
    "adjusted_rand_segment": BASE + """, seg AS (SELECT l.cluster_id, f.c_mktsegment FROM klab l JOIN feat f ON f.c_custkey = l.c_custkey)"""
    + _ARI.format(a="cluster_id", b="c_mktsegment", src="seg"),
    "match_rate": TWO + " SELECT round(avg(CASE WHEN a = b THEN 1.0 ELSE 0.0 END), 6) AS match_rate FROM two",
    "disagreements": TWO + " SELECT c_custkey, rank, a, b FROM two WHERE a <> b",
    "dbscan_labels": "WITH RECURSIVE " + FEAT_SQL + _zsql() + _dbscan_sql(EPS) + " SELECT * FROM labelled",
    "dbscan_sweep": _sweep_sql(),
    "aspiration_cluster": BASE + f""" SELECT c_custkey, cluster_id, greatest(0, cluster_id - 1) AS aspiration FROM klab
        WHERE c_name = '{FOCUS}'""",
    "cluster_profile": BASE + _FOC + """ SELECT cluster_id, count(*) AS n, printf('%d-%d', min(rank), max(rank)) AS rank_range,
        round(avg(rank), 6) AS mean_rank, """ + ", ".join(f"round(avg({c}), 4) AS {c}" for c in DENSE) + " FROM raw GROUP BY cluster_id",
    "peer_list": BASE + _FOC + """ SELECT c_custkey, rank, 'peer' AS list FROM raw, ids WHERE cluster_id = own
        UNION ALL SELECT c_custkey, rank, 'aspiration' FROM raw, ids WHERE cluster_id = asp""",
    "centroid_distance": BASE + _FOC + """, pt AS (SELECT * FROM z WHERE c_name = '""" + FOCUS + """'),
        d AS (SELECT cen.cluster_id, sqrt(""" + " + ".join(f"(pt.{c} - cen.{c}) * (pt.{c} - cen.{c})" for c in CL) + """) AS dist FROM pt, cen)
        SELECT round(max(dist) FILTER (WHERE cluster_id = own), 6) AS dist_own,
               round(max(dist) FILTER (WHERE cluster_id = asp), 6) AS dist_aspiration,
               round(max(dist) FILTER (WHERE cluster_id = asp) / nullif(max(dist) FILTER (WHERE cluster_id = own), 0), 6) AS ratio FROM d, ids""",
    "peer_comparison": BASE + _FOC + " SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(max({c}) FILTER (WHERE c_name = '{FOCUS}'), 4) AS focus,
            round(avg({c}) FILTER (WHERE cluster_id = own), 4) AS peer_mean, round(avg({c}) FILTER (WHERE cluster_id = asp), 4) AS aspiration_mean,
            round(max({c}) FILTER (WHERE c_name = '{FOCUS}') - avg({c}) FILTER (WHERE cluster_id = own), 4) AS vs_peer,
            round(max({c}) FILTER (WHERE c_name = '{FOCUS}') - avg({c}) FILTER (WHERE cluster_id = asp), 4) AS vs_aspiration FROM raw, ids"""
        for c in DENSE) + ")",
    "position_label": BASE + _FOC + " SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CASE WHEN '{c}' = 'lo' THEN CASE WHEN f < p THEN 'MORE SELECTIVE' ELSE 'LESS SELECTIVE' END
            WHEN f > p THEN 'ABOVE' WHEN f < p THEN 'BELOW' ELSE 'AT' END AS position FROM (
            SELECT max({c}) FILTER (WHERE c_name = '{FOCUS}')::DOUBLE AS f, avg({c}) FILTER (WHERE cluster_id = own)::DOUBLE AS p FROM raw, ids)"""
        for c in DENSE) + ")",
    "radar_normalized": BASE + _FOC + " SELECT c_custkey, " + ", ".join(
        (f"round(CASE WHEN max(100.0 - {c}) OVER () = min(100.0 - {c}) OVER () THEN 1.0 ELSE ((100.0 - {c}) - min(100.0 - {c}) OVER ()) / (max(100.0 - {c}) OVER () - min(100.0 - {c}) OVER ()) END, 6) AS {c}"
         if c == "lo" else
         f"round(CASE WHEN max({c}) OVER () = min({c}) OVER () THEN 1.0 ELSE ({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()) END, 6) AS {c}")
        for c in DENSE) + " FROM raw",
    "peer_ranking": BASE + _FOC + """ SELECT c_custkey, spend, round(avg(spend) OVER (), 4) AS peer_mean FROM raw, ids WHERE cluster_id = own""",
    "peer_gap": BASE + _FOC + """ SELECT c_custkey, round(spend - avg(spend) OVER (), 4) AS gap_to_peer_mean FROM raw, ids WHERE cluster_id = own""",
    "columns_by_pattern": BASE + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS n_values, round(min({c}), 4) AS least, round(max({c}), 4) AS most FROM feat"
        for c in ("p1", "p12p", "p5p")) + ")",
    "distance_contribution": BASE + _FOC + """, pt AS (SELECT * FROM z WHERE c_name = '""" + FOCUS + """'),
        ac AS (SELECT cen.* FROM cen, ids WHERE cen.cluster_id = ids.asp),
        l AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, pt.{c} AS x, ac.{c} AS c FROM pt, ac" for c in CL) + """),
        q AS (SELECT feature, x, c, (x - c) * (x - c) AS sq FROM l)
        SELECT feature, round(sq, 6) AS sq, round(sq * 100.0 / sum(sq) OVER (), 4) AS pct,
               CASE WHEN x < c THEN 'below' WHEN x > c THEN 'above' ELSE 'at' END AS direction FROM q ORDER BY sq DESC, feature LIMIT 15""",
    "boundary_entities": BASE + _FOC + """, ac AS (SELECT cen.* FROM cen, ids WHERE cen.cluster_id = ids.asp)
        SELECT z.c_custkey, z.rank, round(sqrt(""" + " + ".join(f"(z.{c} - ac.{c}) * (z.{c} - ac.{c})" for c in CL) + """), 6) AS dist
        FROM z JOIN klab l ON l.c_custkey = z.c_custkey, ac, ids WHERE l.cluster_id = ids.own ORDER BY dist, z.c_custkey LIMIT 10""",
}

_SIL = """, zc AS (SELECT z.*, l.cluster_id FROM z JOIN klab l ON l.c_custkey = z.c_custkey),
dd AS (SELECT zc.c_custkey, zc.c_name, zc.cluster_id, cen.cluster_id AS other, sqrt(""" + " + ".join(
    f"(zc.{c} - cen.{c}) * (zc.{c} - cen.{c})" for c in CL) + """) AS d FROM zc, cen),
ab AS (SELECT c_custkey, c_name, cluster_id, max(d) FILTER (WHERE other = cluster_id) AS a,
              min(d) FILTER (WHERE other <> cluster_id) AS b FROM dd GROUP BY ALL),
sz AS (SELECT cluster_id, count(*) AS n FROM zc GROUP BY cluster_id),
sil AS (SELECT ab.c_custkey, ab.c_name, ab.cluster_id, CASE WHEN sz.n <= 1 OR greatest(a, b) = 0 THEN 0.0
               ELSE (b - a) / greatest(a, b) END AS s FROM ab JOIN sz ON sz.cluster_id = ab.cluster_id)"""
ORACLES["k_distance"] = "WITH " + FEAT_SQL + _zsql() + f""", d AS (SELECT a.c_custkey, sqrt({_D2}) AS dist, b.c_custkey AS j
          FROM z a JOIN z b ON a.c_custkey <> b.c_custkey)
    SELECT c_custkey, round(dist, 6) AS k_distance FROM d
    QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY dist, j) = {min(2 * len(CL) + 1, 10) - 1}"""
ORACLES["centroid_silhouette"] = BASE + _FOC + _SIL + " SELECT c_custkey, cluster_id, round(s, 6) AS silhouette FROM sil"
ORACLES["centroid_silhouette_score"] = BASE + _FOC + _SIL + " SELECT round(avg(round(s, 6)), 4) AS score FROM sil"
ORACLES["kmeans_inertia"] = BASE + f""" SELECT round(sum(d), 4) AS inertia FROM (
    SELECT min({" + ".join(f"(z.{c} - c.{c}) * (z.{c} - c.{c})" for c in CL)}) AS d FROM z, kc{ITERS} c GROUP BY z.c_custkey)"""
ORACLES["focus_silhouette"] = BASE + _FOC + _SIL + f""", r AS (SELECT c_name, cluster_id, round(s, 6) AS s FROM sil)
    SELECT max(s) FILTER (WHERE c_name = '{FOCUS}') AS focus, round(avg(s), 4) AS overall,
           round(avg(s) FILTER (WHERE cluster_id = own), 4) AS focus_cluster_mean FROM r, ids"""
ORACLES["metric_set_tables"] = f"""SELECT m.metric_set, m.place::BIGINT AS place, m.metric, c.* FROM ({ORACLES["peer_comparison"]}) c
    JOIN (VALUES {", ".join(f"('{s}', {i}, '{m}', '{f}')" for i, (s, m, f) in enumerate(METRICS))}) m(metric_set, place, metric, feature)
    ON m.feature = c.feature"""
ORACLES["profile_transposed"] = BASE + _FOC + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{'orders' if c == 'n_orders' else c}' AS feature, "
    + ", ".join(f'round(avg({c}) FILTER (WHERE cluster_id = {k}), 4)::DOUBLE AS "{k}"' for k in range(K)) + " FROM raw"
    for c in DENSE) + ")"
