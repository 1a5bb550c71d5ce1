"""C — clustering and validity statistics.

K-means: centroids are metadata (runs x k x p numbers).  Each Lloyd
iteration is one distributed pass: every point is assigned for every run
against a broadcast model row (nothing paired), then ``groupBy(run,
cluster)`` sums give the new centroids.  Fits with many restarts, reference
sets or resamples (thousands of runs) take their passes from
``operators.multirun``.

DBSCAN: cells whose points are all neighbours, over any number of columns; the few
points of thin cells search their neighbours (``operators.pivots``); components of
cells are found by min-label propagation over tables written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.operators import multirun
from leafline.operators.pivots import PAIRS, Leaves, box_gaps, least_distance, nearest, ranked_copies
from leafline.session import materialise

# Fixed values (must equal the reference's): names of clusters by rank order.
TIER_NAMES = ["Elite", "Strong", "Mid-Upper", "Mid-Lower", "Lower", "Bottom", "Tier-7"]


# ------------------------------------------------------------------ helpers

def sqdist_expr(feats: Sequence[str], centre: Sequence[float]) -> Column:
    e = F.lit(0.0)
    for c, v in zip(feats, centre):
        e = e + (F.col(c) - F.lit(float(v))) ** 2
    return e


def nearest_expr(feats: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """struct(d2, cluster) of the nearest centre; ties -> lowest cluster id."""
    items = [F.struct(sqdist_expr(feats, c).alias("d2"), F.lit(i).alias("cluster")) for i, c in enumerate(centres)]
    return F.array_min(F.array(*items))


def uniform_hash(*cols: Column, seed: int = 42) -> Column:
    """Deterministic uniform in (0, 1) from the row's values (partition- and
    order-independent, unlike ``rand``)."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.abs(h % F.lit(1 << 52)).cast("double") + 0.5) / F.lit(float(1 << 52))


# ------------------------------------------------------------------ Lloyd
#
# The model (every run's centres) is one row, broadcast to the points and
# read by higher-order functions; its size is runs x k x p numbers, bounded
# by the caller's parameters.  Keeping centres out of the generated code
# means one compiled plan serves every iteration.

MODEL_T = "runs array<struct<run:string,centres:array<array<double>>>>"


def _nearest_hof(x: Column, centres: Column) -> Column:
    """struct(d2, cluster) of the nearest centre (ties -> lowest id)."""
    d = F.transform(centres, lambda c, i: F.struct(
        F.aggregate(F.zip_with(x, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s_, v: s_ + v).alias("d2"),
        i.alias("cluster")))
    return F.array_min(d)


def _with_model(df: DataFrame, feats: Sequence[str], runs: dict) -> DataFrame:
    rows = [(str(r), [list(map(float, c)) for c in cs]) for r, cs in runs.items()]
    model = df.sparkSession.createDataFrame([(rows,)], MODEL_T).withColumn("_one", F.lit(1))
    pts = df.select(F.array(*[F.col(c).cast("double") for c in feats]).alias("_x"), F.lit(1).alias("_one"))
    per = F.transform("runs", lambda r: F.struct(r["run"].alias("run"), _nearest_hof(F.col("_x"), r["centres"]).alias("n")))
    return pts.join(F.broadcast(model), "_one").select("_x", F.inline(per))


def lloyd_step(df: DataFrame, feats: Sequence[str], runs: dict):
    """One assignment + update for every run at once.

    ``runs``: run_id -> list of k centres.  Returns (new runs, inertia per
    run, sizes per run); only runs x k aggregate rows reach the driver."""
    aggs = [F.count(F.lit(1)).alias("w"), F.sum("n.d2").alias("sse"), F.max("n.d2").alias("far_d2"),
            F.max_by("_x", F.col("n.d2")).alias("far")]
    aggs += [F.sum(F.col("_x")[i]).alias(f"s_{i}") for i in range(len(feats))]
    rows = _with_model(df, feats, runs).groupBy("run", F.col("n.cluster").alias("cluster")).agg(*aggs).collect()
    key = {str(r): r for r in runs}
    new, inertia, sizes, far = {}, {}, {}, {}
    for r in rows:
        run, c = key[r["run"]], r["cluster"]
        new.setdefault(run, {})[c] = [r[f"s_{i}"] / r["w"] for i in range(len(feats))]
        inertia[run] = inertia.get(run, 0.0) + (r["sse"] or 0.0)
        sizes.setdefault(run, {})[c] = r["w"]
        far.setdefault(run, []).append((r["far_d2"] or 0.0, list(r["far"])))
    out = {}
    for run, cs in runs.items():
        got = new.get(run, {})
        # emptied clusters re-seed with distinct far points, the farthest first
        spare = sorted(far.get(run, []), key=lambda t: -t[0])
        fixed = []
        for c in range(len(cs)):
            fixed.append(got[c] if c in got else spare.pop(0)[1] if spare else list(cs[c]))
        out[run] = fixed
    return out, inertia, sizes


def lloyd(df: DataFrame, feats: Sequence[str], runs: dict, max_iter: int = 300, tol: float = 1e-4,
          fixed_iterations: bool = False):
    """Multi-run Lloyd until every run moves less than ``tol`` or
    ``max_iter``; with ``fixed_iterations`` exactly ``max_iter`` steps
    (deterministic, SQL-checkable).  Converged runs leave the model."""
    cur = {r: [list(map(float, c)) for c in cs] for r, cs in runs.items()}
    active = set(cur)
    for _ in range(max_iter):
        if not active:
            break
        new, _, _ = lloyd_step(df, feats, {r: cur[r] for r in active})
        for r in list(active):
            shift = max(np.sum((np.array(a) - np.array(b)) ** 2) for a, b in zip(cur[r], new[r]))
            cur[r] = new[r]
            if not fixed_iterations and shift <= tol * tol:
                active.discard(r)
    _, inertia, sizes = lloyd_step(df, feats, cur)
    return cur, inertia, sizes


def kmeans_fit(df: DataFrame, key: str, feats: Sequence[str], k: int, n_init: int = 50, max_iter: int = 500,
               seed: int = 42):
    """Best of ``n_init`` cold k-means++ runs by inertia (all runs share
    each pass).  Returns (centres, inertia)."""
    pts = multirun.points(df, key, feats, seed=seed)
    centres, inertia = multirun.fit_best(pts, [(0, k, n_init)], max_iter)[0, k]
    return centres.tolist(), inertia


def inertia_curve(df: DataFrame, key: str, feats: Sequence[str], ks: Sequence[int], n_init: int = 50,
                  max_iter: int = 500, seed: int = 42) -> list[tuple[int, float]]:
    """Best inertia for each k; every (k, restart) is a run of the same passes."""
    pts = multirun.points(df, key, feats, seed=seed)
    fits = multirun.fit_best(pts, [(0, k, n_init) for k in ks], max_iter)
    return [(k, float(fits[0, k][1])) for k in ks]


def gap_inertias(df: DataFrame, key: str, feats: Sequence[str], ks: Sequence[int], b: int = 50, n_init: int = 20,
                 ref_init: int = 10, max_iter: int = 300, seed: int = 42) -> list[tuple[int, int, float]]:
    """C4's ``(k, ref_set, inertia)``: the data is set 0, sets 1..b are uniform
    in each column's [min, max] with one point per row.  The sets are made
    inside the passes and never stored; all of them share each pass."""
    pts = multirun.points(df, key, feats, seed=seed)
    ends = pts.agg(*[f(F.col("x")[j]) for f in (F.min, F.max) for j in range(len(feats))]).first()
    plan = [(s, k, n_init if s == 0 else ref_init) for k in ks for s in range(b + 1)]
    fits = multirun.fit_best(pts, plan, max_iter, box=(ends[: len(feats)], ends[len(feats):]))
    return [(k, s, float(inertia)) for (s, k), (_, inertia) in fits.items()]


def assign(df: DataFrame, feats: Sequence[str], centres: Sequence[Sequence[float]], name: str = "cluster") -> DataFrame:
    """Label every point with its nearest centre (row-local)."""
    n = nearest_expr(feats, centres)
    return df.withColumn(name, n["cluster"]).withColumn(f"{name}_d2", n["d2"])


# ------------------------------------------------------------------ gap statistic

def gap_from_inertias(inertias: DataFrame, b: int) -> DataFrame:
    """C4 on an inertia table ``(k, ref_set, inertia)`` where ref_set 0 is
    the data: gap = mean_b ln W*_kb − ln W_k; s = std_pop(ln W*) √(1+1/B)."""
    lw = inertias.withColumn("lw", F.log("inertia"))
    real = lw.where("ref_set = 0").select("k", F.col("lw").alias("lw0"))
    ref = lw.where("ref_set > 0").groupBy("k").agg(F.avg("lw").alias("m"), F.stddev_pop("lw").alias("sd"))
    return ref.join(real, "k").select("k", (F.col("m") - F.col("lw0")).alias("gap"),
                                      (F.col("sd") * F.lit(math.sqrt(1 + 1 / b))).alias("s"))


def gap_rule(gaps: DataFrame) -> DataFrame:
    """Smallest k with gap(k) >= gap(k+1) − s(k+1) (the k table is
    metadata-sized)."""
    w = Window.orderBy("k")
    g = gaps.withColumn("ng", F.lead("gap").over(w)).withColumn("ns", F.lead("s").over(w))
    return g.where(F.col("gap") >= F.col("ng") - F.col("ns")).agg(F.min("k").alias("k_gap"))


def best_k(scores: DataFrame) -> DataFrame:
    """K with the best score, first (smallest k) on ties."""
    return scores.agg(F.max_by("k", F.struct(F.col("score"), -F.col("k"))).alias("best_k"))


# ------------------------------------------------------------------ labels and agreement

def relabel_by_rank(assigned: DataFrame, cluster_col: str, rank_col: str, out_col: str = "cluster_id") -> DataFrame:
    """Renumber clusters 0..k−1 by mean rank ascending.  The map
    has k rows (an aggregate), so it is broadcast."""
    means = assigned.groupBy(cluster_col).agg(F.avg(rank_col).alias("_mr"))
    m = means.withColumn(out_col, (F.row_number().over(Window.orderBy("_mr", cluster_col)) - 1).cast("bigint")).drop("_mr")
    return assigned.join(F.broadcast(m), cluster_col)


def cluster_info(assigned: DataFrame, cluster_col: str, rank_col: str) -> DataFrame:
    """C11: per cluster n and mean/min/max rank."""
    return assigned.groupBy(cluster_col).agg(
        F.count("*").alias("n"), F.avg(rank_col).alias("mean_rank"),
        F.min(rank_col).alias("min_rank"), F.max(rank_col).alias("max_rank"))


def cluster_names(info: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    """C14: tier word by cluster order + "(min-max)" of its ranks."""
    words = F.element_at(F.array(*[F.lit(w) for w in TIER_NAMES]), (F.col(cluster_col) + 1).cast("int"))
    word = F.coalesce(F.when(F.col(cluster_col) < len(TIER_NAMES), words),
                      F.concat(F.lit("Tier-"), (F.col(cluster_col) + 1).cast("string")))
    return info.select(cluster_col, F.format_string("%s (%d-%d)", word, F.col("min_rank"), F.col("max_rank")).alias("cluster_name"))


def adjusted_rand(df: DataFrame, a: str, b: str, weight: Column | None = None, by: Sequence[str] = ()) -> DataFrame:
    """ARI from the contingency table (groupBy(a, b)); 1.0 when the
    denominator is 0.  Optional integer weights (bootstrap multiplicities);
    ``by`` gives one ARI per group.  The contingency table has at most
    k_a x k_b rows a group."""
    w = weight if weight is not None else F.lit(1)
    cont = df.groupBy(*by, a, b).agg(F.sum(w).cast("double").alias("nij"))
    comb = lambda x: x * (x - 1) / 2
    wa, wb = Window.partitionBy(*by, a), Window.partitionBy(*by, b)
    cont = cont.select("*", F.sum("nij").over(wa).alias("ai"), F.sum("nij").over(wb).alias("bj"),
                       F.row_number().over(wa.orderBy(b)).alias("ra"), F.row_number().over(wb.orderBy(a)).alias("rb"))
    one = cont.groupBy(*by).agg(F.sum(comb(F.col("nij"))).alias("I"), F.sum("nij").alias("N"),
                                F.sum(F.when(F.col("ra") == 1, comb(F.col("ai")))).alias("A"),
                                F.sum(F.when(F.col("rb") == 1, comb(F.col("bj")))).alias("B"))
    # a single row has no pair of rows: the agreement is 1 by definition
    e = F.try_divide(F.col("A") * F.col("B"), comb(F.col("N")))
    den = (F.col("A") + F.col("B")) / 2 - e
    ari = F.when(e.isNull() | (den == 0), F.lit(1.0)).otherwise((F.col("I") - e) / den)
    return one.select(*by, ari.alias("ari"))


def match_rate(df: DataFrame, a: str, b: str) -> DataFrame:
    """C17: share of rows where the labels agree."""
    return df.agg(F.avg((F.col(a) == F.col(b)).cast("double")).alias("match_rate"))


def stability_grade(mean_ari: Column) -> Column:
    """GOOD > 0.7, MODERATE > 0.5, else POOR."""
    return F.when(mean_ari > 0.7, "GOOD").when(mean_ari > 0.5, "MODERATE").otherwise("POOR")


# ------------------------------------------------------------------ DBSCAN

def dbscan(df: DataFrame, key: str, order: str, feats: Sequence[str], eps: float | Sequence[float],
           min_samples: int) -> DataFrame:
    """Labels 0..c−1 (clusters ordered by their first core point in
    ``order``) and −1 for noise, for one or several eps at once.

    Core: at least ``min_samples`` points within eps, itself included.  A
    border point joins the cluster with the smallest first-core position
    among its core neighbours.

    Points lie in a grid (one for each eps) whose cells are so small that all points of one are
    neighbours.  So a cell of ``min_samples`` points has core points only, and a cell's core points are of one
    cluster.  Of the other cells' points the ``min_samples`` - 1 nearest points within the largest eps
    are sought once for all eps: they tell core points, and are all neighbours of a point that is none.  Clusters are
    the components of the cells with core points (``cell_links``).  No list of pairs of points is formed."""
    from leafline.operators.features import global_row_number

    eps_list = [float(e) for e in (eps if isinstance(eps, (list, tuple)) else [eps])]
    if min(eps_list) <= 0:
        raise ValueError("eps must be positive")
    spark, k = df.sparkSession, min_samples - 1
    pts = materialise(df.select(F.col(key).alias("i"), F.col(order).alias("pos"), *[F.col(c).cast("double").alias(c) for c in feats]), "dbscan-points")
    ranked = ranked_copies(pts.dropna(subset=list(feats)), "i", feats)
    grid = F.explode(F.array(*[
        F.struct(F.lit(e).alias("eps"), F.array(*[F.floor(F.col(c) / cell_side(e, len(feats))) for c in feats]).alias("g")) for e in eps_list
    ]))
    placed = ranked.drop("_copy", "_same").select("*", grid.alias("_at")).select("*", "_at.eps", "_at.g").drop("_at")
    sizes = placed.groupBy("eps", "g").agg(F.count(F.lit(1)).alias("n"))
    placed = materialise(placed.join(sizes, ["eps", "g"]), "dbscan-cells")
    thin = placed.where(F.col("n") < min_samples)
    near = nearest(
        thin.select("i", *feats).dropDuplicates(["i"]), ranked.where(F.col("_copy") <= min_samples).select("i", *feats), "i", feats, k,
        limit=max(eps_list) * (1 + 1e-9),
    ) if k > 0 else spark.createDataFrame([], "_r long, slot int, dist double, donor long, value double")
    within = F.explode(F.filter(F.array(*[F.lit(e) for e in eps_list]), lambda e: F.col("value") <= e * e))
    near = materialise(near.select(F.col("_r").alias("i"), F.col("donor").alias("j"), within.alias("eps")), "dbscan-near")
    deg = near.groupBy("eps", "i").agg(F.count(F.lit(1)).alias("nb"))
    enough = (F.col("n") >= min_samples) | (F.coalesce(F.col("nb"), F.lit(0)) + 1 >= min_samples)
    point = materialise(placed.join(deg, ["eps", "i"], "left").withColumn("core", enough).drop("n", "nb"), "dbscan-core")
    cores = point.where("core")
    u = F.min("pos").over(Window.partitionBy("eps", "g")).alias("u")  # a cell is named by its first core point
    cores = materialise(cores.select("eps", "i", u, *feats), "dbscan-cores")
    links = None
    for e in eps_list:
        found = cell_links(cores.where(F.col("eps") == e), feats, e).select(F.lit(e).alias("eps"), "u", "v", "sure")
        links = found if links is None else links.unionByName(found)
    links = materialise(links, "dbscan-links")
    label = components(cores.select("eps", "u").distinct(), links.where("sure"))
    lab_v = label.select("eps", F.col("u").alias("v"), F.col("lab").alias("lab_v"))
    # cells that may touch, of different components so far: their points decide
    open_ = links.where("not sure").join(label, ["eps", "u"]).join(lab_v, ["eps", "v"]).where("lab <> lab_v").select("eps", "u", "v", "lab", "lab_v")
    open_ = materialise(open_.distinct(), "dbscan-open")
    if not open_.isEmpty():
        more = touching(open_, cores, feats).select("eps", F.col("lab").alias("u"), F.col("lab_v").alias("v")).distinct()
        roots = components(label.select("eps", F.col("lab").alias("u")).distinct(), materialise(more, "dbscan-more"))
        roots = roots.select("eps", F.col("u").alias("lab"), F.col("lab").alias("root"))
        label = label.join(roots, ["eps", "lab"]).select("eps", "u", F.col("root").alias("lab"))
    comp = cores.join(label, ["eps", "u"]).select("eps", "i", "lab")
    border = near.join(point.where(~F.col("core")).select("eps", "i"), ["eps", "i"]).join(
        comp.select("eps", F.col("i").alias("j"), "lab"), ["eps", "j"]).groupBy("eps", "i").agg(F.min("lab").alias("lab"))
    labs = comp.unionByName(border)
    ids = global_row_number(labs.select("eps", "lab").distinct(), [F.col("eps"), F.col("lab")], "_g")
    first = ids.groupBy("eps").agg(F.min("_g").alias("_g0"))
    ids = ids.join(first, "eps").withColumn("cluster", F.col("_g") - F.col("_g0")).select("eps", "lab", "cluster")
    every = pts.select("i", F.explode(F.array(*[F.lit(e) for e in eps_list])).alias("eps"))
    out = every.join(labs, ["eps", "i"], "left").join(ids, ["eps", "lab"], "left").join(point.select("eps", "i", "core"), ["eps", "i"], "left")
    out = out.select("eps", F.col("i").alias(key), F.coalesce(F.col("cluster"), F.lit(-1)).alias("cluster"), F.coalesce("core", F.lit(min_samples <= 1)).alias("core"))
    return out if len(eps_list) > 1 else out.drop("eps")


def cell_side(eps: float, p: int) -> float:
    """Side of a cell whose points all are within ``eps``."""
    return eps / math.sqrt(p) * (1 - 1e-9)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(eps, u, lab)``: the smallest node that each node is linked to.

    Each round takes the smallest neighbour label, then jumps (label of my label), which shortens
    chains geometrically.  Each round's labels are written once; the loop ends when no label changes."""
    e = materialise(edges.select("eps", "u", "v").unionByName(edges.select("eps", F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "dbscan-edges")
    label = materialise(nodes.select("eps", "u", F.col("u").alias("lab")), "dbscan-label")
    while True:
        nb = e.join(label.select("eps", F.col("u").alias("v"), F.col("lab").alias("nlab")), ["eps", "v"]).groupBy(
            "eps", "u").agg(F.min("nlab").alias("m"))
        step = materialise(label.join(nb, ["eps", "u"], "left").select(
            "eps", "u", F.col("lab").alias("old"), F.least("lab", F.coalesce("m", "lab")).alias("lab")), "dbscan-step")
        jump = materialise(step.join(step.select("eps", F.col("u").alias("lab"), F.col("lab").alias("lab2")), ["eps", "lab"]).select(
            "eps", "u", "old", F.least("lab", "lab2").alias("lab")), "dbscan-label")
        label = jump.select("eps", "u", "lab")
        if jump.where("lab <> old").isEmpty():
            return label


def united(lab: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``lab`` (the smallest node that each node is linked to so far) after links ``a`` - ``b``."""
    while True:
        apart = lab[a] != lab[b]
        a, b = a[apart], b[apart]
        if not len(a):
            return lab
        low = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, lab[a], low)
        np.minimum.at(lab, lab[b], low)
        while not (lab[lab] == lab).all():
            lab = lab[lab]


def cell_links(cores: DataFrame, feats: Sequence[str], eps: float) -> DataFrame:
    """Links ``(u, v, sure)`` between the cells ``u`` of the core points.

    Sure ones are between cells with core points within ``eps`` of each other, and only as many as hold together what a task
    sees.  The others are between cells whose boxes are within ``eps`` but whose outermost points in each direction are not; a
    pair that is in neither is farther apart or held together by sure links."""
    p = len(feats)
    here = F.array(*feats)
    ends = [f(here, F.col(c)) for c in feats for f in (F.min_by, F.max_by)]
    boxes = cores.groupBy("u").agg(
        *[F.min(c).alias(f"l{j}") for j, c in enumerate(feats)], *[F.max(c).alias(f"h{j}") for j, c in enumerate(feats)],
        F.flatten(F.array(*ends)).alias("ends"),
    )
    mid = [((F.col(f"l{j}") + F.col(f"h{j}")) / 2).alias(f"m{j}") for j in range(p)]
    mids, lows, highs = ([f"{x}{j}" for j in range(p)] for x in "mlh")
    leaves = Leaves(materialise(boxes.select("*", *mid), "dbscan-boxes"), "u", mids, lows, highs)
    ends_of = leaves.low, leaves.high
    limit = eps * (1 + 1e-9)

    def pick(part):
        low, high = part[lows].to_numpy(dtype=float), part[highs].to_numpy(dtype=float)
        ok = least_distance(low, high, ends_of) <= limit
        own = part["_cell"].to_numpy()
        ok &= np.arange(ok.shape[1])[None] >= own[:, None]  # each pair of leaves meets once
        return [np.flatnonzero(r) for r in ok]

    def link(r, d):
        names = np.unique(np.concatenate([r["u"].to_numpy(), d["u"].to_numpy()]))
        a, b = np.searchsorted(names, r["u"].to_numpy()), np.searchsorted(names, d["u"].to_numpy())
        lab = np.arange(len(names))
        box = [[x[c].to_numpy(dtype=float) for c in (lows, highs)] for x in (r, d)]
        outer = [np.stack(x["ends"].to_numpy()).reshape(len(x), 2 * p, p) if len(x) else np.zeros((0, 2 * p, p)) for x in (r, d)]
        left = [np.zeros((0, 2), dtype=np.int64)]
        step = max(1, PAIRS // max(1, len(d)))
        for at in range(0, len(r) if len(d) else 0, step):
            some = slice(at, at + step)
            gap, _ = box_gaps(box[0][0][some], box[0][1][some], *box[1])
            i, j = np.nonzero(gap <= limit * limit)
            i += at
            far = np.zeros(len(i))
            for c in range(p):
                far += np.maximum(box[0][1][i, c] - box[1][0][j, c], box[1][1][j, c] - box[0][0][i, c]) ** 2
            sure = far <= eps * eps * (1 - 1e-9)
            lab = united(lab, a[i[sure]], b[j[sure]])
            while True:
                i, j = i[~sure], j[~sure]
                apart = lab[a[i]] != lab[b[j]]
                i, j = i[apart], j[apart]
                if not len(i):
                    break
                # the outermost points of some pairs, then drop what these have joined
                n = max(1, PAIRS // (4 * p * p))
                sure = np.zeros(len(i), dtype=bool)
                x, y = outer[0][i[:n], :, None, :], outer[1][j[:n], None, :, :]
                d2 = np.zeros((len(x), 2 * p, 2 * p))
                for c in range(p):
                    d2 += (x[..., c] - y[..., c]) ** 2
                hit = d2.min(axis=(1, 2)) <= eps * eps
                lab = united(lab, a[i[:n][hit]], b[j[:n][hit]])
                miss = np.flatnonzero(~hit)
                left.append(np.stack([a[i[miss]], b[j[miss]]], axis=1))
                sure[:n] = True
        open_ = np.concatenate(left)
        open_ = open_[lab[open_[:, 0]] != lab[open_[:, 1]]]
        tied = np.flatnonzero(lab != np.arange(len(lab)))
        return pd.DataFrame({
            "u": names[np.concatenate([tied, open_[:, 0]])], "v": names[np.concatenate([lab[tied], open_[:, 1]])],
            "sure": np.arange(len(tied) + len(open_)) < len(tied),
        })

    visits = leaves.visits(leaves.table.select("u", "_cell", *lows, *highs, "ends"), pick).withColumnRenamed("_cell", "_own")
    return leaves.meet(visits, leaves.table.drop(*mids), "u", link, f"u {cores.schema['u'].dataType.simpleString()}, v {cores.schema['u'].dataType.simpleString()}, sure boolean")


def touching(pairs: DataFrame, cores: DataFrame, feats: Sequence[str]) -> DataFrame:
    """Those ``pairs`` (eps, u, v, ...) of cells that have core points within eps of each other, by their points near the other cell."""
    box = cores.groupBy("eps", "u").agg(*[f(c).alias(f"_{n}{c}") for c in feats for n, f in (("l", F.min), ("h", F.max))])
    gap = lambda c: F.greatest(F.col(f"_l{c}") - F.col(c), F.col(c) - F.col(f"_h{c}"), F.lit(0.0))
    close = sum((gap(c) * gap(c) for c in feats), F.lit(0.0)) <= F.col("eps") * F.col("eps") * (1 + 1e-9)

    def side(own: str, other: str) -> DataFrame:
        far_box = box.withColumnRenamed("u", other)
        mine = pairs.join(far_box, ["eps", other]).join(cores.select("eps", F.col("u").alias(own), *feats).distinct(), ["eps", own])
        return mine.where(close)

    left = side("u", "v").select(*pairs.columns, *feats)
    right = side("v", "u").select("eps", "u", "v", *[F.col(c).alias(f"_y{c}") for c in feats])
    d2 = sum(((F.col(c) - F.col(f"_y{c}")) ** 2 for c in feats), F.lit(0.0))
    return left.join(right, ["eps", "u", "v"]).where(d2 <= F.col("eps") * F.col("eps")).select(*pairs.columns).distinct()


# ------------------------------------------------------------------ centroid silhouette (C3 variant)

def centroid_silhouette(assigned: DataFrame, feats: Sequence[str], centres: Sequence[Sequence[float]],
                        cluster_col: str = "cluster") -> DataFrame:
    """Simplified (centroid) silhouette, O(n·k): a = distance to the own
    centre, b = distance to the nearest other centre, s = (b − a)/max(a, b);
    0 for a point alone in its cluster.  This is NOT the exact silhouette
    (mean distance to every member needs every pair); it is reported under
    its own name."""
    d = [F.sqrt(sqdist_expr(feats, c)) for c in centres]
    dist = F.array(*d)
    own = F.element_at(dist, (F.col(cluster_col) + 1).cast("int"))
    other = F.array_min(F.filter(F.transform(dist, lambda x, i: F.when(i != F.col(cluster_col), x)), lambda x: x.isNotNull()))
    size = F.col("_size")
    s = F.when(size <= 1, F.lit(0.0)).when(F.greatest(own, other) == 0, F.lit(0.0)).otherwise(
        (other - own) / F.greatest(own, other))
    # one row per cluster, as many as ``centres``
    sizes = assigned.groupBy(F.col(cluster_col).alias("_sc")).agg(F.count(F.lit(1)).alias("_size"))
    return assigned.join(F.broadcast(sizes), F.col(cluster_col) == F.col("_sc")).withColumn("silhouette", s).drop("_sc", "_size")
