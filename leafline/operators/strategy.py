"""R — regression, gap and what-if analysis for a focus entity.

Models are fitted from one-pass moment aggregates (``linalg.gram``); only
p x p sums and the focus entity's few values ever reach the driver.
Scenario and lever tables are small inputs (metadata); entity tables are
only scanned and aggregated.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.functions.stats import exact_avg
from leafline.operators import linalg
from leafline.operators.features import global_row_number, unpivot


def target_band(feat: DataFrame, rank_col: str, score: str, band: tuple[int, int], focus: Column) -> DataFrame:
    """Entities ranked inside the band: count, min/max/mean score, the
    focus score and the gap (mean − focus).  One aggregate pass."""
    inb = F.col(rank_col).between(*band)
    return feat.agg(
        F.count_if(inb).alias("n_in_band"),
        F.min(F.when(inb, F.col(score))).alias("min_score"),
        F.max(F.when(inb, F.col(score))).alias("max_score"),
        exact_avg(F.when(inb, F.col(score))).alias("mean_score"),
        F.max(F.when(focus, F.col(score))).alias("focus_score"),
    ).withColumn("gap", F.col("mean_score") - F.col("focus_score"))


def fit_linear(df: DataFrame, xs: Sequence[str], y: str, alpha: float = 0.0) -> dict:
    """OLS (alpha 0) or ridge with an unpenalised intercept, on the
    rows where y and every x are present; n dropped is reported."""
    g = linalg.gram(df, xs, y)[None]
    beta, icpt = linalg.solve_ridge(g, alpha)
    total = df.count()
    return {"xs": list(xs), "beta": beta, "intercept": icpt, "r2": linalg.r2_from_gram(g, beta),
            "n": int(g["n"]), "dropped": int(total - g["n"]), "alpha": alpha}


def coefficient_frame(spark, fit: dict) -> DataFrame:
    """A fitted model as a small table: one row per term plus fit stats."""
    rows = [(c, float(b)) for c, b in zip(fit["xs"], fit["beta"])] + [("(intercept)", float(fit["intercept"]))]
    df = spark.createDataFrame(rows, "term string, coef double")
    return df.withColumns({"r2": F.lit(fit["r2"]), "n": F.lit(fit["n"]), "dropped": F.lit(fit["dropped"])})


def cv_folds(df: DataFrame, order_col: str, k: int = 5) -> DataFrame:
    """Contiguous folds 1..k in the explicit order (like ``ntile``: the
    first n % k folds are one row larger).  Distributed positions, no
    un-partitioned window over data rows."""
    n = df.count()
    q, r = divmod(n, k)
    pos = global_row_number(df, [F.col(order_col)], "_pos")
    p = F.col("_pos")
    big = F.lit(r * (q + 1))
    fold = F.when(p <= big, F.floor((p - 1) / F.lit(q + 1)) + 1).otherwise(
        F.lit(r) + F.floor((p - big - 1) / F.lit(max(q, 1))) + 1)
    return pos.withColumn("fold", fold.cast("bigint")).drop("_pos")


def _combine(parts: list[dict]) -> dict:
    n = sum(p["n"] for p in parts)
    mean = sum(p["n"] * p["means"] for p in parts) / n
    m = len(mean)
    C = np.zeros((m, m))
    for p in parts:
        d = p["means"] - mean
        k = p["xtx"].shape[0]
        full = np.zeros((m, m))
        full[:k, :k] = p["xtx"]
        full[:k, k] = full[k, :k] = p["xty"]
        full[k, k] = p["yty"]
        C += full + p["n"] * np.outer(d, d)
    k = m - 1
    return {"n": n, "means": mean, "xtx": C[:k, :k], "xty": C[:k, k], "yty": C[k, k]}


def cv_r2(folded: DataFrame, xs: Sequence[str], y: str, k: int = 5, alphas=(0.0,)) -> list[tuple]:
    """Per-fold R² for each alpha from ONE pass of per-fold Gram
    matrices (train = all folds but one; SST about the test fold's mean)."""
    per = linalg.gram(folded, xs, y, group="fold")
    out = []
    for a in alphas:
        for f in sorted(per):
            train = _combine([per[g] for g in per if g != f])
            beta, icpt = linalg.solve_ridge(train, a)
            t = per[f]
            kk = len(xs)
            d = t["means"][kk] - icpt - t["means"][:kk] @ beta
            sse = t["yty"] - 2 * beta @ t["xty"] + beta @ t["xtx"] @ beta + t["n"] * d * d
            out.append((float(a), int(f), float(1 - sse / t["yty"]) if t["yty"] else float("nan")))
    return out


def choose_model(cv: list[tuple]) -> float:
    """Ridge (alpha > 0) only if its mean CV R² is strictly better."""
    by = {}
    for a, _f, r2 in cv:
        by.setdefault(a, []).append(r2)
    base = np.mean(by[0.0])
    best = 0.0
    for a, v in by.items():
        if a > 0 and np.mean(v) > base:
            best, base = a, np.mean(v)
    return best


def single_slopes(df: DataFrame, feats: Sequence[str], y: str) -> DataFrame:
    """One-predictor slopes of y on each feature: ``(feature, coef)``."""
    agg = df.agg(*[F.regr_slope(y, c).alias(c) for c in feats])
    return agg.unpivot([], list(feats), "feature", "coef")


def coef_interpretation(coefs: DataFrame) -> DataFrame:
    """Unit per feature by name (salary +$1,000; assessment +0.1; GMAT
    +10; GPA +0.1; else +1) and the effect of one unit (coef x unit), ranked
    by |coef|.  The reference prints coef/1000 for salaries; the effect of
    +$1,000 is coef x 1000, which is what ``per_unit`` holds."""
    f = F.lower("feature")
    unit = (F.when(f.contains("salary"), F.lit(1000.0)).when(f.contains("assessment"), F.lit(0.1))
            .when(f.contains("gmat"), F.lit(10.0)).when(f.contains("gpa"), F.lit(0.1)).otherwise(F.lit(1.0)))
    w = Window.orderBy(F.desc(F.abs("coef")), "feature")  # over the p-row coefficient table
    return coefs.select("feature", "coef", unit.alias("unit"), (F.col("coef") * unit).alias("per_unit"),
                        F.row_number().over(w).cast("bigint").alias("magnitude_rank"))


def gap_to_target(feat: DataFrame, coefs: DataFrame, rank_col: str, band: tuple[int, int], focus: Column,
                  feats: Sequence[str]) -> DataFrame:
    """Per feature the focus value, the band mean, gap = mean − focus,
    impact = gap x coef and priority (impact < 0 STRENGTH, |impact| > 1
    HIGH, else MODERATE), sorted by impact."""
    inb = F.col(rank_col).between(*band)
    agg = feat.agg(*[F.avg(F.when(inb, F.col(c))).alias(f"b_{c}") for c in feats],
                   *[F.max(F.when(focus, F.col(c))).alias(f"f_{c}") for c in feats])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"f_{c}").cast("double").alias("focus_value"),
                              F.col(f"b_{c}").cast("double").alias("band_mean")) for c in feats])
    long = agg.select(F.inline(rows))
    j = long.join(coefs, "feature")
    gap = F.col("band_mean") - F.col("focus_value")
    impact = gap * F.col("coef")
    prio = F.when(impact < 0, "STRENGTH").when(F.abs(impact) > 1, "HIGH").otherwise("MODERATE")
    return j.select("feature", "focus_value", "band_mean", gap.alias("gap"), "coef", impact.alias("impact"),
                    prio.alias("priority")).orderBy(F.desc("impact"))


def gap_totals(gaps: DataFrame) -> DataFrame:
    """Total positive, negative and net impact."""
    return gaps.agg(
        F.coalesce(F.sum(F.when(F.col("impact") > 0, F.col("impact"))), F.lit(0.0)).alias("positive"),
        F.coalesce(F.sum(F.when(F.col("impact") < 0, F.col("impact"))), F.lit(0.0)).alias("negative"),
        F.coalesce(F.sum("impact"), F.lit(0.0)).alias("net"),
    )


def predict(df: DataFrame, coefs: dict[str, float], intercept: float) -> DataFrame:
    """prediction = intercept + sum(coef x feature)."""
    return df.withColumn("prediction", linalg.linear_expr(list(coefs), list(coefs.values()), intercept))


def scenario_validate(spark, scenarios, model_features: Sequence[str]) -> DataFrame:
    """Every scenario line marked kept / unknown_feature (reported, not
    silently dropped); scenarios left with no known feature are dropped by
    ``what_if``."""
    sc = spark.createDataFrame(scenarios, "scenario string, feature string, value double, delta double")
    known = spark.createDataFrame([(f,) for f in model_features], "feature string")
    kept = sc.join(known, "feature", "left_semi").withColumn("status", F.lit("kept"))
    unk = sc.join(known, "feature", "left_anti").withColumn("status", F.lit("unknown_feature"))
    return kept.unionByName(unk).select("scenario", "feature", "status")


def what_if(focus_rows: DataFrame, key: str, scenarios, coefs: dict[str, float], intercept: float) -> DataFrame:
    """For each scenario, set (``value``) or shift (``delta``) the listed
    features, re-predict, and report the change against the baseline.
    Unknown features are ignored; a scenario with none known is dropped.
    The scenario list is a small input: one expression per scenario."""
    base = linalg.linear_expr(list(coefs), list(coefs.values()), intercept)
    by: dict[str, dict[str, tuple]] = {}
    order: list[str] = []
    for name, feat, value, delta in scenarios:
        if feat not in coefs:
            continue
        if name not in by:
            order.append(name)
        by.setdefault(name, {})[feat] = (value, delta)
    preds = []
    for name in order:
        e = F.lit(float(intercept))
        for f, b in coefs.items():
            v, d = by[name].get(f, (None, None))
            x = F.lit(float(v)) if v is not None else (F.col(f) + F.lit(float(d)) if d is not None else F.col(f))
            e = e + x * F.lit(float(b))
        preds.append(F.struct(F.lit(len(preds) + 1).alias("step"), F.lit(name).alias("scenario"), e.alias("prediction")))
    if not preds:
        return focus_rows.sparkSession.createDataFrame([], "step int, scenario string, baseline double, prediction double, delta double")
    out = focus_rows.select(key, base.alias("baseline"), F.inline(F.array(*preds)))
    return out.withColumn("delta", F.col("prediction") - F.col("baseline"))


def nearest_rank(feat: DataFrame, whatif: DataFrame, score: str, rank_col: str, band: tuple[int, int]) -> DataFrame:
    """Estimated rank of each scenario = rank of the entity whose actual
    score is nearest the predicted one (lower rank on ties); in-band flag.

    The k scenario predictions are metadata; the entity table is scanned once
    with k ``min_by`` aggregates (no pairing of entities with scenarios)."""
    preds = [(r["scenario"], r["prediction"]) for r in whatif.select("scenario", "prediction").collect()]
    if not preds:
        return feat.sparkSession.createDataFrame([], "scenario string, prediction double, est_rank bigint, in_band boolean")
    aggs = [F.min_by(F.col(rank_col), F.struct(F.abs(F.col(score) - F.lit(p)), F.col(rank_col))).alias(f"r{i}")
            for i, (_, p) in enumerate(preds)]
    row = feat.agg(*aggs)
    items = F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(p).alias("prediction"),
                               F.col(f"r{i}").cast("bigint").alias("est_rank")) for i, (s, p) in enumerate(preds)])
    return row.select(F.inline(items)).withColumn("in_band", F.col("est_rank").between(*band))


def waterfall(whatif: DataFrame) -> DataFrame:
    """Start (baseline), one step per lever with its delta and running
    total, end.  The lever table is small; the running sum is a window over
    it alone."""
    w = Window.orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    base = whatif.agg(F.first("baseline").alias("baseline"))
    steps = whatif.select("step", F.col("scenario").alias("label"), "delta", "baseline")
    steps = steps.withColumn("running", F.col("baseline") + F.sum("delta").over(w)).drop("baseline")
    start = base.select(F.lit(0).alias("step"), F.lit("start").alias("label"), F.lit(0.0).alias("delta"),
                        F.col("baseline").alias("running"))
    last = steps.agg(F.max("step").alias("s"), F.max_by("running", "step").alias("r"))
    end = last.select((F.col("s") + 1).alias("step"), F.lit("end").alias("label"), F.lit(0.0).alias("delta"),
                      F.col("r").alias("running"))
    return start.unionByName(steps).unionByName(end)


def recommendations(feat: DataFrame, rank_col: str, band: tuple[int, int], focus: Column,
                    metrics: Sequence[str]) -> DataFrame:
    """Per metric the focus value, the band mean and minimum and an
    AT/ABOVE or BELOW label."""
    inb = F.col(rank_col).between(*band)
    agg = feat.agg(*[F.max(F.when(focus, F.col(m))).alias(f"c_{m}") for m in metrics],
                   *[F.avg(F.when(inb, F.col(m))).alias(f"a_{m}") for m in metrics],
                   *[F.min(F.when(inb, F.col(m))).alias(f"n_{m}") for m in metrics])
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"c_{m}").cast("double").alias("current"),
                              F.col(f"a_{m}").cast("double").alias("band_mean"),
                              F.col(f"n_{m}").cast("double").alias("band_min")) for m in metrics])
    out = agg.select(F.inline(rows))
    return out.withColumn("status", F.when(F.col("current") >= F.col("band_mean"), "AT/ABOVE").otherwise("BELOW"))


def distance_contribution(point: DataFrame, centroid: DataFrame, feats: Sequence[str], top: int = 15) -> DataFrame:
    """Per feature (x − c)², its share of the total (%), direction;
    top ``top`` by contribution.  ``point`` and ``centroid`` are one row."""
    p = unpivot(point, feats).withColumnRenamed("value", "x")
    c = unpivot(centroid, feats).withColumnRenamed("value", "c")
    j = p.join(c, "feature").withColumn("sq", (F.col("x") - F.col("c")) ** 2)
    w = Window.partitionBy(F.lit(1))  # over the p-row feature table
    j = j.withColumn("pct", F.col("sq") * 100.0 / F.sum("sq").over(w))
    j = j.withColumn("direction", F.when(F.col("x") < F.col("c"), "below").when(F.col("x") > F.col("c"), "above").otherwise("at"))
    return j.orderBy(F.desc("sq"), "feature").limit(top)
