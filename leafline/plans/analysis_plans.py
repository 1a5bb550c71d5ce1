"""Registered queries for groups E (features) and R (regression, gaps,
what-if) over the customer feature table (``customer_features``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leafline.functions.stats import exact_avg
from leafline.operators import features as E
from leafline.operators import linalg
from leafline.operators import strategy as R
from leafline.operators.pivots import knn_impute
from leafline.sources.bindings import FEATURES, customer_features
from leafline.sources.tables import table

KEY = "c_custkey"
FOCUS = "Customer#000000042"
TARGET = "spend"
BAND = (45, 55)
DENSE = ["n_orders", "spend", "avg_price", "lo", "hi"]        # never NULL
SPARSE = ["sf", "p1", "p12p", "p1f", "p5p"]                  # conditional means


def _feat(spark, sf):
    return customer_features(spark, sf)


def q_feature_projection(spark, sf):
    return _feat(spark, sf).select(KEY, "c_name", "c_mktsegment", "rank", *FEATURES)


def q_focus_lookup(spark, sf):
    return table(spark, sf, "customer").select(KEY, "c_name", E.focus_flag(F.col("c_name"), FOCUS.lower()).alias("focus"))


def q_missingness(spark, sf):
    return E.missingness(_feat(spark, sf), FEATURES)


def _amounts(spark, sf):
    """Stand-in amount texts in the reference's formats, one per part."""
    p = table(spark, sf, "part")
    whole = F.format_number(F.round("p_retailprice"), 0)
    k = F.col("p_size") % 5
    txt = (F.when(k == 0, whole)
           .when(k == 1, F.concat(F.round("p_retailprice").cast("bigint").cast("string"), F.lit(" per credit")))
           .when(k == 2, F.concat(F.lit("$"), whole, F.lit(" per credit")))
           .when(k == 3, F.concat(F.round("p_retailprice").cast("bigint").cast("string"), F.lit("/"), whole))
           .otherwise(F.col("p_type")))
    return p.select("p_partkey", txt.alias("amount"))


def q_non_numeric_values(spark, sf):
    return E.non_numeric_values(_amounts(spark, sf), "p_partkey", ["amount"])


def q_parse_amount(spark, sf):
    return _amounts(spark, sf).select("p_partkey", "amount", E.parse_amount(F.col("amount")).alias("value"))


def q_coerce_numeric(spark, sf):
    a = _amounts(spark, sf).withColumn("amount_raw", F.col("amount"))
    return E.missing_cells(E.coerce_numeric(a, ["amount"]), ["amount"])


def q_derived_features(spark, sf):
    f = _feat(spark, sf)
    share_f = F.col("n_f") / F.col("n_orders")
    share_o = F.col("n_o") / F.col("n_orders")
    return f.select(
        KEY,
        F.lower("c_mktsegment").contains("build").alias("is_private"),
        (F.col("hi") - F.col("lo")).alias("price_spread"),
        F.round(E.ratio_lift(share_f, share_o), 6).alias("lift"),
        F.round(E.safe_ratio(F.col("spend"), F.col("n_f")), 6).alias("spend_per_finished"),
    )


def q_cross_fill(spark, sf):
    return E.cross_fill(_feat(spark, sf), "p1", "p1f").select(KEY, "p1", "p1f")


def q_regression_impute(spark, sf):
    out, info = E.regression_impute(_feat(spark, sf), "p12p", ["n_orders", "avg_price", "hi"])
    return out.select(KEY, "p12p", F.lit(info.get("r2")).alias("train_r2"))


def q_regr_one(spark, sf):
    g = linalg.gram(_feat(spark, sf), ["avg_price"], "p12p")[None]
    beta, icpt = linalg.solve_ridge(g)
    spark_ = spark
    return spark_.createDataFrame(
        [(round(float(beta[0]), 6), round(icpt, 4), round(linalg.r2_from_gram(g, beta), 6), int(g["n"]))],
        "slope double, intercept double, r2 double, n bigint")


def q_median_fill(spark, sf):
    return E.exact_medians(_feat(spark, sf), FEATURES)


def q_median_filled(spark, sf):
    return E.median_fill(_feat(spark, sf), SPARSE).select(KEY, *SPARSE)


def q_knn_impute(spark, sf):
    """E11 over the whole feature matrix, five neighbours."""
    out = knn_impute(_feat(spark, sf).select(KEY, *FEATURES), KEY, FEATURES, 5)
    return out.select(KEY, *[F.round(c, 4).alias(c) for c in SPARSE])


def q_corr_matrix(spark, sf):
    c = E.correlation_long(_feat(spark, sf), FEATURES)
    return c.select("feature_i", "feature_j", "n", F.round("r", 6).alias("r"))


def q_corr_pairs(spark, sf):
    c = E.correlated_pairs(E.correlation_long(_feat(spark, sf), FEATURES), 0.85)
    return c.select("feature_i", "feature_j", F.round("r", 6).alias("r"))


def q_corr_drop_list(spark, sf):
    f = _feat(spark, sf)
    pairs = [(r["feature_i"], r["feature_j"], r["r"]) for r in
             E.correlated_pairs(E.correlation_long(f, FEATURES), 0.85).collect()]
    miss = {r["feature"]: r["missing_pct"] for r in E.missingness(f, FEATURES).collect()}
    rows = E.correlation_drop_list(pairs, miss)
    return spark.createDataFrame(rows or [], "dropped string, kept string")


def q_standardize(spark, sf):
    z, _ = E.standardize(_feat(spark, sf), DENSE)
    return z.select(KEY, *[F.round(c, 6).alias(c) for c in DENSE])


def q_unstandardize(spark, sf):
    f = _feat(spark, sf)
    z, params = E.standardize(f, DENSE)
    back = E.unstandardize(z, params).select(KEY, *[F.col(c).alias(f"b_{c}") for c in DENSE])
    j = f.select(KEY, *DENSE).join(back, KEY)
    err = F.greatest(*[F.abs(F.col(c) - F.col(f"b_{c}")) / F.greatest(F.abs(F.col(c)), F.lit(1.0)) for c in DENSE])
    return j.select(KEY, F.round(err, 9).alias("max_rel_error"))


def q_pca_covariance(spark, sf):
    cov, _, _ = linalg.covariance(_feat(spark, sf), DENSE)
    rows = [(a, b, float(cov[i, j])) for i, a in enumerate(DENSE) for j, b in enumerate(DENSE) if i <= j]
    df = spark.createDataFrame(rows, "feature_i string, feature_j string, cov double")
    return df.select("feature_i", "feature_j", F.round(F.col("cov") / F.lit(1e6), 4).alias("cov_millions"))


def q_pca_scores(spark, sf):
    z, _ = E.standardize(_feat(spark, sf), DENSE)
    scored, fit = E.pca_scores(z, DENSE, 2)
    return scored.select(KEY, F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"),
                         F.lit(E.n_components_for(fit["cumulative"], 0.8)).alias("n_for_80"),
                         F.lit(E.n_components_for(fit["cumulative"], 0.9)).alias("n_for_90"))


def q_pca_loadings(spark, sf):
    z, _ = E.standardize(_feat(spark, sf), DENSE)
    fit = linalg.pca(z, DENSE)
    rows = [(f"PC{k + 1}", c, float(fit["components"][k][j])) for k in range(2) for j, c in enumerate(DENSE)]
    df = spark.createDataFrame(rows, "component string, feature string, loading double")
    from pyspark.sql import Window
    w = Window.partitionBy("component").orderBy(F.desc(F.abs("loading")), "feature")
    return df.withColumn("pos", F.row_number().over(w)).where("pos <= 15")


# ------------------------------------------------------------------ R

def q_target_band(spark, sf):
    return R.target_band(_feat(spark, sf), "rank", TARGET, BAND, F.col("c_name") == FOCUS)


def q_ols_simple(spark, sf):
    f = _feat(spark, sf)
    return f.agg(F.round(F.regr_slope(TARGET, "n_orders"), 4).alias("slope"),
                 F.round(F.regr_intercept(TARGET, "n_orders"), 2).alias("intercept"),
                 F.round(F.regr_r2(TARGET, "n_orders"), 6).alias("r2"),
                 F.regr_count(TARGET, "n_orders").alias("n"))


def q_ols_fit(spark, sf):
    fit = R.fit_linear(_feat(spark, sf), ["n_orders", "avg_price", "hi", "lo"], TARGET)
    return R.coefficient_frame(spark, fit)


def q_ridge_fit(spark, sf):
    z, _ = E.standardize(_feat(spark, sf), ["n_orders", "avg_price", "hi", "lo"])
    fit = R.fit_linear(z, ["n_orders", "avg_price", "hi", "lo"], TARGET, alpha=1.0)
    return R.coefficient_frame(spark, fit)


def q_cv_folds(spark, sf):
    return R.cv_folds(_feat(spark, sf).select(KEY, "rank"), "rank", 5).select(KEY, "rank", "fold")


def q_cv_r2(spark, sf):
    f = R.cv_folds(_feat(spark, sf), "rank", 5)
    res = R.cv_r2(f, ["n_orders", "avg_price", "hi", "lo"], TARGET, 5, alphas=(0.0, 1.0))
    return spark.createDataFrame(res, "alpha double, fold int, r2 double")


def q_model_choice(spark, sf):
    """Ridge only if its mean R² over the folds is strictly better; one
    standardised predictor, so that SQL can follow."""
    z, _ = E.standardize(_feat(spark, sf), ["avg_price"])
    res = R.cv_r2(R.cv_folds(z, "rank", 5), ["avg_price"], TARGET, 5, alphas=(0.0, 50.0))
    best = R.choose_model(res)
    return spark.createDataFrame([(a, f, round(r, 6), best) for a, f, r in res], "alpha double, fold bigint, r2 double, chosen double")


def _slopes(spark, sf):
    return R.single_slopes(_feat(spark, sf), DENSE[:1] + DENSE[2:], TARGET)


def q_coef_interpretation(spark, sf):
    return R.coef_interpretation(_slopes(spark, sf)).select(
        "feature", F.round("coef", 6).alias("coef"), "unit", F.round("per_unit", 6).alias("per_unit"), "magnitude_rank")


def q_gap_to_target(spark, sf):
    g = R.gap_to_target(_feat(spark, sf), _slopes(spark, sf), "rank", BAND, F.col("c_name") == FOCUS,
                        DENSE[:1] + DENSE[2:])
    return g.select("feature", F.round("focus_value", 4).alias("focus_value"), F.round("band_mean", 4).alias("band_mean"),
                    F.round("gap", 4).alias("gap"), F.round("impact", 2).alias("impact"), "priority")


def q_gap_totals(spark, sf):
    g = R.gap_to_target(_feat(spark, sf), _slopes(spark, sf), "rank", BAND, F.col("c_name") == FOCUS,
                        DENSE[:1] + DENSE[2:])
    return R.gap_totals(g).select(*[F.round(c, 2).alias(c) for c in ("positive", "negative", "net")])


def _simple_model(spark, sf):
    f = _feat(spark, sf)
    row = f.agg(F.regr_slope(TARGET, "n_orders").alias("b"), F.regr_intercept(TARGET, "n_orders").alias("a")).first()
    return f, {"n_orders": row["b"]}, row["a"]


def q_predict(spark, sf):
    f, coefs, icpt = _simple_model(spark, sf)
    return R.predict(f, coefs, icpt).select(KEY, F.round("prediction", 2).alias("prediction"))


SCENARIOS = [("orders_plus_5", "n_orders", None, 5.0), ("orders_30", "n_orders", 30.0, None),
             ("price_up", "avg_price", 300000.0, None), ("orders_12_and_price", "n_orders", 12.0, None),
             ("orders_12_and_price", "avg_price", 250000.0, None), ("unknown_only", "gmat", 700.0, None)]


def q_scenario_validate(spark, sf):
    """R12 with the number of entities that have each feature."""
    have = E.unpivot(_feat(spark, sf), FEATURES).where(F.col("value").isNotNull()).groupBy(
        F.col("feature").alias("_f")).agg(F.count("*").alias("_n"))
    v = R.scenario_validate(spark, SCENARIOS, ["n_orders"])
    return v.join(have, F.col("feature") == F.col("_f"), "left").select(
        "scenario", "feature", "status", F.coalesce("_n", F.lit(0)).alias("n_entities"))


def q_what_if(spark, sf):
    f, coefs, icpt = _simple_model(spark, sf)
    w = R.what_if(f.where(F.col("c_name") == FOCUS), KEY, SCENARIOS, coefs, icpt)
    return w.select("scenario", F.round("baseline", 2).alias("baseline"), F.round("prediction", 2).alias("prediction"),
                    F.round("delta", 2).alias("delta"))


def q_nearest_rank(spark, sf):
    f, coefs, icpt = _simple_model(spark, sf)
    w = R.what_if(f.where(F.col("c_name") == FOCUS), KEY, SCENARIOS, coefs, icpt)
    return R.nearest_rank(f, w, TARGET, "rank", BAND)


def q_waterfall(spark, sf):
    f, coefs, icpt = _simple_model(spark, sf)
    w = R.what_if(f.where(F.col("c_name") == FOCUS), KEY, SCENARIOS, coefs, icpt)
    return R.waterfall(w).select("step", "label", F.round("delta", 2).alias("delta"), F.round("running", 2).alias("running"))


def q_recommendations(spark, sf):
    r = R.recommendations(_feat(spark, sf), "rank", BAND, F.col("c_name") == FOCUS, ["n_orders", "avg_price", "hi"])
    return r.select("metric", F.round("current", 4).alias("current"), F.round("band_mean", 4).alias("band_mean"),
                    F.round("band_min", 4).alias("band_min"), "status")


QUERIES = {
    "feature_projection": q_feature_projection,
    "focus_lookup": q_focus_lookup,
    "missingness": q_missingness,
    "non_numeric_values": q_non_numeric_values,
    "parse_amount": q_parse_amount,
    "coerce_numeric": q_coerce_numeric,
    "derived_features": q_derived_features,
    "cross_fill": q_cross_fill,
    "regression_impute": q_regression_impute,
    "regr_one": q_regr_one,
    "median_fill": q_median_fill,
    "median_filled": q_median_filled,
    "knn_impute": q_knn_impute,
    "corr_matrix": q_corr_matrix,
    "corr_pairs": q_corr_pairs,
    "corr_drop_list": q_corr_drop_list,
    "standardize": q_standardize,
    "unstandardize": q_unstandardize,
    "pca_covariance": q_pca_covariance,
    "pca_scores": q_pca_scores,
    "pca_loadings": q_pca_loadings,
    "target_band": q_target_band,
    "ols_simple": q_ols_simple,
    "ols_fit": q_ols_fit,
    "ridge_fit": q_ridge_fit,
    "cv_folds": q_cv_folds,
    "cv_r2": q_cv_r2,
    "coef_interpretation": q_coef_interpretation,
    "gap_to_target": q_gap_to_target,
    "gap_totals": q_gap_totals,
    "predict": q_predict,
    "scenario_validate": q_scenario_validate,
    "model_choice": q_model_choice,
    "what_if": q_what_if,
    "nearest_rank": q_nearest_rank,
    "waterfall": q_waterfall,
    "recommendations": q_recommendations,
}

# ------------------------------------------------------------------ oracles

FEAT_SQL = """
feat0 AS (
  SELECT o_custkey AS c_custkey, count(*) AS n_orders,
    sum(CAST(o_totalprice AS DECIMAL(38,2)))::DOUBLE AS spend,
    sum(CAST(o_totalprice AS DECIMAL(38,2)))::DOUBLE / count(*) AS avg_price,
    min(o_totalprice) AS lo, max(o_totalprice) AS hi,
    sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS DECIMAL(38,2)))::DOUBLE
      / count(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS sf,
    sum(CAST(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END AS DECIMAL(38,2)))::DOUBLE
      / count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS p1,
    sum(CAST(CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END AS DECIMAL(38,2)))::DOUBLE
      / count(CASE WHEN o_orderstatus = 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice END) AS p12p,
    sum(CAST(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice END AS DECIMAL(38,2)))::DOUBLE
      / count(CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN o_totalprice END) AS p1f,
    sum(CAST(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND year(o_orderdate) >= 1998 THEN o_totalprice END AS DECIMAL(38,2)))::DOUBLE
      / count(CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AND year(o_orderdate) >= 1998 THEN o_totalprice END) AS p5p,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o
  FROM orders GROUP BY o_custkey
),
feat AS (
  SELECT c.c_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, c.c_acctbal, f.*  EXCLUDE (c_custkey),
         row_number() OVER (ORDER BY f.spend DESC, c.c_custkey) AS rank
  FROM customer c JOIN feat0 f ON f.c_custkey = c.c_custkey
)"""

_F = ", ".join(FEATURES)
_FOCUS = f"c_name = '{FOCUS}'"


def _band_stats(cols):
    return ", ".join(f"avg({c}) AS {c}" for c in cols)


def _knn_sql(k: int = 5) -> str:
    """E11 by brute force: every pair of rows per column that the one lacks and the other has."""
    sq = " + ".join(f"coalesce((r.{c} - d.{c}) * (r.{c} - d.{c}), 0.0)" for c in FEATURES)
    shared = " + ".join(f"CASE WHEN r.{c} - d.{c} IS NULL THEN 0 ELSE 1 END" for c in FEATURES)
    parts = ", ".join(
        f"""{c}_n AS (SELECT r.c_custkey, d.{c} AS v, sqrt(({sq}) * {len(FEATURES)} / ({shared})) AS dist FROM f r JOIN f d
            ON r.{c} IS NULL AND d.{c} IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY r.c_custkey ORDER BY dist, d.c_custkey) <= {k}),
        {c}_f AS (SELECT c_custkey, coalesce(avg(v) FILTER (WHERE dist = 0),
            sum(v / nullif(dist, 0)) / sum(1 / nullif(dist, 0))) AS v FROM {c}_n GROUP BY c_custkey)""" for c in SPARSE)
    cols = ", ".join(f"round(coalesce(f.{c}, {c}_f.v, (SELECT avg({c}) FROM f)), 4) AS {c}" for c in SPARSE)
    joins = " ".join(f"LEFT JOIN {c}_f ON {c}_f.c_custkey = f.c_custkey" for c in SPARSE)
    doubles = ", ".join(f"{c}::DOUBLE AS {c}" for c in FEATURES)
    return f"WITH {FEAT_SQL}, f AS (SELECT c_custkey, {doubles} FROM feat), {parts} SELECT f.c_custkey, {cols} FROM f {joins}"


ORACLES = {
    "feature_projection": "WITH " + FEAT_SQL + f" SELECT c_custkey, c_name, c_mktsegment, rank, {_F} FROM feat",
    "focus_lookup": f"SELECT c_custkey, c_name, coalesce(contains(lower(c_name), lower('{FOCUS}')), false) AS focus FROM customer",
    "missingness": "WITH " + FEAT_SQL + ", m AS (UNPIVOT (SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) * 100.0 / count(*) AS {c}" for c in FEATURES) + """ FROM feat)
        ON """ + _F + """ INTO NAME feature VALUE missing_pct)
        SELECT feature, missing_pct::DOUBLE AS missing_pct,
               CASE WHEN missing_pct < 10 THEN '<10%' WHEN missing_pct < 35 THEN '10-35%' WHEN missing_pct < 60 THEN '35-60%' ELSE '>=60%' END AS bucket,
               CASE WHEN missing_pct < 10 THEN 'median' WHEN missing_pct < 35 THEN 'knn' ELSE 'handled' END AS tier FROM m""",
    "corr_matrix": None,
    "corr_pairs": None,
    "standardize": "WITH " + FEAT_SQL + " SELECT c_custkey, " + ", ".join(
        f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END, 6) AS {c}"
        for c in DENSE) + " FROM feat",
    "unstandardize": "SELECT o_custkey AS c_custkey, 0.0::DOUBLE AS max_rel_error FROM orders GROUP BY o_custkey",
    "pca_covariance": "WITH " + FEAT_SQL + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, round(covar_samp({a}, {b}) / 1e6, 4) AS cov_millions FROM feat"
        for i, a in enumerate(DENSE) for j, b in enumerate(DENSE) if i <= j) + ")",
    "median_fill": "WITH " + FEAT_SQL + " SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, median({c})::DOUBLE AS median FROM feat" for c in FEATURES) + ")",
    "median_filled": "WITH " + FEAT_SQL + " SELECT c_custkey, " + ", ".join(
        f"coalesce({c}, (SELECT median({c}) FROM feat)) AS {c}" for c in SPARSE) + " FROM feat",
    "knn_impute": _knn_sql(),
    "cross_fill": "WITH " + FEAT_SQL + " SELECT c_custkey, coalesce(p1, p1f) AS p1, coalesce(p1f, p1) AS p1f FROM feat",
    "derived_features": "WITH " + FEAT_SQL + """
        SELECT c_custkey, contains(lower(c_mktsegment), 'build') AS is_private, hi - lo AS price_spread,
               round(CASE WHEN 1.0 - n_f / n_orders = 0 THEN NULL ELSE (n_o / n_orders - n_f / n_orders) / (1.0 - n_f / n_orders) END, 6) AS lift,
               round(CASE WHEN n_f = 0 THEN NULL ELSE spend / n_f END, 6) AS spend_per_finished FROM feat""",
    "regr_one": "WITH " + FEAT_SQL + """
        SELECT round(regr_slope(p12p, avg_price), 6) AS slope, round(regr_intercept(p12p, avg_price), 4) AS intercept,
               round(regr_r2(p12p, avg_price), 6) AS r2, regr_count(p12p, avg_price)::BIGINT AS n FROM feat""",
    "ols_simple": "WITH " + FEAT_SQL + """
        SELECT round(regr_slope(spend, n_orders), 4) AS slope, round(regr_intercept(spend, n_orders), 2) AS intercept,
               round(regr_r2(spend, n_orders), 6) AS r2, regr_count(spend, n_orders)::BIGINT AS n FROM feat""",
    "cv_folds": "WITH " + FEAT_SQL + " SELECT c_custkey, rank, ntile(5) OVER (ORDER BY rank) AS fold FROM feat",
    "target_band": "WITH " + FEAT_SQL + f"""
        SELECT count(*) AS n_in_band, min(spend) AS min_score, max(spend) AS max_score,
               sum(CAST(spend AS DECIMAL(38,2)))::DOUBLE / count(*) AS mean_score,
               (SELECT max(spend) FROM feat WHERE {_FOCUS}) AS focus_score,
               sum(CAST(spend AS DECIMAL(38,2)))::DOUBLE / count(*) - (SELECT max(spend) FROM feat WHERE {_FOCUS}) AS gap
        FROM feat WHERE rank BETWEEN {BAND[0]} AND {BAND[1]}""",
    "predict": "WITH " + FEAT_SQL + """, m AS (SELECT regr_slope(spend, n_orders) AS b, regr_intercept(spend, n_orders) AS a FROM feat)
        SELECT c_custkey, round(a + b * n_orders, 2) AS prediction FROM feat, m""",
    "scenario_validate": "WITH " + FEAT_SQL + ", h AS (" + " UNION ALL ".join(
        f"SELECT '{c}' AS f, count({c}) AS n FROM feat" for c in FEATURES) + """)
        SELECT t.*, coalesce(n, 0) AS n_entities FROM (VALUES ('orders_plus_5', 'n_orders', 'kept'), ('orders_30', 'n_orders', 'kept'),
                              ('price_up', 'avg_price', 'unknown_feature'), ('orders_12_and_price', 'n_orders', 'kept'),
                              ('orders_12_and_price', 'avg_price', 'unknown_feature'), ('unknown_only', 'gmat', 'unknown_feature'))
               t(scenario, feature, status) LEFT JOIN h ON h.f = t.feature""",
}

_CORR = "WITH " + FEAT_SQL + ", c AS (" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature_i, '{b}' AS feature_j, count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n, "
    f"round(CASE WHEN count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) > 1 THEN greatest(least(corr({a}, {b}), 1.0), -1.0) END, 6) AS r FROM feat"
    for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:]) + ")"
ORACLES["corr_matrix"] = _CORR + " SELECT * FROM c"
ORACLES["corr_pairs"] = _CORR + " SELECT feature_i, feature_j, r FROM c WHERE abs(r) > 0.85"


_AMOUNTS = """
amounts AS (
  SELECT p_partkey, CASE p_size % 5
      WHEN 0 THEN format('{:,}', CAST(round(p_retailprice) AS BIGINT))
      WHEN 1 THEN CAST(CAST(round(p_retailprice) AS BIGINT) AS VARCHAR) || ' per credit'
      WHEN 2 THEN '$' || format('{:,}', CAST(round(p_retailprice) AS BIGINT)) || ' per credit'
      WHEN 3 THEN CAST(CAST(round(p_retailprice) AS BIGINT) AS VARCHAR) || '/' || format('{:,}', CAST(round(p_retailprice) AS BIGINT))
      ELSE p_type END AS amount
  FROM part)"""
ORACLES["non_numeric_values"] = "WITH " + _AMOUNTS + """
    SELECT p_partkey, 'amount' AS feature, amount AS value FROM amounts WHERE TRY_CAST(amount AS DOUBLE) IS NULL"""
ORACLES["parse_amount"] = "WITH " + _AMOUNTS + r"""
    SELECT p_partkey, amount, CASE
        WHEN contains(lower(trim(amount)), 'per credit') THEN TRY_CAST(regexp_extract(replace(trim(amount), ',', ''), '^\s*(\S+)', 1) AS DOUBLE) * 60
        WHEN contains(amount, '/') THEN TRY_CAST(replace(trim(list_last(string_split(trim(amount), '/'))), ',', '') AS DOUBLE)
        ELSE TRY_CAST(replace(trim(amount), ',', '') AS DOUBLE) END AS value FROM amounts"""
ORACLES["coerce_numeric"] = "WITH " + _AMOUNTS + """
    SELECT count(*) FILTER (WHERE TRY_CAST(amount AS DOUBLE) IS NULL) AS missing_cells, count(*) AS rows FROM amounts"""

_GF = ["n_orders", "avg_price", "lo", "hi"]
_SLOPES = ", slopes AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, regr_slope(spend, {c}) AS coef FROM feat" for c in _GF) + ")"
ORACLES["coef_interpretation"] = "WITH " + FEAT_SQL + _SLOPES + """
    SELECT feature, round(coef, 6) AS coef, 1.0::DOUBLE AS unit, round(coef, 6) AS per_unit,
           row_number() OVER (ORDER BY abs(coef) DESC, feature) AS magnitude_rank FROM slopes"""
_GAPS = ", band AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, (SELECT max({c}) FROM feat WHERE {_FOCUS})::DOUBLE AS focus_value, "
    f"(SELECT avg({c}) FROM feat WHERE rank BETWEEN {BAND[0]} AND {BAND[1]})::DOUBLE AS band_mean" for c in _GF) + """),
gaps AS (SELECT b.feature, focus_value, band_mean, band_mean - focus_value AS gap, coef,
                (band_mean - focus_value) * coef AS impact FROM band b JOIN slopes s ON b.feature = s.feature)"""
ORACLES["gap_to_target"] = "WITH " + FEAT_SQL + _SLOPES + _GAPS + """
    SELECT feature, round(focus_value, 4) AS focus_value, round(band_mean, 4) AS band_mean, round(gap, 4) AS gap,
           round(impact, 2) AS impact,
           CASE WHEN impact < 0 THEN 'STRENGTH' WHEN abs(impact) > 1 THEN 'HIGH' ELSE 'MODERATE' END AS priority FROM gaps"""
ORACLES["gap_totals"] = "WITH " + FEAT_SQL + _SLOPES + _GAPS + """
    SELECT round(coalesce(sum(impact) FILTER (WHERE impact > 0), 0), 2) AS positive,
           round(coalesce(sum(impact) FILTER (WHERE impact < 0), 0), 2) AS negative,
           round(coalesce(sum(impact), 0), 2) AS net FROM gaps"""
_WHATIF = f""", m AS (SELECT regr_slope(spend, n_orders) AS b, regr_intercept(spend, n_orders) AS a FROM feat),
fo AS (SELECT n_orders FROM feat WHERE {_FOCUS}),
w AS (
  SELECT 1 AS step, 'orders_plus_5' AS scenario, a + b * fo.n_orders AS baseline, a + b * (fo.n_orders + 5) AS prediction FROM m, fo
  UNION ALL SELECT 2, 'orders_30', a + b * fo.n_orders, a + b * 30 FROM m, fo
  UNION ALL SELECT 3, 'orders_12_and_price', a + b * fo.n_orders, a + b * 12 FROM m, fo)"""
ORACLES["what_if"] = "WITH " + FEAT_SQL + _WHATIF + """
    SELECT scenario, round(baseline, 2) AS baseline, round(prediction, 2) AS prediction, round(prediction - baseline, 2) AS delta FROM w"""
ORACLES["nearest_rank"] = "WITH " + FEAT_SQL + _WHATIF + f"""
    SELECT scenario, prediction, est_rank, est_rank BETWEEN {BAND[0]} AND {BAND[1]} AS in_band FROM (
      SELECT scenario, prediction, (SELECT rank FROM feat ORDER BY abs(spend - w.prediction), rank LIMIT 1) AS est_rank FROM w)"""
ORACLES["waterfall"] = "WITH " + FEAT_SQL + _WHATIF + """
    SELECT 0 AS step, 'start' AS label, 0.0 AS delta, round(min(baseline), 2) AS running FROM w
    UNION ALL SELECT step, scenario, round(prediction - baseline, 2), round(baseline + sum(prediction - baseline) OVER (ORDER BY step), 2) FROM w
    UNION ALL SELECT 4, 'end', 0.0, round(min(baseline) + sum(prediction - baseline), 2) FROM w"""
ORACLES["recommendations"] = "WITH " + FEAT_SQL + " SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS metric, round((SELECT max({c}) FROM feat WHERE {_FOCUS})::DOUBLE, 4) AS current, "
    f"round((SELECT avg({c}) FROM feat WHERE rank BETWEEN {BAND[0]} AND {BAND[1]})::DOUBLE, 4) AS band_mean, "
    f"round((SELECT min({c}) FROM feat WHERE rank BETWEEN {BAND[0]} AND {BAND[1]})::DOUBLE, 4) AS band_min, "
    f"CASE WHEN (SELECT max({c}) FROM feat WHERE {_FOCUS}) >= (SELECT avg({c}) FROM feat WHERE rank BETWEEN {BAND[0]} AND {BAND[1]}) "
    f"THEN 'AT/ABOVE' ELSE 'BELOW' END AS status" for c in ["n_orders", "avg_price", "hi"]) + ")"

ORACLES["model_choice"] = "WITH " + FEAT_SQL + """, f AS (
    SELECT ntile(5) OVER (ORDER BY rank) AS fold, spend AS y,
           (avg_price - avg(avg_price) OVER ()) / stddev_pop(avg_price) OVER () AS x FROM feat),
  a AS (SELECT unnest([0.0, 50.0])::DOUBLE AS alpha),
  t AS (SELECT g.fold, avg(x) AS mx, avg(y) AS my, var_pop(x) * count(*) AS sxx, covar_pop(x, y) * count(*) AS sxy
        FROM f JOIN (SELECT DISTINCT fold FROM f) g ON f.fold <> g.fold GROUP BY g.fold),
  b AS (SELECT fold, alpha, mx, my, sxy / (sxx + alpha) AS beta FROM t, a),
  r AS (SELECT alpha, f.fold, 1 - sum((y - my - beta * (x - mx)) ** 2) / (var_pop(y) * count(*)) AS r2
        FROM f JOIN b ON f.fold = b.fold GROUP BY alpha, f.fold),
  m AS (SELECT avg(r2) FILTER (WHERE alpha = 0) AS m0, avg(r2) FILTER (WHERE alpha > 0) AS m1 FROM r)
  SELECT alpha, fold, round(r2, 6) AS r2, CASE WHEN m1 > m0 THEN 50.0 ELSE 0.0 END::DOUBLE AS chosen FROM r, m"""
ORACLES["corr_drop_list"] = "WITH RECURSIVE " + _CORR.removeprefix("WITH ") + ", ms AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS miss FROM feat" for c in FEATURES) + """),
  p AS (SELECT row_number() OVER (ORDER BY abs(r) DESC, feature_i, feature_j) AS i, feature_i AS a, feature_j AS b,
               CASE WHEN x.miss > y.miss THEN feature_i ELSE feature_j END AS victim
        FROM c JOIN ms x ON x.feature = feature_i JOIN ms y ON y.feature = feature_j WHERE abs(r) > 0.85),
  g(i, gone, dropped, kept) AS (
    SELECT 0::BIGINT, []::VARCHAR[], NULL::VARCHAR, NULL::VARCHAR
    UNION ALL
    SELECT p.i, CASE WHEN free THEN list_append(gone, victim) ELSE gone END,
           CASE WHEN free THEN victim END, CASE WHEN free THEN CASE WHEN victim = a THEN b ELSE a END END
    FROM (SELECT g.gone, p.*, NOT list_contains(g.gone, p.a) AND NOT list_contains(g.gone, p.b) AS free
          FROM g JOIN p ON p.i = g.i + 1) p)
  SELECT dropped, kept FROM g WHERE dropped IS NOT NULL"""
