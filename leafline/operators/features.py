"""E — feature engineering on an entity table (one row per entity).

Everything is column expressions or single aggregates, except where order
matters globally (ranks, medians): those use one range-partitioned sort
with per-partition offsets, never a window without a partition key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafline.operators import linalg
from leafline.session import materialise

# ------------------------------------------------------------------ ranks

_LOW33 = (1 << 33) - 1


def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_no",
                      partitions: int | None = None) -> DataFrame:
    """1-based position of every row in a total order, computed distributed.

    Rows are range-partitioned and sorted within partitions; the position
    inside a partition comes from ``monotonically_increasing_id`` (which
    numbers rows in partition order), the partition's start from the row
    counts of the partitions before it (one row per partition: metadata,
    broadcast).  Range bounds come from a sample that Spark draws anew for
    each evaluation, so the numbered rows are written once and both the
    counts and the result read that table: they cannot disagree.
    ``order`` must be a total order (end with a unique key)."""
    from leafline.operators.audit import work_partitions

    n = partitions or work_partitions(df)
    s = df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id())
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).withColumn("_idx", F.col("_mid").bitwiseAND(F.lit(_LOW33)))
    s = materialise(s.drop("_mid"), "ranked")
    counts = s.groupBy("_pid").agg(F.count("*").alias("_cnt"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_cnt").over(w), F.lit(0)).alias("_off"))
    return s.join(F.broadcast(offsets), "_pid").withColumn(name, F.col("_off") + F.col("_idx") + 1).drop(
        "_pid", "_idx", "_off"
    )


def exact_medians(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Exact median of each column (NULLs ignored): ``(feature, median)``.

    One sort of the long (feature, value) table; the middle element(s) are
    picked by position, so no column is gathered into one task."""
    long = unpivot(df, cols).where(F.col("value").isNotNull())
    ranked = global_row_number(long, [F.col("feature"), F.col("value")], "_g")
    bounds = ranked.groupBy("feature").agg(F.min("_g").alias("_start"), F.count("*").alias("_n"))
    r = ranked.join(F.broadcast(bounds), "feature").withColumn("_pos", F.col("_g") - F.col("_start"))
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.floor(F.col("_n") / 2)
    mid = r.where((F.col("_pos") == lo) | (F.col("_pos") == hi))
    return mid.groupBy("feature").agg(F.avg("value").alias("median"))


def unpivot(df: DataFrame, cols: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Wide -> long ``(ids..., feature, value double)``."""
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        list(ids), list(cols), "feature", "value"
    )


# ------------------------------------------------------------------ E1-E10

def focus_flag(name: Column, needle: str) -> Column:
    """Case-insensitive contains; NULL name -> False."""
    return F.coalesce(F.lower(name).contains(needle.lower()), F.lit(False))


def missingness(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Missing percentage per column, its bucket and imputation tier."""
    n = F.count(F.lit(1))
    agg = df.agg(*[(F.count_if(F.col(c).isNull()) * 100.0 / n).alias(c) for c in cols])
    long = agg.unpivot([], list(cols), "feature", "missing_pct")
    p = F.col("missing_pct")
    bucket = F.when(p < 10, "<10%").when(p < 35, "10-35%").when(p < 60, "35-60%").otherwise(">=60%")
    tier = F.when(p < 10, "median").when(p < 35, "knn").otherwise("handled")
    return long.select("feature", "missing_pct", bucket.alias("bucket"), tier.alias("tier"))


def non_numeric_values(df: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Non-null values that are not numbers."""
    long = df.select(key, *[F.col(c).cast("string").alias(c) for c in cols]).unpivot([key], list(cols), "feature", "value")
    return long.where(F.col("value").isNotNull() & F.col("value").try_cast("double").isNull())


def parse_amount(val: Column, per_credit_multiplier: float = 60.0) -> Column:
    """E5: "per credit" (checked first) -> number x multiplier; contains "/"
    -> the last part; else the number.  Commas removed; a "$" is not removed,
    so "$2,128" does not parse (NULL), as in the reference."""
    s = F.trim(val.cast("string"))
    per = F.lower(s).contains("per credit")
    first_tok = F.regexp_extract(F.regexp_replace(s, ",", ""), "^\\s*(\\S+)", 1)
    last_part = F.element_at(F.split(s, "/"), -1)
    return (
        F.when(val.isNull(), F.lit(None).cast("double"))
        .when(per, first_tok.try_cast("double") * F.lit(per_credit_multiplier))
        .when(s.contains("/"), F.regexp_replace(F.trim(last_part), ",", "").try_cast("double"))
        .otherwise(F.regexp_replace(s, ",", "").try_cast("double"))
    )


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Every column to double, invalid -> NULL."""
    return df.select(*[F.col(c).cast("string").try_cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def missing_cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Total missing cells over the columns (one aggregate)."""
    total = sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0))
    return df.agg(total.cast("bigint").alias("missing_cells"), F.count(F.lit(1)).alias("rows"))


def ratio_lift(e0: Column, e3: Column) -> Column:
    """(e3 − e0) / (1 − e0); a zero denominator gives NULL."""
    return F.try_divide(e3 - e0, F.nullif(F.lit(1.0) - e0, F.lit(0.0)))


def safe_ratio(a: Column, b: Column) -> Column:
    """A / b with b = 0 -> NULL."""
    return F.try_divide(a, F.nullif(b, F.lit(0)))


def cross_fill(df: DataFrame, a: str, b: str) -> DataFrame:
    """Fill each column from the other, both from the original values."""
    return df.withColumns({a: F.coalesce(F.col(a), F.col(b)), b: F.coalesce(F.col(b), F.col(a))})


def regression_impute(df: DataFrame, y: str, xs: Sequence[str], min_rows: int = 5):
    """OLS of y on xs over rows with all present; fill y only where it is
    missing and every predictor is present.  Returns (frame, info) where
    info has the coefficients and the training R²; fewer than ``min_rows``
    complete rows -> unchanged."""
    g = linalg.gram(df, xs, y)[None]
    if g["n"] < min_rows:
        return df, {"n": g["n"], "skipped": True}
    beta, icpt = linalg.solve_ridge(g, 0.0)
    pred = linalg.linear_expr(xs, beta, icpt)
    have = F.lit(True)
    for c in xs:
        have = have & F.col(c).isNotNull()
    out = df.withColumn(y, F.when(F.col(y).isNull() & have, pred).otherwise(F.col(y)))
    return out, {"n": g["n"], "beta": beta, "intercept": icpt, "r2": linalg.r2_from_gram(g, beta), "skipped": False}


def median_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Remaining NULLs -> the column's exact median.  The medians are
    p numbers (metadata): computed distributed, then used as literals."""
    med = {r["feature"]: r["median"] for r in exact_medians(df, cols).collect()}
    return df.select(*[F.coalesce(F.col(c), F.lit(med.get(c))).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ------------------------------------------------------------------ E13-E20

def correlation_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair i < j over pairwise-complete rows, long
    form ``(feature_i, feature_j, n, r)``; NULL when a side is constant.
    One pass of shifted moments (shift = column mean)."""
    shift = linalg.column_means(df, cols)
    aggs = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x = F.when(both, F.col(a) - F.lit(shift[a]))
            y = F.when(both, F.col(b) - F.lit(shift[b]))
            tag = f"{i}_{cols.index(b)}"
            aggs += [F.count(x).alias(f"n_{tag}"), F.sum(x).alias(f"sx_{tag}"), F.sum(y).alias(f"sy_{tag}"),
                     F.sum(x * x).alias(f"xx_{tag}"), F.sum(y * y).alias(f"yy_{tag}"), F.sum(x * y).alias(f"xy_{tag}")]
    wide = df.agg(*aggs)
    rows = []
    for i, a in enumerate(cols):
        for b in cols[i + 1:]:
            tag = f"{i}_{cols.index(b)}"
            n = F.col(f"n_{tag}")
            cxy = F.col(f"xy_{tag}") - F.col(f"sx_{tag}") * F.col(f"sy_{tag}") / n
            cxx = F.col(f"xx_{tag}") - F.col(f"sx_{tag}") * F.col(f"sx_{tag}") / n
            cyy = F.col(f"yy_{tag}") - F.col(f"sy_{tag}") * F.col(f"sy_{tag}") / n
            r = F.try_divide(cxy, F.nullif(F.sqrt(cxx * cyy), F.lit(0.0)))
            rows.append(F.struct(F.lit(a).alias("feature_i"), F.lit(b).alias("feature_j"), n.alias("n"),
                                 F.when(n > 1, F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))).alias("r")))
    return wide.select(F.inline(F.array(*rows)))


def correlated_pairs(corr: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Pairs with |r| > threshold, strongest first (ties by names)."""
    return corr.where(F.abs("r") > threshold).orderBy(F.desc(F.abs("r")), "feature_i", "feature_j")


#: Which of two correlated columns goes: per rule the part of the dotted name it
#: looks at and the rank of each word; the larger rank goes.  A rule says
#: nothing where a name has no rank or both have the same.
DROP_RANKS = [
    ("name", {"two_yr_avg": 0, "": 1}),
    ("name", {"us_citizens": 1, "overall": 0}),
    ("leaf", {"low_": 1, "high_": 1, "average": 0}),
]


def drop_ranks(name: str) -> list[int | None]:
    """The column's rank under each rule: that of the first word it holds."""
    part = {"name": name, "leaf": name.rsplit(".", 1)[-1]}
    return [next((r for word, r in words.items() if word in part[scope]), None) for scope, words in DROP_RANKS]


def correlation_drop_list(pairs: list[tuple[str, str, float]], missing_pct: dict[str, float]) -> list[tuple[str, str]]:
    """``(dropped, kept)`` for the (metadata-sized) ordered pair list.

    Of a pair whose columns are both still there, the first rule that ranks them
    differently decides, then the larger missing share, then the second goes."""
    out: dict[str, str] = {}
    for first, second, _r in pairs:
        if first in out or second in out:
            continue
        signs = [x - y for x, y in zip(drop_ranks(first), drop_ranks(second)) if x is not None and y is not None]
        signs.append(missing_pct.get(first, 0.0) - missing_pct.get(second, 0.0))
        goes_first = next((s > 0 for s in signs if s), False)
        out.update({first: second} if goes_first else {second: first})
    return list(out.items())


def standardize(df: DataFrame, cols: Sequence[str]):
    """z = (x − mean) / std_pop; a zero std divides by 1.  Returns the
    frame and the fitted (mean, std) table (kept for E18)."""
    stats = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols], *[F.stddev_pop(c).alias(f"s_{c}") for c in cols])
    row = stats.first()
    params = {c: (row[f"m_{c}"], row[f"s_{c}"] if row[f"s_{c}"] else 1.0) for c in cols}
    out = df.select(*[((F.col(c) - F.lit(params[c][0])) / F.lit(params[c][1])).alias(c) if c in cols else F.col(c)
                      for c in df.columns])
    return out, params


def unstandardize(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """x = z · std + mean."""
    return df.select(*[(F.col(c) * F.lit(params[c][1]) + F.lit(params[c][0])).alias(c) if c in params else F.col(c)
                       for c in df.columns])


def pca_scores(df: DataFrame, cols: Sequence[str], n_components: int = 2):
    """Scores of the first components as expressions; returns the
    frame with ``pc1..`` and the fit (eigenvalues, ratios, loadings)."""
    fit = linalg.pca(df, cols)
    exprs = []
    for k in range(n_components):
        e = F.lit(0.0)
        for j, c in enumerate(cols):
            e = e + (F.col(c) - F.lit(float(fit["means"][j]))) * F.lit(float(fit["components"][k][j]))
        exprs.append(e.alias(f"pc{k + 1}"))
    return df.select("*", *exprs), fit


def n_components_for(cumulative, level: float) -> int:
    """First count of components whose cumulative ratio reaches ``level``."""
    for i, v in enumerate(cumulative):
        if v >= level:
            return i + 1
    return len(cumulative)
