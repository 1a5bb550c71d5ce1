"""P — peer profiling of a focus entity against its cluster and the next
cluster up ("aspiration").  All aggregates; cluster-level tables have one
row per cluster (metadata)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.operators.features import unpivot


def cluster_profile(assigned: DataFrame, cluster_col: str, rank_col: str, feats: Sequence[str]) -> DataFrame:
    """Per cluster count, "min-max" rank range, mean rank and the mean
    of every feature."""
    return assigned.groupBy(cluster_col).agg(
        F.count("*").alias("n"),
        F.format_string("%d-%d", F.min(rank_col), F.max(rank_col)).alias("rank_range"),
        F.avg(rank_col).alias("mean_rank"),
        *[F.avg(c).alias(c) for c in feats],
    )


def profile_transposed(profile: DataFrame, cluster_col: str, feats: Sequence[str], short: dict | None = None) -> DataFrame:
    """Features as rows, clusters as columns; only existing features;
    optional short names."""
    keep = [c for c in feats if c in profile.columns]
    long = profile.select(cluster_col, *keep).unpivot([cluster_col], keep, "feature", "value")
    if short:
        m = F.create_map(*[x for k, v in short.items() for x in (F.lit(k), F.lit(v))])
        long = long.withColumn("feature", F.coalesce(m[F.col("feature")], F.col("feature")))
    clusters = [r[0] for r in profile.select(cluster_col).distinct().orderBy(cluster_col).collect()]
    return long.groupBy("feature").pivot(cluster_col, clusters).agg(F.first("value"))


def peer_list(assigned: DataFrame, cluster_col: str, rank_col: str, cluster_id: int) -> DataFrame:
    """Members of one cluster by rank."""
    return assigned.where(F.col(cluster_col) == cluster_id).orderBy(rank_col)


def centroid_distance(point: DataFrame, centroids: DataFrame, cluster_col: str, feats: Sequence[str],
                      own: int, aspiration: int) -> DataFrame:
    """Euclidean distance of the focus to its own and the aspiration
    centroid, and their ratio (long form, no pairing beyond 1 x 2 rows)."""
    p = unpivot(point, feats).withColumnRenamed("value", "x")
    c = unpivot(centroids.where(F.col(cluster_col).isin(own, aspiration)), feats, [cluster_col]).withColumnRenamed("value", "c")
    d = p.join(c, "feature").groupBy(cluster_col).agg(F.sqrt(F.sum((F.col("x") - F.col("c")) ** 2)).alias("dist"))
    return d.agg(F.max(F.when(F.col(cluster_col) == own, F.col("dist"))).alias("dist_own"),
                 F.max(F.when(F.col(cluster_col) == aspiration, F.col("dist"))).alias("dist_aspiration")).withColumn(
        "ratio", F.try_divide(F.col("dist_aspiration"), F.nullif(F.col("dist_own"), F.lit(0.0))))


def peer_comparison(assigned: DataFrame, cluster_col: str, focus: Column, own: int, aspiration: int,
                    feats: Sequence[str]) -> DataFrame:
    """Per feature the focus value, the peer mean (the focus
    included) and the aspiration mean, with both differences.  One
    conditional-aggregate pass."""
    own_c, asp_c = F.col(cluster_col) == own, F.col(cluster_col) == aspiration
    agg = assigned.agg(*[F.max(F.when(focus, F.col(c))).alias(f"f_{c}") for c in feats],
                       *[F.avg(F.when(own_c, F.col(c))).alias(f"p_{c}") for c in feats],
                       *[F.avg(F.when(asp_c, F.col(c))).alias(f"a_{c}") for c in feats])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"f_{c}").cast("double").alias("focus"),
                              F.col(f"p_{c}").cast("double").alias("peer_mean"),
                              F.col(f"a_{c}").cast("double").alias("aspiration_mean")) for c in feats])
    out = agg.select(F.inline(rows))
    return out.withColumns({"vs_peer": F.col("focus") - F.col("peer_mean"),
                            "vs_aspiration": F.col("focus") - F.col("aspiration_mean")})


def metric_set_tables(comparison: DataFrame, metrics: DataFrame) -> DataFrame:
    """The comparison's features arranged by a metric dictionary.

    ``metrics`` has ``metric_set``, ``place``, ``metric`` (the shown name) and ``feature``; a feature may be in
    several sets, features the comparison lacks leave no row."""
    named = metrics.select("metric_set", "place", "metric", "feature")
    return named.join(comparison, "feature").select(
        "metric_set", "place", "metric", *[c for c in comparison.columns]
    )


def radar_normalized(df: DataFrame, feats: Sequence[str], inverted: Sequence[str] = (), scale: float = 1.0) -> DataFrame:
    """Min-max to 0..1 over the whole table (a zero range gives 1);
    ``100 − x`` (on the ``scale``) first for lower-is-better metrics."""
    prep = df.select("*", *[(F.lit(100.0 / scale) - F.col(c)).alias(f"_inv_{c}") for c in inverted])
    src = {c: (f"_inv_{c}" if c in inverted else c) for c in feats}
    b = prep.agg(*[F.min(v).alias(f"lo_{c}") for c, v in src.items()],
                 *[F.max(v).alias(f"hi_{c}") for c, v in src.items()]).first()  # 2p numbers
    out = []
    for c, v in src.items():
        lo, hi = b[f"lo_{c}"], b[f"hi_{c}"]
        if lo is None or hi == lo:
            out.append(F.lit(1.0).alias(c))
        else:
            out.append(((F.col(v) - F.lit(lo)) / F.lit(hi - lo)).alias(c))
    return prep.select(*[c for c in df.columns if c not in feats], *out)


def position_label(focus_value: Column, reference: Column, inverted: bool = False) -> Column:
    """ABOVE/BELOW/AT; for a lower-is-better metric MORE SELECTIVE when
    below, otherwise (ties included) LESS SELECTIVE."""
    if inverted:
        return F.when(focus_value < reference, "MORE SELECTIVE").otherwise("LESS SELECTIVE")
    return F.when(focus_value > reference, "ABOVE").when(focus_value < reference, "BELOW").otherwise("AT")


def peer_ranking(assigned: DataFrame, cluster_col: str, cluster_id: int, metric: str) -> DataFrame:
    """Members of a cluster sorted by a metric with the peer mean as a
    reference line (a one-row aggregate)."""
    peers = assigned.where(F.col(cluster_col) == cluster_id)
    mean = peers.agg(F.avg(metric).alias("peer_mean"))
    return peers.crossJoin(F.broadcast(mean)).orderBy(F.desc(metric))


def columns_by_pattern(df: DataFrame, include: str, exclude: str | None = None) -> list[str]:
    """Column names matching a pattern (and not an exclusion)."""
    return [c for c in df.columns if re.search(include, c) and not (exclude and re.search(exclude, c))]
