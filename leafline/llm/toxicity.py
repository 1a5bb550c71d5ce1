"""Toxicity from class-conditional Kneser-Ney models.

Two character 5-gram models, one of toxic and one of ordinary labelled texts,
share their lower orders: those come from the continuation counts of both
classes together.  A 5-gram that neither class has seen in a context therefore
backs off to the same estimate in both models, and only the contexts' back-off
weights can tell the classes apart; rare expressions stay near zero.

A text counts and scores each of its 5-grams once, so repeated lines weigh no
more than others.  The document's value is the length-normalised difference of the
two log-likelihoods, and the parts of it that exceed ``EXCESS`` in a 5-gram, which
do not follow the subject or language of a text as the whole does.  A logistic curve
fitted on labelled rows that the counts left out turns them into a score.

Only text and labels enter a score.  Labelled rows are dealt by the remainder ``f`` of
``crc32(doc_id) mod 5``: 0 is held out, 1 to 3 give counts, 4 the curve.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.llm import charkn
from leafline.llm.common import read_table, shared_table, small_side

#: differences of log-likelihoods beyond which a 5-gram counts apart
EXCESS = (1.0, 2.0, 3.0)
#: labelled rows that the curve is fitted on at most (those of smallest hash)
CURVE_ROWS = 20_000


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id's text, mod 5 (0: held out; a null id counts as empty)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 5


def fit_curve(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ridge logistic regression by Newton steps on standardised columns:
    weights (the intercept last), means and spreads."""
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-12
    z = np.hstack([(x - mean) / spread, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-1] * (z.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = z.T @ (z * (p * (1 - p) + 1e-9)[:, None]) + ridge
        step = np.linalg.solve(h, z.T @ (y - p) - ridge @ w)
        w += step * min(1.0, 3.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w, mean, spread


def ratio_table(counts: DataFrame) -> DataFrame:
    """log P(toxic) - log P(ordinary) of each 5-gram type.

    ``counts`` has ``g``, ``n0`` (ordinary), ``n1`` (toxic) and ``n2`` (all rows)."""
    pooled = counts.select("g", (F.col("n0") + F.col("n1")).alias("c"))
    lower = charkn.lower_orders(counts, pooled)
    p = charkn.top_order(counts, ["n0", "n1"], lower)
    return p.select("g", F.col("n2").alias("freq"), F.log(F.col("p_n1") / F.col("p_n0")).alias("llr"))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    curve_rows: int = CURVE_ROWS,
) -> DataFrame:
    """Score of every row: ``_id``, ``_th`` (text hash), ``held_out``, ``score``,
    ``predicted``, ``ratio`` (difference of log-likelihoods per 5-gram).

    ``labels`` has ``doc_id`` and ``toxic`` (0/1); if an id has several
    labels the largest holds.  Defined cases: a null text is scored as empty; rows with a null id have
    no label; without curve rows of both classes the score is the logistic of the
    whole ratio plus the log odds of the labels; an empty table gives none; other columns
    are not read."""
    known = (
        labels.select(F.col("doc_id").alias("_lid"), F.col("toxic").cast("int").alias("_y"))
        .where(F.col("_lid").isNotNull() & F.col("_y").isin(0, 1))
        .groupBy("_lid").agg(F.max("_y").alias("_y"))
    )
    known = shared_table(known.withColumn("_f", fold("_lid")).where("_f <> 0"), "tox-labels")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    used = rows.join(small_side(known), F.col("_id") == F.col("_lid"), "left")
    cls = F.when(F.col("_f").between(1, 3), F.col("_y"))
    counts = shared_table(charkn.count_grams(used, cls, 2, once=True), "tox-counts")
    table = shared_table(ratio_table(counts), "tox-ratios")
    values = ["llr", *[f"over{k}" for k in range(len(EXCESS))]]
    scored = charkn.score_documents(rows, table, "freq", "llr", "_id", once=True, excess=EXCESS)
    features = {"f0": F.col("llr") / F.col("n")}
    for v in values[1:]:
        features[f"{v}_mean"] = F.col(v) / F.col("n")
        features[f"{v}_sum"] = F.log1p(v)
        features[f"{v}_root"] = F.col(v) / F.sqrt("n")
    scored = shared_table(scored.select("*", *[f.alias(k) for k, f in features.items()]), "tox-scored")

    names = list(features)
    curve = (
        scored.join(known.where("_f = 4"), F.col("_id") == F.col("_lid"))
        .select(*names, "_y", F.xxhash64("_id").alias("h"))
        .orderBy("h", *names).limit(curve_rows).toPandas()
    )
    if curve["_y"].nunique() == 2:
        w, mean, spread = fit_curve(curve[names].to_numpy(), curve["_y"].to_numpy(dtype=float))
        z = F.lit(float(w[-1]))
        for k, name in enumerate(names):
            z = z + (F.col(name) - float(mean[k])) * (float(w[k]) / float(spread[k]))
    else:
        ones, every = known.agg(F.coalesce(F.sum("_y"), F.lit(0)), F.count(F.lit(1))).first()
        z = F.col("llr") + float(np.log((ones + 0.5) / (every - ones + 0.5)))
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), z))))
    return scored.select(
        "_id", "_th", (fold("_id") == 0).alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"), F.col("f0").alias("ratio"),
    )


def op6_toxicity_kn(spark, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text of ``documents``."""
    out = score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select(F.col("_id").alias("doc_id"), "held_out", "score", "predicted", "ratio")
