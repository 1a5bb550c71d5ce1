"""Quality from an interpolated modified Kneser-Ney model of trusted text.

Character 5-grams of the trusted texts are counted; every order has its own
three discounts and continuation counts for the lower orders.  The log
probability of each 5-gram type of the corpus comes from joins of the
sharded count tables, a document's perplexity from its sum over them.

A document is kept if its perplexity is at most a high quantile of the
perplexities of trusted documents of its language that the counts left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.llm import charkn
from leafline.llm.common import read_table, shared_table, small_side
from leafline.llm.toxicity import fold

#: quantile of the trusted perplexities up to which a document is kept
QUANTILE = 0.985
#: trusted documents a language needs for a quantile of its own
LEAST_DOCS = 30


def perplexities(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Perplexity per character of every row under the model of the trusted rows.

    ``trusted`` has one column ``_tid`` of distinct ids.  Returns ``_id``, ``_th``,
    ``_tag`` (language) and ``perplexity``."""
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("_lang")
    )
    used = rows.join(small_side(trusted), F.col("_id") == F.col("_tid"), "left")
    cls = F.when(F.col("_tid").isNotNull(), 0)
    counts = shared_table(charkn.count_grams(used, cls, 1), "kn-counts")
    own = counts.select("g", F.col("n0").alias("c")).where("c > 0")
    lower = charkn.lower_orders(counts, own)
    p = charkn.top_order(counts, ["n0"], lower)
    table = shared_table(p.select("g", F.col("n1").alias("freq"), F.log("p_n0").alias("lp")), "kn-table")
    scored = charkn.score_documents(rows, table, "freq", "lp", "_id", tag_col="_lang")
    return scored.select("_id", "_th", "_tag", F.exp(-F.col("lp") / F.col("n")).alias("perplexity"))


def classify_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", quantile: float = QUANTILE,
    least_docs: int = LEAST_DOCS,
) -> DataFrame:
    """Perplexity, its language's threshold and the decision for every row.

    Trusted are rows whose label ``quality`` is 1: remainders 1 to 3 of
    ``crc32(doc_id) mod 5`` give the counts, 4 the quantiles, 0 is held out.
    Returns ``_id``, ``_th``, ``held_out``, ``perplexity``, ``threshold``, ``keep``.

    Defined cases: a null text is empty; a null language, or one with fewer than
    ``least_docs`` trusted rows, takes the quantile over all languages; without any
    trusted row everything is kept; rows with a null id are never trusted; an empty
    table gives none; other columns are not read."""
    good = (
        labels.where(F.col("doc_id").isNotNull() & (F.col("quality") == 1))
        .select(F.col("doc_id").alias("_tid")).distinct()
    )
    good = shared_table(good.withColumn("_f", fold("_tid")).where("_f <> 0"), "kn-trusted")
    scored = shared_table(
        perplexities(docs, good.where("_f <> 4").select("_tid"), id_col, text_col, lang_col), "kn-scored-docs"
    )
    reference = scored.join(good.where("_f = 4"), F.col("_id") == F.col("_tid"))
    q = F.percentile_approx("perplexity", quantile, 10_000)
    overall = reference.agg(q.alias("q")).first()["q"]
    by_lang = reference.where(F.col("_tag").isNotNull()).groupBy(F.col("_tag").alias("_lang")).agg(
        q.alias("_q"), F.count(F.lit(1)).alias("_n")
    ).where(F.col("_n") >= least_docs).select("_lang", "_q")
    limit = F.coalesce("_q", F.lit(float("inf") if overall is None else overall))
    out = scored.join(small_side(by_lang, 10_000), F.col("_tag") == F.col("_lang"), "left")
    return out.select(
        "_id", "_th", (fold("_id") == 0).alias("held_out"), "perplexity", limit.alias("threshold"),
        (F.col("perplexity") <= limit).alias("keep"),
    )


def op10_quality_kn(spark, sf_dir: str) -> DataFrame:
    """Perplexity and decision for every whole text of ``documents``."""
    out = classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return out.select(F.col("_id").alias("doc_id"), "held_out", "perplexity", "threshold", "keep")
