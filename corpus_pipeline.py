"""A training corpus from ``documents``, in five stages.

Every stage gets what its predecessor kept and returns the columns of
``documents``; the last one returns the shard and slot of each row.  Rows are
addressed by (doc_id, text), null-safe; extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm.common import read_table, shared_table, small_side, text_or_empty
from leafline.llm.decontamination import contaminated_spans
from leafline.llm.mixing import domain_posteriors, fit_rates
from leafline.llm.neardup import near_duplicates
from leafline.llm.sharding import shard_documents
from leafline.llm.toxicity import score_toxicity

#: share of a language's target: its tokens to this power
TEMPER = 0.7


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows whose (doc_id, text hash) is not in ``rejected`` (``_id``, ``_th``)."""
    gone = rejected.select(F.col("_id").alias("_gone_id"), F.col("_th").alias("_gone_th")).distinct()
    gone = small_side(shared_table(gone, "pipeline-rejected"))
    same = F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (F.xxhash64(text_or_empty("text")) == F.col("_gone_th"))
    return docs.join(gone, same, "left_anti")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models do not call toxic."""
    scored = score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, scored.where("predicted = 1"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the smallest id.

    Of rows that repeat its id and text one stays."""
    found = shared_table(near_duplicates(docs), "pipeline-classes")
    stays = F.col("_id").eqNullSafe(F.col("class_id")) & (F.col("_g") == F.col("kept_g"))
    kept = found.where(stays).groupBy("_id", "_g").agg(F.count(F.lit(1)).alias("_n"))
    gone = found.where(~stays).select(F.col("_id").alias("_gone_id"), F.col("_g").alias("_gone_g")).distinct()
    gone = small_side(shared_table(gone, "pipeline-copies"), 300_000)
    digest = F.md5(text_or_empty("text").cast("binary"))
    out = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("_gone_id")) & (digest == F.col("_gone_g")), "left_anti")
    twice = shared_table(kept.where("_n > 1").select(F.col("_id").alias("_two_id"), F.col("_g").alias("_two_g")), "pipeline-twice")
    if not twice.limit(1).count():
        return out
    again = F.col("doc_id").eqNullSafe(F.col("_two_id")) & (digest == F.col("_two_g"))
    once = out.join(twice, again, "left_semi").dropDuplicates(["doc_id", "text"])
    return out.join(twice, again, "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an occurrence of a benchmark item."""
    return _without(docs, contaminated_spans(docs, read_table(spark, sf_dir, "benchmark")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Languages mixed to tempered token targets, by repeating documents.

    Domains come from the languages of labelled documents, rates from the soft
    posteriors, at least 1: every document stays, and those of languages
    below their target are repeated, the fraction of a rate by a hash of the row."""
    labels = read_table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_k"))
    known = docs.select("doc_id", F.col("lang").alias("domain")).join(labels, F.col("doc_id") == F.col("_k"), "left_semi")
    rates, _ = fit_rates(*domain_posteriors(docs, known), temper=TEMPER, floor=1.0)
    share = F.pmod(F.xxhash64("_id", "_th", F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    copies = (F.floor("rate") + (share < F.col("rate") - F.floor("rate")).cast("int")).cast("int")
    extra = rates.select(F.col("_id").alias("_rate_id"), F.col("_th").alias("_rate_th"), (copies - 1).alias("_more"))
    extra = extra.where("_more > 0").dropDuplicates(["_rate_id", "_rate_th"])
    same = F.col("doc_id").eqNullSafe(F.col("_rate_id")) & (F.xxhash64(text_or_empty("text")) == F.col("_rate_th"))
    again = docs.join(small_side(shared_table(extra, "pipeline-rates")), same)
    again = again.withColumn("_again", F.explode(F.sequence(F.lit(1), F.col("_more")))).select(*docs.columns)
    return docs.unionByName(again)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every row; equal texts share a shard."""
    return shard_documents(docs, 16)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: models, sampled signatures and fitted rates have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
