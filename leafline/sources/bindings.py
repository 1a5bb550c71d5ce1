"""Reference-shaped inputs built from the supplied tables.

These only give rows in the schema a job expects; they do none of the
job's work.  Every binding is a lazy DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.functions.text import DIGITS, LETTERS
from leafline.sources.tables import table

WS = "[ \\t\\r\\n]"


def _share(text: F.Column, n: F.Column, chars: str) -> F.Column:
    """Share of the ``n`` characters that are among ``chars``, truncated to 4 decimals (exact in any engine)."""
    hits = F.length(F.regexp_replace(text, f"[^{chars}]+", ""))
    return F.when(n > 0, F.floor(hits * 10000 / n) / F.lit(10000.0)).otherwise(F.lit(0.0))


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page snapshots: ``(doc_id, text)`` from ``documents``."""
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per document, ``(doc_id, json)``.

    Stand-in for an extracted record: metadata, optional labels ("NA" when
    a document has no label row), a few facts about the text, and an array
    with the word count of every line."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    # the length is a column of its own, as the shares name it more than once
    j = docs.join(labels, "doc_id", "left").withColumn("_n", F.length("text"))
    t, n = F.col("text"), F.col("_n")
    lines = F.split(t, "\n", -1)
    na = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    rec = F.struct(
        F.struct(
            F.col("doc_id").alias("id"), F.col("lang").alias("lang"),
            F.col("source").alias("source"), F.col("n_chars").alias("chars"),
        ).alias("doc"),
        F.struct(na("quality").alias("quality"), na("toxic").alias("toxic")).alias("label"),
        F.struct(
            F.regexp_extract(t, f"^{WS}*([^ \\t\\r\\n]+)", 1).alias("first_word"),
            F.reverse(F.regexp_extract(F.reverse(t), f"^{WS}*([^ \\t\\r\\n]+)", 1)).alias("last_word"),
            F.size(lines).cast("bigint").alias("lines"),
            _share(t, n, LETTERS.upper()).alias("upper_share"),
            _share(t, n, DIGITS).alias("digit_share"),
            t.rlike("[0-9]").alias("has_digit"),
        ).alias("text"),
        F.transform(lines, lambda l: F.size(F.regexp_extract_all(l, F.lit("[^ \\t\\r]+"), 0)).cast("bigint"))
        .alias("line_words"),
    )
    return j.select("doc_id", F.to_json(rec).alias("json"))


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested record per order, ``(o_orderkey, json)``: an order object,
    a customer object and an array with one object per line item (an order
    without lines has an empty array)."""
    o = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    lines = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(
            F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_partkey").alias("part"),
            F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"),
            F.col("l_discount").alias("discount"), F.col("l_returnflag").alias("flag"),
        ))).alias("lines")
    )
    j = o.join(lines, o.o_orderkey == lines.l_orderkey, "left")
    rec = F.struct(
        F.struct(
            F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.col("o_totalprice").alias("total"),
        ).alias("order"),
        F.struct(F.col("o_custkey").alias("key")).alias("customer"),
        F.coalesce(F.col("lines"), F.array().cast(lines.schema["lines"].dataType)).alias("lines"),
    )
    return j.select("o_orderkey", F.to_json(rec).alias("json"))


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profile page text per customer with orders, ``(c_custkey, text)``.

    Stand-in for a scraped page: section headers, label-then-value,
    value-then-label, a glued ``label+value`` line, an ``#n / in / label``
    rank triple, a blank line and an "N/A" value.  Values come from
    customer ⋈ nation ⋈ per-customer order aggregates."""
    from pyspark.sql import Window

    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("spend"),
        F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
    )
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(o, c.c_custkey == o.o_custkey)
    rank = F.rank().over(Window.partitionBy("c_nationkey").orderBy(F.desc("spend"), "c_custkey"))
    share = F.when(F.col("n_urgent") > 0,
                   F.concat(F.floor(F.col("n_urgent") * 100 / F.col("n_orders")).cast("string"), F.lit("%"))
                   ).otherwise(F.lit("N/A"))
    lines = F.array(
        F.lit("Customer Profile"), F.lit("Name"), F.col("c_name"), F.lit("Market Segment"), F.col("c_mktsegment"),
        F.lit("Account Balance"), F.concat(F.lit("$"), F.format_number("c_acctbal", 2)), F.lit(""),
        F.lit("Nation"), F.col("n_name"), F.lit("Orders"), F.col("n_orders").cast("string"), F.lit("Orders placed"),
        F.lit("Total spend"), F.concat(F.lit("$"), F.format_number("spend", 2)),
        F.concat(F.lit("Urgent share"), share),
        F.concat(F.lit("#"), F.col("_rank").cast("string")), F.lit("in"), F.lit("Nation Rank"),
    )
    return j.withColumn("_rank", rank).select("c_custkey", F.array_join(lines, "\n").alias("text"))


FEATURES = ["n_orders", "spend", "avg_price", "lo", "hi", "sf", "p1", "p12p", "p1f", "p5p"]


def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity feature table, one row per customer with orders.

    ``n_orders, spend, avg_price, lo, hi`` are never NULL; the conditional
    means (status F; priority 1; status P with priority 1-2; priority 1 with
    status F; status P, priority 5, year >= 1998) are NULL where no such
    order exists, which gives the missing-value operators real gaps.  Label
    ``c_mktsegment``; target ``spend``; ``rank`` 1 = largest spend (ties by
    key).  Sums are exact (DECIMAL) so every value is order-independent."""
    from leafline.functions.stats import exact_avg, exact_sum
    from leafline.operators.features import global_row_number

    o = table(spark, sf_dir, "orders")
    st, pr = F.col("o_orderstatus"), F.col("o_orderpriority")
    price = F.col("o_totalprice")
    agg = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("n_orders"),
        exact_sum(price).cast("double").alias("spend"),
        exact_avg(price).alias("avg_price"),
        F.min(price).alias("lo"), F.max(price).alias("hi"),
        exact_avg(F.when(st == "F", price)).alias("sf"),
        exact_avg(F.when(pr == "1-URGENT", price)).alias("p1"),
        exact_avg(F.when((st == "P") & pr.isin("1-URGENT", "2-HIGH"), price)).alias("p12p"),
        exact_avg(F.when((pr == "1-URGENT") & (st == "F"), price)).alias("p1f"),
        exact_avg(F.when((st == "P") & (pr == "5-LOW") & (F.year("o_orderdate") >= 1998), price)).alias("p5p"),
        F.count_if(st == "F").alias("n_f"), F.count_if(st == "O").alias("n_o"),
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "c_acctbal")
    j = c.join(agg, "c_custkey")
    return global_row_number(j, [F.desc("spend"), F.asc("c_custkey")], "rank")
