"""A — evidence audit: is every extracted value supported by its source text?

Plan (two exchanges in total, whatever the data size):

1. ``flatten_leaves`` + candidates per leaf: row-local, no shuffle.
2. ``groupBy(key)`` gathers one record's leaves back onto one row (a
   record is one row already, so the group is bounded by one record) and
   hash-partitions them by key.
3. Inner join with the texts on the same key (A0): only the text side is
   shuffled, the leaf side keeps its partitioning.  The text views (A1) are
   computed once per text row, never replicated per leaf.
4. Matching (A6/A7) is a higher-order ``filter`` over the candidates on
   that row; the per-record report (A8) is computed on the same row, so no
   further group-by is needed.  The global summary (A11) is one aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.functions.candidates import leaf_candidates
from leafline.functions.numbers import py_fixed
from leafline.functions.text import bounded_search, compact_text, digits_view, number_view
from leafline.operators.flatten import flatten_leaves

AUDITABLE = ("str", "int", "float", "bool")


def py_round(x: Column, n: int) -> Column:
    """Python ``round(x, n)`` (half-even on the exact binary value)."""
    return py_fixed(x, n).cast("double")


def work_partitions(df: DataFrame) -> int:
    """Partition count for CPU-heavy row work: the session's shuffle width
    (sized by the cluster for its data), never below the core count."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, spark.sparkContext.defaultParallelism)


def candidate_leaves(records: DataFrame, key: str, json_col: str = "json", max_depth: int | None = None,
                     legacy_zero_strip: bool = False, by_key: bool = True) -> DataFrame:
    """F2 + A2-A5: leaves with their ordered, deduplicated candidates.

    With ``by_key`` the records are hash-partitioned by key first: the
    flatten/candidate work then runs spread over the cluster, and the later
    per-record group-by and the join with the texts reuse this partitioning
    (records are smaller than their exploded leaves, so this is the cheapest
    place for the one exchange on the record side)."""
    leaves = flatten_leaves(records, [key], json_col, max_depth, spread=by_key)
    return leaves.withColumn(
        "candidates", leaf_candidates(F.col("kind"), F.col("value"), F.col("value_text"), legacy_zero_strip)
    ).drop("value")


def _match(c: Column, kind: Column, lower: Column, numbers: Column, compact: Column, digits: Column) -> Column:
    """Whether a candidate of a leaf of ``kind`` stands in the views of a text.

    Candidates of numbers hold digits and ``.,$#%-`` only, but for an exponent, inf and nan, so
    they are looked for in the number view, with the same result."""
    number = (kind == "int") | ((kind == "float") & ~c["text"].contains("e") & ~c["text"].contains("n"))
    return (
        F.when(number, bounded_search(c["text"], numbers))
        .when(c["kind"] == "compact", compact.contains(c["text"]))
        .when(c["kind"] == "digits", digits.contains(c["text"]))
        .otherwise(bounded_search(c["text"], lower))
    )


def audit_records(records: DataFrame, texts: DataFrame, key: str, json_col: str = "json",
                  text_col: str = "text", max_depth: int | None = None, legacy_zero_strip: bool = False) -> DataFrame:
    """One row per record that has a text: ``key, results`` where results is
    the array of per-leaf verdicts (A7), plus the A8 report columns."""
    leaves = candidate_leaves(records, key, json_col, max_depth, legacy_zero_strip)
    per_record = leaves.groupBy(key).agg(
        F.sort_array(
            F.collect_list(F.struct("ord", "path", "kind", "value_text", "candidates"))
        ).alias("leaves")
    )
    # the number of tasks goes by the work, not by the bytes that adaptive execution would add up to few tasks
    t = texts.select(F.col(key), F.col(text_col).alias("_text")).repartition(work_partitions(texts), key)
    joined = per_record.join(t, key, "inner")
    lower = F.lower(F.col("_text"))
    views = joined.select(
        key, "leaves",
        lower.alias("_lower"),
        number_view(lower).alias("_numbers"),
        compact_text(F.col("_text")).alias("_compact"),
        digits_view(F.col("_text")).alias("_digits"),
    )

    candidate = views.schema["leaves"].dataType.elementType["candidates"].dataType.elementType

    def with_hit(leaf: Column) -> Column:
        """The leaf and its first candidate found in the text; later ones aren't tried."""
        hit = F.aggregate(
            leaf["candidates"], F.lit(None).cast(candidate),
            lambda got, c: F.when(got.isNotNull(), got).when(
                _match(c, leaf["kind"], F.col("_lower"), F.col("_numbers"), F.col("_compact"), F.col("_digits")), c),
        )
        return F.struct(leaf.alias("leaf"), hit.alias("hit"))

    def verdict(pair: Column) -> Column:
        leaf, first = pair["leaf"], pair["hit"]
        auditable = leaf["kind"].isin(*AUDITABLE)
        match_type = (
            F.when(~auditable, F.when(leaf["kind"].isin("invalid_json", "depth_exceeded"), leaf["kind"])
                   .otherwise(F.lit("unsupported_type")))
            .when(first.isNull(), F.lit("unsupported"))
            .otherwise(first["kind"])
        )
        return F.struct(
            leaf["ord"].alias("ord"),
            leaf["path"].alias("path"),
            leaf["kind"].alias("kind"),
            leaf["value_text"].alias("value_text"),
            (auditable & first.isNotNull()).alias("supported"),
            match_type.alias("match_type"),
            F.when(auditable, first["text"]).alias("matched_candidate"),
        )

    results = views.select(key, F.transform(F.transform("leaves", with_hit), verdict).alias("results"))
    return results.select(key, "results", *_report_columns(F.col("results")))


def _report_columns(results: Column) -> list[Column]:
    total = F.size(results)
    supported = F.size(F.filter(results, lambda r: r["supported"]))
    types = F.array_sort(F.array_distinct(F.transform(results, lambda r: r["match_type"])))
    counts = F.transform(types, lambda t: F.size(F.filter(results, lambda r: r["match_type"] == t)).cast("bigint"))
    rate = F.when(total > 0, py_round(supported / total, 4)).otherwise(F.lit(0.0))
    return [
        total.cast("bigint").alias("total_fields"),
        supported.cast("bigint").alias("supported_fields"),
        (total - supported).cast("bigint").alias("unsupported_fields"),
        rate.alias("support_rate"),
        F.map_from_arrays(types, counts).alias("match_types"),
        F.transform(
            F.filter(results, lambda r: ~r["supported"]),
            lambda r: F.struct(r["path"].alias("path"), r["value_text"].alias("value"), r["match_type"].alias("match_type")),
        ).alias("unsupported"),
    ]


def audit_leaves(audited: DataFrame, key: str) -> DataFrame:
    """A7 as a table: one row per leaf."""
    return audited.select(key, F.inline("results")).drop("ord")


def audit_entity(audited: DataFrame, key: str) -> DataFrame:
    """Per-record report; ``match_types_json`` is the count map as JSON
    with sorted keys."""
    return audited.select(
        key, "total_fields", "supported_fields", "unsupported_fields", "support_rate",
        "match_types", F.to_json("match_types").alias("match_types_json"), "unsupported",
    )


def audit_missing_text(records: DataFrame, texts: DataFrame, key: str) -> DataFrame:
    """Records whose key has no text."""
    return records.select(key).join(texts.select(key), key, "left_anti")


def audit_worst(report: DataFrame, key: str, n: int = 10) -> DataFrame:
    """A10: the n records with most unsupported fields (ties by key)."""
    return report.orderBy(F.desc("unsupported_fields"), F.asc(key)).limit(n).select(
        key, "unsupported_fields", "total_fields", "support_rate"
    )


def audit_summary(report: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """One-row global summary.  Records without a text (A9) are counted
    through a left join from the record keys; partial aggregation only."""
    keyed = records.select(key).distinct().join(report, key, "left")
    audited = F.col("total_fields").isNotNull()
    agg = keyed.agg(
        F.count_if(audited).alias("entities_audited"),
        F.count_if(F.col("unsupported_fields") > 0).alias("entities_with_issues"),
        F.count_if(~audited).alias("missing_text"),
        F.coalesce(F.sum("total_fields"), F.lit(0)).cast("bigint").alias("total_fields"),
        F.coalesce(F.sum("supported_fields"), F.lit(0)).cast("bigint").alias("supported_fields"),
        F.coalesce(F.sum("unsupported_fields"), F.lit(0)).cast("bigint").alias("unsupported_fields"),
    )
    return agg.withColumn(
        "support_rate",
        F.when(F.col("total_fields") > 0, py_round(F.col("supported_fields") / F.col("total_fields"), 4))
        .otherwise(F.lit(0.0)),
    )


def audit_top_paths(leaf_results: DataFrame, n: int = 50) -> DataFrame:
    """Most frequent unsupported paths (ties by path)."""
    return (
        leaf_results.where(~F.col("supported"))
        .groupBy("path").agg(F.count("*").alias("n_unsupported"))
        .orderBy(F.desc("n_unsupported"), F.asc("path")).limit(n)
    )


def audit_selected(records: DataFrame, selection: DataFrame, key: str) -> DataFrame:
    """Keep only the selected keys (left-semi; selection may be large)."""
    return records.join(selection.select(key).distinct(), key, "left_semi")
