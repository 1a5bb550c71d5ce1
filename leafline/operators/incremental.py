"""I — incremental processing: skip what is done, merge, ledger, summary.

All joins here are by entity key (left-anti / left-semi / union), so each
is one exchange per side; no driver-side sets of keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafline.session import materialise

# Fixed value (must equal the reference's): printed cost estimate per entity.
COST_PER_ENTITY = 0.02


def result_status(json: Column, required_section: str) -> Column:
    """I1 per result: ``ok`` if the output parses, carries no ``_error`` key
    and has the required top-level section; otherwise the failure reason."""
    v = F.try_parse_json(json)
    err = F.try_variant_get(v, "$._error", "string")
    has_section = F.try_variant_get(v, f"$.{required_section}", "variant").isNotNull()
    return (
        F.when(json.isNull(), F.lit("missing"))
        .when(v.isNull(), F.lit("invalid_json"))
        .when(err.isNotNull(), F.concat(F.lit("error: "), err))
        .when(~has_section, F.lit(f"missing section {required_section}"))
        .otherwise(F.lit("ok"))
    )


def done_set(results: DataFrame, key: str, required_section: str, json_col: str = "json") -> DataFrame:
    """Keys whose result is complete."""
    return results.where(result_status(F.col(json_col), required_section) == "ok").select(key).distinct()


def remaining_work(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs whose key is not done (left-anti join)."""
    return inputs.join(done.select(key), key, "left_anti")


def merge_results(previous: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """I4: previous ∪ new by column name; on a key present in both, new wins."""
    kept = previous.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def failure_ledger(attempts: DataFrame, key: str, status_col: str = "status") -> DataFrame:
    """Per key that is not ok in its latest attempt: the latest reason
    and the number of failed attempts.  ``attempts`` has ``key, attempt,
    status``."""
    latest = attempts.groupBy(key).agg(
        F.max_by(F.col(status_col), F.col("attempt")).alias("latest_status"),
        F.count_if(F.col(status_col) != "ok").alias("failed_attempts"),
    )
    return latest.where(F.col("latest_status") != "ok").select(
        key, F.col("latest_status").alias("reason"), "failed_attempts"
    )


def retry_work(inputs: DataFrame, attempts: DataFrame, key: str, max_attempts: int) -> DataFrame:
    """Inputs to try next, each with its ``attempt`` number (from 1).

    A key with an ok attempt is done; one with ``max_attempts`` failed attempts is given
    up.  ``attempts`` has ``key, attempt, status``; repeated input keys are tried once;
    a null status is a failed attempt, a null key takes no part."""
    tried = attempts.groupBy(F.col(key).alias("_tk")).agg(
        F.max(F.coalesce(F.col("status") == "ok", F.lit(False))).alias("_ok"),
        F.max("attempt").alias("_last"),
        F.count_if(~F.coalesce(F.col("status") == "ok", F.lit(False))).alias("_failed"),
    )
    work = inputs.where(F.col(key).isNotNull()).dropDuplicates([key]).join(tried, F.col(key) == F.col("_tk"), "left")
    return work.where(~F.coalesce("_ok", F.lit(False)) & (F.coalesce("_failed", F.lit(0)) < max_attempts)).withColumn(
        "attempt", (F.coalesce("_last", F.lit(0)) + 1).cast("int")
    ).drop("_tk", "_ok", "_last", "_failed")


def run_with_retries(inputs: DataFrame, key: str, attempt: Callable[[DataFrame], DataFrame], max_attempts: int) -> DataFrame:
    """All attempts ``(key, attempt, status)`` of a run that tries failed keys again.

    ``attempt`` maps the rows to try (with their ``attempt`` number) to ``key, attempt, status``.  Each
    round reads the attempts of earlier rounds as written to the shared folder and ends the run when nothing is
    left, at the latest after ``max_attempts`` rounds."""
    spark = inputs.sparkSession
    kind = inputs.schema[key].dataType.simpleString()
    done = spark.createDataFrame([], f"`{key}` {kind}, attempt int, status string")
    for _ in range(max_attempts):
        now = materialise(attempt(retry_work(inputs, done, key, max_attempts)).select(*done.columns), "retry-round")
        if now.isEmpty():
            break
        done = done.unionByName(now)
    return done


def run_summary(inputs: DataFrame, previous_done: DataFrame, new_results: DataFrame, key: str,
                required_section: str, json_col: str = "json") -> DataFrame:
    """One row: inputs, previously done, new successes, new failures,
    total done, remaining, estimated cost of the remaining work."""
    status = result_status(F.col(json_col), required_section)
    tagged = (
        inputs.select(F.col(key).alias("_k"), F.lit("input").alias("_tag"))
        .unionByName(previous_done.select(F.col(key).alias("_k"), F.lit("previous").alias("_tag")))
        .unionByName(new_results.select(
            F.col(key).alias("_k"), F.when(status == "ok", "new_ok").otherwise("new_failed").alias("_tag")))
    )
    agg = tagged.agg(
        F.count_distinct(F.when(F.col("_tag") == "input", F.col("_k"))).alias("inputs"),
        F.count_distinct(F.when(F.col("_tag") == "previous", F.col("_k"))).alias("previous"),
        F.count_if(F.col("_tag") == "new_ok").alias("new_ok"),
        F.count_if(F.col("_tag") == "new_failed").alias("new_failed"),
    )
    return agg.select(
        "inputs", "previous", "new_ok", "new_failed",
        (F.col("previous") + F.col("new_ok")).alias("total_done"),
        (F.col("inputs") - F.col("previous")).alias("remaining_before_run"),
        F.round((F.col("inputs") - F.col("previous")) * F.lit(COST_PER_ENTITY), 2).alias("estimated_cost"),
    )


def map_entities(df: DataFrame, fn, schema: str, partitions: int | None = None, key: str | None = None) -> DataFrame:
    """Apply a per-entity function (pandas frame in, pandas frame out)
    in parallel across partitions with Arrow batches (``mapInPandas``).  An
    expensive function gets an explicit partition count; ``key`` keeps one
    entity's rows together."""
    src = df
    if partitions:
        src = src.repartition(partitions, key) if key else src.repartition(partitions)

    def run(batches):
        for pdf in batches:
            yield fn(pdf)

    return src.mapInPandas(run, schema)
